"""Text to typed columns.

Raw inputs are all text. *Lenient* casts turn what they cannot read into NULL, *strict* ones
fail the job. Both read a decimal or an exponent as a whole number by rounding it (``'120.5'``
is 121), and neither depends on the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A full date and nothing else.
DATE_SHAPE = r"^\s*\d{4,}-\d{1,2}-\d{1,2}\s*$"


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def lenient_int(text: Column, width: str = "int") -> Column:
    """``width`` is one of tinyint, smallint, int, bigint; out of range gives NULL."""
    return F.round(text.try_cast("double")).try_cast(width)


def lenient_date(text: Column) -> Column:
    # Spark would read '2020' as the first of January; a bare year is not a date here.
    return F.when(text.rlike(DATE_SHAPE), text).try_cast("date")


def _ansi() -> bool:
    """Whether plain casts of this session already fail on what they cannot read."""
    return SparkSession.active().conf.get("spark.sql.ansi.enabled") == "true"


def _or_fail(text: Column, parsed: Column, target: str) -> Column:
    refusal = F.raise_error(F.concat(F.lit(f"not a valid {target}: "), text)).cast(target)
    return F.coalesce(parsed, F.when(text.isNotNull(), refusal))


# A plain ANSI cast compiles to a fraction of the code of an explicit check. With twenty typed
# columns in one stage that decides whether the JVM compiles the stage at all.


def strict_double(text: Column) -> Column:
    return text.cast("double") if _ansi() else _or_fail(text, lenient_double(text), "double")


def strict_int(text: Column, width: str = "int") -> Column:
    if _ansi():
        return F.round(text.cast("double")).cast(width)
    return _or_fail(text, lenient_int(text, width), width)


def strict_date(text: Column) -> Column:
    if _ansi():
        other = F.concat(F.lit("not a full date: "), text)
        return F.when(text.rlike(DATE_SHAPE), text).otherwise(other).cast("date")
    return _or_fail(text, lenient_date(text), "date")


def number_text(value: Column) -> Column:
    """A double as plain decimal text (``10000000.0``, never ``1.0E7``), as hashed in sale keys."""
    return F.call_function("format_number", value, F.lit("0.0################"))


def to_rounded_int(value: Column, width: str = "int") -> Column:
    """Double to integer, halves to the even neighbour (a plain cast would truncate)."""
    return F.rint(value).cast(width)


def share(part: Column, whole: Column) -> Column:
    """A percentage with one decimal, NULL when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part / whole * 100, 1))
