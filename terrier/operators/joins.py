"""Left joins that keep every left row once: buildings, parcels and the nearest diagnostic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrier.operators.ranking import best_per_group

# Fixed value: calendar years a diagnostic may lie from the sale it describes.
MAX_YEARS_APART = 3

NULL_SPREAD = 4096


def left_join_spread(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[str],
    right_keys: list[str],
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Left equi join whose NULL-keyed rows do not pile up in one task.

    A row without a first key matches nothing but would still be hashed with all the others like
    it. Its key is replaced by one of a few thousand values no right row can have, derived from
    ``spread_by``. The first key must be text; NULLs of further keys match each other.
    """
    hashed = [c for c in (spread_by or left.columns) if c in left.columns]
    bucket = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*hashed), F.lit(NULL_SPREAD)).cast("string"))
    keyed = left.withColumn("_spread_key", F.coalesce(F.col(left_keys[0]), bucket))
    names = {k: f"_right_{k}" for k in right_keys}
    renamed = right.filter(F.col(right_keys[0]).isNotNull()).withColumnsRenamed(names)
    same = F.col("_spread_key") == F.col(names[right_keys[0]])
    for mine, theirs in zip(left_keys[1:], right_keys[1:]):
        same = same & F.col(mine).eqNullSafe(F.col(names[theirs]))
    return keyed.join(renamed, same, "left").drop("_spread_key", *names.values())


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of unique ``left`` rows to any number of ``right`` rows each.

    Adaptive execution splits only the preserved side of an outer join, and here it is the other
    side that may hold a huge key. So the matches come from an inner join, where it splits either
    side, and the rows without a match from an anti join.
    """
    matched = left.join(right, key, "inner")
    alone = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True).select(matched.columns)


def years_apart(a: Column, b: Column) -> Column:
    """Calendar boundaries between two dates: 31 December and 1 January are one year apart."""
    return F.abs(F.year(a) - F.year(b))


def within_tolerance(a: Column, b: Column, years: int = MAX_YEARS_APART) -> Column:
    return years_apart(a, b) <= years


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_date: str,
    right_date: str,
    tie: list[str],
    out: str = "_nearest",
    years: int = MAX_YEARS_APART,
) -> DataFrame:
    """For each distinct (key, date) of ``left``, the right row of that key nearest in days.

    Only rows within ``years`` calendar years qualify; equal gaps go to the smallest ``tie``.
    Returns key, date and a struct with the right row's columns (NULL when none qualifies).

    No pair of left and right rows is formed. Both sides are first reduced to one row per key
    and day, so one key never holds more than its calendar; a window then carries the last
    right day forward and the next one back, and the nearer of the two is kept. The nearest on
    either side also has the fewest years on that side, so testing the two is enough.
    """
    asked = left.select(F.col(key), F.col(left_date).alias("_day")).filter(F.col(key).isNotNull()).distinct()
    offered = best_per_group(
        right.filter(F.col(key).isNotNull() & F.col(right_date).isNotNull()),
        [key, right_date],
        [F.col(c).asc_nulls_last() for c in tie],
    ).select(key, F.col(right_date).alias("_day"), F.struct(*[c for c in right.columns if c != key]).alias("_row"))
    nothing = F.lit(None).cast(offered.schema["_row"].dataType)
    days = asked.withColumns({"_row": nothing, "_asked": F.lit(True)}).unionByName(
        offered.withColumn("_asked", F.lit(False))
    )
    # Range frames include the other rows of the same day. Both run from the start of their own
    # ordering, which is linear; a frame up to the end would be quadratic.
    onwards = W.partitionBy(key).orderBy(F.col("_day").asc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    backwards = W.partitionBy(key).orderBy(F.col("_day").desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    around = days.withColumns(
        {
            "_prev": F.last("_row", ignorenulls=True).over(onwards),
            "_next": F.last("_row", ignorenulls=True).over(backwards),
        }
    ).filter("_asked")

    def candidate(name: str) -> Column:
        row = F.col(name)
        return F.when(
            within_tolerance(row[right_date], F.col("_day"), years),
            F.struct(
                F.abs(F.datediff(row[right_date], F.col("_day"))).alias("gap"),
                *[row[c].alias(f"t_{c}") for c in tie],
                row.alias("row"),
            ),
        )

    pick = F.least(candidate("_prev"), candidate("_next"))
    return around.select(key, F.col("_day").alias(left_date), pick["row"].alias(out))
