"""Combining overlapping sources and vintages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.casts import lenient_double
from terrier.session import in_pieces, materialize_pieces

def sale_match_key() -> dict[str, Column]:
    """What makes two raw lines the same sale across sources.

    The price is compared as a number: '250000' and '250000.0' are one price. Text that is no number
    is compared as it stands, so that it doesn't pass for a missing price.
    """
    price = lenient_double(F.col("valeur_fonciere"))
    return {
        "date": F.col("date_mutation"),
        "price": price,
        "unread_price": F.when(price.isNull(), F.col("valeur_fonciere")),
        "commune": F.col("code_commune"),
    }


def prefer_later_sources(
    sources: list[DataFrame],
    key: dict[str, Column],
    tag: str | None = None,
    only: Column | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Where sources overlap on ``key``, keeps only the lines of the highest-priority one.

    ``sources`` run from the lowest priority to the highest. The highest passes through
    untouched and unshuffled; a lower one is anti-joined with the distinct keys of those above
    it. NULL keys match each other. All the lines of the winning source stay. ``tag`` adds the
    position of the source. A digest of the key comes first in the join, so that wide lines are sorted by
    eight bytes and not by dates that thousands of them share.

    ``only`` narrows what is kept; the lines it leaves out take precedence as well.
    With ``pieces`` the lines left of a lower source are written down, cut by that digest into as many
    pieces: the disk then holds the shuffled lines of one piece at a time. Sources are read once per piece.
    """
    digest = F.xxhash64(*key.values())

    def tagged(df: DataFrame, i: int) -> DataFrame:
        return df.withColumn(tag, F.lit(i)) if tag else df

    def wanted(df: DataFrame) -> DataFrame:
        return df if only is None else df.filter(only)

    kept = []
    for i, df in enumerate(sources):
        if sources[i + 1 :]:
            taken = reduce(
                DataFrame.unionByName,
                [s.select(digest.alias("_k_digest"), *[c.alias(f"_k_{n}") for n, c in key.items()]) for s in sources[i + 1 :]],
            ).distinct()
            columns = df.columns
            keyed = wanted(df).withColumns({"_m_digest": digest, **{f"_m_{n}": c for n, c in key.items()}})
            same = [F.col("_m_digest") == F.col("_k_digest"), *[F.col(f"_m_{n}").eqNullSafe(F.col(f"_k_{n}")) for n in key]]
            if pieces is None:
                df = keyed.join(taken, same, "left_anti").select(*columns)
            else:
                cut = zip(in_pieces(keyed, F.col("_m_digest"), pieces), in_pieces(taken, F.col("_k_digest"), pieces), strict=True)
                left = [k.join(t, same, "left_anti").select(*columns) for k, t in cut]
                df = materialize_pieces(left, "lines-left")
        else:
            df = wanted(df)
        kept.append(tagged(df, i))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)


def reconcile(left: DataFrame, right: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """How many keys two vintages share, and how many only one of them has.

    Both sides are counted into one grouping, so no pair of rows is ever formed.
    """
    def side(df: DataFrame, in_left: int) -> DataFrame:
        return df.select(*key, F.lit(in_left).alias("_left"), F.lit(1 - in_left).alias("_right"))

    seen = (
        side(left, 1)
        .unionByName(side(right, 0))
        .groupBy(*key)
        .agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    )
    return seen.groupBy(*(by or [])).agg(
        F.count_if((F.col("_left") == 1) & (F.col("_right") == 1)).alias("matched"),
        F.count_if(F.col("_right") == 0).alias("only_left"),
        F.count_if(F.col("_left") == 0).alias("only_right"),
    )


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``changes`` replace the rows of the same key and add the others; keys are unique in both."""
    untouched = current.join(changes.select(key), key, "left_anti")
    return untouched.unionByName(changes, allowMissingColumns=True)
