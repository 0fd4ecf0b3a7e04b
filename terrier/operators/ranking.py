"""Best row of a group, rank within a group, exact medians: all safe with one huge group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrier.session import materialize

# A group beyond this many rows is not ranked by a single task.
MAX_GROUP_ROWS = 2_000_000


def best_per_group(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per group, the first in ``order``.

    Catalyst pushes the ``= 1`` below the shuffle as a group limit, so each task sends at most
    one row per group and a group of any size is cheap.
    """
    window = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def largest_group(df: DataFrame, by: list[str]) -> int:
    """Rows of the largest group: one narrow aggregate, combined before the shuffle."""
    row = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()
    return row["n"] or 0


def rank_in_group(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    out: str,
    largest: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Adds the 1-based position of each row in its group.

    ``largest`` is the measured (or an upper bound of the) size of the largest group. Up to
    ``max_group_rows`` a plain window does; beyond, groups are cut by a range partitioning on
    group and order together, ranked piecewise, and shifted by the size of the earlier pieces.
    Both give the same ranks.
    """
    if largest is None or largest <= max_group_rows:
        return df.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy(*order)))

    # The cut must be the same for both uses below, so it is written once, not recomputed.
    pieces = materialize(
        df.repartitionByRange(*by, *order).withColumn("_piece", F.spark_partition_id()), "ranked-pieces"
    )
    keys = [*by, "_piece"]
    earlier = W.partitionBy(*by).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        pieces.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_o_{k}") for k in keys], "_before")
    )
    within = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    return (
        pieces.withColumn("_within", within)
        .join(offsets, same, "inner")
        .select(*df.columns, (F.col("_within") + F.col("_before")).cast("int").alias(out))
    )


def exact_median(df: DataFrame, by: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median and row count per group.

    Rows are first counted per distinct value, in a combining aggregate, so what a window has to
    order is a group's distinct values (prices to the cent), not its rows.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    totals = W.partitionBy(*by)
    upto = totals.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = counts.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(totals)})

    def holds(position: Column) -> Column:
        return (F.col("_upto") >= position) & (F.col("_upto") - F.col("_n") < position)

    low = F.expr("(_total + 1) div 2")
    high = F.expr("_total div 2 + 1")
    return placed.groupBy(*by).agg(
        ((F.max(F.when(holds(low), F.col(value))) + F.max(F.when(holds(high), F.col(value)))) / 2).alias(out),
        F.max("_total").alias("n"),
    )
