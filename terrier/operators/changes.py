"""Which sources have a new version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ["etag", "last_modified", "size"]


def dataset_marks(metadata: DataFrame) -> DataFrame:
    """Version marks of sources described by a metadata record instead of a file.

    The date of the data counts, and only for want of it that of the metadata; together with the
    number of rows it makes an etag. Columns: source, dataUpdatedAt, updatedAt, count.
    """
    # An empty date is no date.
    updated = F.coalesce(F.nullif("dataUpdatedAt", F.lit("")), F.nullif("updatedAt", F.lit("")))
    count = F.coalesce(F.col("count").cast("string"), F.lit("None"))
    return metadata.select(
        "source",
        F.when(updated.isNotNull(), F.concat(updated, F.lit(":"), count)).alias("etag"),
        updated.alias("last_modified"),
        F.col("count").cast("long").alias("size"),
    )


def changed_sources(seen: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``changed`` to the marks just seen (source, etag, last_modified, size).

    A source never seen is new. Otherwise the strongest mark both sides have decides: etag, then
    modification date, then size.
    """
    before = known.select("source", *[F.col(m).alias(f"_{m}") for m in MARKS])
    both = seen.join(before, "source", "left")

    def comparable(mark: str):
        return F.col(mark).isNotNull() & F.col(f"_{mark}").isNotNull()

    changed = (
        F.when(F.col("_etag").isNull() & F.col("_size").isNull(), True)
        .when(comparable("etag"), F.col("etag") != F.col("_etag"))
        .when(comparable("last_modified"), F.col("last_modified") != F.col("_last_modified"))
        .otherwise(~F.col("size").eqNullSafe(F.col("_size")))
    )
    return both.select("source", *MARKS, changed.alias("changed"))


def remember(seen: DataFrame, known: DataFrame) -> DataFrame:
    """The known marks after a detection run: changed sources take their new marks."""
    changed = changed_sources(seen, known).filter("changed").select("source", *MARKS)
    untouched = known.select("source", *MARKS).join(changed.select("source"), "source", "left_anti")
    return untouched.unionByName(changed)
