"""Landed pages to a staging table, incrementally and resumably."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources.delimited import DIAGNOSTIC_COLUMNS, align_labels

TEXT_PAGE = T.StructType([T.StructField(c, T.StringType()) for c in DIAGNOSTIC_COLUMNS])

#: State on local disks, backed up to the checkpoint by its changes; it need not fit in memory.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def read_pages(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = TEXT_PAGE, **options: str) -> DataFrame:
    """A stream of landed page files; JSON records are read as text whatever their type."""
    reader = spark.readStream.format(fmt).schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def content_key(columns: list[str]):
    """A digest of a record's columns; a null differs from an empty text."""
    parts = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c))) for c in columns]
    return F.unhex(F.sha2(F.concat_ws(",", *parts), 256))


def new_records(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each record once, however many pages hold it and whenever they land.

    A record is known by a digest of all its columns (or of ``columns``). A stream keeps the digests it has
    seen as state, by key and without end, for a page may be landed again at any time; a copy of a
    frequent record goes no further than its partition's state.
    """
    key = "_content"
    return records.withColumn(key, content_key(columns or records.columns)).dropDuplicates([key]).drop(key)


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _STATE_STORE}
    for k, v in _STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ingest_pages(pages: DataFrame, staging: str, checkpoint: str, once: bool = False) -> DataFrame:
    """Appends every page not seen yet to the staging table and stops.

    The checkpoint remembers the files taken, so a run after an interruption, or after new pages
    have landed, only adds what is missing. ``once`` also remembers the records, so one that is landed again
    under another file name is added once; a checkpoint is used with it or without it for good. Nothing else is held
    between pages: which diagnostics are superseded depends on all of them and is settled in batch on the
    staged table.
    """
    spark = pages.sparkSession
    staged = align_labels(pages)
    with _state_on_disk(spark):
        query = (
            (new_records(staged) if once else staged)
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(staging)
        )
        query.awaitTermination()
    return spark.read.schema(staged.schema).parquet(staging)
