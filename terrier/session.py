"""Session defaults and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_scopes: list[list[str]] = []


def build_session(app: str = "terrier", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs were designed for.

    None of them is needed for right results: operators never rely on ANSI mode or on
    partition-column type inference being set one way or the other.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.sql.parquet.compression.codec", "zstd")
        # Recording the Python call site of every column doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where the session names none and all tasks run in this process (tests, a laptop) does a
    local folder stand in; on a cluster every executor would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir names no shared folder, which {master} needs for intermediate tables")
        root = tempfile.mkdtemp(prefix="terrier-")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables written inside the block when it ends, well or not.

    Nothing lazy that reads them may leave the block.
    """
    _scopes.append([])
    try:
        yield
    finally:
        _remove(spark, _scopes.pop())


@contextmanager
def scratch_until(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Hands out a function that removes the scratch tables written inside the block.

    For tables that a later step reads once more, and that are to go before the job's result is read.
    An enclosing :func:`scratch_scope` still removes them if the function is never called.
    """
    inside: list[str] = []
    _scopes.append(inside)
    try:
        yield lambda: _remove(spark, inside)
    finally:
        _scopes.pop()
        for scope in _scopes[-1:]:
            scope.extend(inside)


def _remove(spark: SparkSession, names: list[str]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name in names:
        path = hadoop.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where two branches must see the very same rows: unlike a cache it survives the
    loss of executors, and unlike a checkpointed RDD later reads still prune columns. ``release``
    drops the shuffle files of the write when it ends, which nothing needs once the rows are on disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with released_shuffles(spark) if release else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_pieces(pieces: Iterable[DataFrame], label: str) -> DataFrame:
    """Write the pieces of a table one after the other and read them back as one.

    Shuffle files of a piece are dropped before the next one begins, so the disk never holds those of the
    whole table. What is written is compressed harder than shuffle files are, and by column.
    """
    path, piece = "", None
    for piece in pieces:
        path = path or scratch_path(piece.sparkSession, label)
        with released_shuffles(piece.sparkSession):
            piece.write.mode("append").option("compression", "zstd").parquet(path)
    if piece is None:
        raise ValueError("a table of no pieces has no columns")
    return piece.sparkSession.read.schema(piece.schema).parquet(path)


def in_pieces(df: DataFrame, digest: Column, pieces: int) -> list[DataFrame]:
    """``df`` cut by a digest: rows of one digest are in one piece, and each row in exactly one."""
    if pieces == 1:
        return [df]
    return [df.filter(F.pmod(digest, F.lit(pieces)) == k) for k in range(pieces)]


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside the block leave no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
