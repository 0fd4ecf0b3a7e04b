"""A small append-only log in a folder of a shared file system, with checkpoints in place of its older entries.

An entry is a Parquet folder ``entry=N``; it counts from the moment its success mark is there, so a writer that
dies half way leaves nothing visible, and may write the same entry again. ``checkpoint=N`` holds what entries
up to N amount to; readers take the newest checkpoint and the entries after it, and :func:`trim` removes what that makes
superfluous. One writer at a time is assumed, readers need no care.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ENTRY, CHECKPOINT = "entry", "checkpoint"
#: Spark marks a finished write with this file.
_DONE = "_SUCCESS"


def file_system(spark: SparkSession, path: str):
    """The file system ``path`` is on, and the path as that knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it isn't there."""
    system, where = file_system(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def first_file(spark: SparkSession, path: str) -> str | None:
    """The name of one file right below ``path``."""
    system, where = file_system(spark, path)
    found = system.listStatusIterator(where)
    while found.hasNext():
        status = found.next()
        if status.isFile():
            return status.getPath().getName()
    return None


def remove(spark: SparkSession, path: str) -> None:
    system, where = file_system(spark, path)
    system.delete(where, True)


def numbers(spark: SparkSession, root: str, kind: str = ENTRY) -> list[int]:
    """Numbers of the finished entries, or checkpoints, in order."""
    found = [int(m[1]) for name in folders(spark, root) if (m := re.fullmatch(rf"{kind}=(\d+)", name))]
    return [n for n in sorted(found) if exists(spark, f"{root}/{kind}={n}/{_DONE}")]


def state(spark: SparkSession, root: str) -> tuple[int | None, list[int]]:
    """The newest checkpoint, if any, and the entries after it."""
    newest = max(numbers(spark, root, CHECKPOINT), default=None)
    return newest, [n for n in numbers(spark, root) if newest is None or n > newest]


def write(df: DataFrame, root: str, n: int, kind: str = ENTRY) -> None:
    """Writes entry (or checkpoint) ``n``, over what a writer that died left of it."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{root}/{kind}={n}")


def read(spark: SparkSession, root: str, schema: T.StructType, checkpoint: int | None, entries: list[int]) -> DataFrame:
    """The rows of a checkpoint and of the entries; which of them hold is for the caller to say."""
    paths = [f"{root}/{ENTRY}={n}" for n in entries]
    if checkpoint is not None:
        paths.append(f"{root}/{CHECKPOINT}={checkpoint}")
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def trim(spark: SparkSession, root: str) -> None:
    """Removes what the newest checkpoint stands for."""
    newest = max(numbers(spark, root, CHECKPOINT), default=None)
    if newest is None:
        return
    for name in folders(spark, root):
        kind, _, n = name.partition("=")
        if n.isdigit() and (int(n) <= newest if kind == ENTRY else int(n) < newest if kind == CHECKPOINT else False):
            remove(spark, f"{root}/{name}")
