"""Landed files read by byte range: digests of blocks, a digest tree per file, and where two landings differ.

A file is cut into blocks of a fixed size, each a row ``path, block, start, size`` of its own, so one huge file is hashed
by many tasks and no file is a cell. The tree over the block digests has a fixed fan-out: digests of
``FAN_OUT`` blocks in a row, and the root over those. Equal roots mean equal files; where roots differ, the blocks
that do are found by a join on place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.sources import landing

BLOCK_BYTES = 8 << 20
#: Blocks under one node of the tree; two levels hold files of a million blocks, and longer ones in a wider root.
FAN_OUT = 1024
#: Bytes hashed by one task, about.
TASK_BYTES = 256 << 20
#: Bytes held at once while a block is hashed.
READ_BYTES = 1 << 20


def byte_ranges(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, length, block, start, size`` of each block of the files (``path, length``); an empty file has none."""
    last = F.expr(f"(length - 1) div {block_bytes}")
    blocks = files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    start = F.col("block") * block_bytes
    return blocks.select("path", "length", "block", start.alias("start"), F.least(F.lit(block_bytes), F.col("length") - start).alias("size"))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened, stream = None, None
    for batch in batches:
        digests = []
        for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size"))):
            if path != opened:  # ranges of one file come together
                if stream is not None:
                    stream.close()
                opened, stream = path, landing.open_file(path)
            digest, left = hashlib.sha256(), size
            while left:
                piece = stream.read_at(min(READ_BYTES, left), start + size - left)
                if not piece:
                    raise OSError(f"{path} ends before byte {start + size}: it was changed while being read")
                digest.update(piece)
                left -= len(piece)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], [*batch.schema.names, "sha256"])
    if stream is not None:
        stream.close()


def block_digests(spark: SparkSession, paths: str | list[str], pattern: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, length, block, start, size, sha256`` of every block of the files below ``paths``.

    Blocks are dealt to tasks by number, not by file, as many as the bytes call for.
    """
    files = landing.list_files(spark, paths, pattern)
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-total // block_bytes)))
    dealt = byte_ranges(files, block_bytes).repartition(tasks, "path", "block").sortWithinPartitions("path", "block")
    return dealt.mapInArrow(_hash, "path string, length long, block long, start long, size long, sha256 string")


def _over(digests: Column) -> Column:
    """The digest over digests in the order of their places."""
    return F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(digests)), lambda d: d["sha256"]), "").cast("binary"), 256)


def digest_trees(blocks: DataFrame) -> DataFrame:
    """``path, length, blocks, root`` of each file with content, from its block digests."""
    nodes = blocks.groupBy("path", "length", F.expr(f"block div {FAN_OUT}").alias("node")).agg(
        _over(F.struct("block", "sha256")).alias("sha256"), F.count(F.lit(1)).alias("blocks")
    )
    return nodes.groupBy("path", "length").agg(F.sum("blocks").alias("blocks"), _over(F.struct("node", "sha256")).alias("root"))


def differing_blocks(first: DataFrame, second: DataFrame, first_root: str, second_root: str) -> DataFrame:
    """``file, block, start, side`` of the blocks that two landings don't share.

    ``side`` tells what differs: ``content``, or that the block is in the ``first`` or the ``second`` landing only. A
    file's name is its path below the root. Files without content have no blocks: :func:`landing.agreement` compares lengths too.
    """

    def keyed(df: DataFrame, root: str, side: str) -> DataFrame:
        return df.select(landing.below(F.col("path"), root).alias("file"), "block", "start", F.struct("size", "sha256").alias(side))

    a, b = keyed(first, first_root, "_a"), keyed(second, second_root, "_b")
    both = a.join(b, ["file", "block", "start"], "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    side = F.when(F.col("_b").isNull(), "first").when(F.col("_a").isNull(), "second").otherwise("content")
    return both.select("file", "block", "start", side.alias("side"))


def landing_differences(first: DataFrame, second: DataFrame, first_root: str, second_root: str) -> DataFrame:
    """``file, blocks, differing, first_differing`` of every file with content in either landing."""

    def named(df: DataFrame, root: str) -> DataFrame:
        return df.select(landing.below(F.col("path"), root).alias("file"), "block")

    every = named(first, first_root).unionByName(named(second, second_root)).groupBy("file").agg((F.max("block") + 1).alias("blocks"))
    off = differing_blocks(first, second, first_root, second_root).groupBy("file").agg(
        F.count(F.lit(1)).alias("differing"), F.min("block").alias("first_differing")
    )
    return every.join(off, "file", "left").select("file", "blocks", F.coalesce("differing", F.lit(0)).alias("differing"), "first_differing")
