"""Landed files: listing, heads, health, fingerprints and agreement of two landings.

Listing uses Spark's ``binaryFile`` source without its content column, so no byte is read for
it. Heads (at most 64 KiB a file) are read inside tasks; every judgement on them is a column
expression.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
HEAD_BYTES = 64 * 1024
SEPARATORS = [";", ",", "\t", "|"]


def _reader(spark: SparkSession, pattern: str | None):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def list_files(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """One row per file below ``paths`` that holds anything: path, length."""
    return _reader(spark, pattern).load(paths).select("path", "length")


def empty_files(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """The files without content, which a scan never sees but Spark's file index knows."""
    names = [(name,) for name in _reader(spark, pattern).load(paths).inputFiles()]
    known = spark.createDataFrame(names, "path string").select(_plain(F.col("path")).alias("path"))
    held = list_files(spark, paths, pattern).select(_plain(F.col("path")).alias("path"))
    return known.join(held, "path", "left_anti").select("path", F.lit(0).cast("long").alias("length"))


def _plain(path: Column) -> Column:
    """Spark prints local paths with one slash or with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _locate(path: str):
    """The file system Arrow knows a path by, as Spark prints it, and the path there."""
    from pyarrow import fs

    path = unquote(path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    # Arrow knows the store under its plain name only.
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


def _open(path: str):
    """An input stream."""
    system, inner = _locate(path)
    return system.open_input_stream(inner, compression=None)


def open_file(path: str):
    """An input file that reads from any place."""
    system, inner = _locate(path)
    return system.open_input_file(inner)


def _head(path: str, size: int) -> bytes:
    with _open(path) as stream:
        raw = stream.read(size)
    if path.endswith(".gz"):
        return zlib.decompressobj(zlib.MAX_WBITS | 16).decompress(raw, size)
    return raw


def _header(path: str) -> bytes:
    """The whole first line, however long, read piece by piece."""
    unzip = zlib.decompressobj(zlib.MAX_WBITS | 16) if path.endswith(".gz") else None
    line = bytearray()
    with _open(path) as stream:
        while b"\n" not in line and (raw := stream.read(HEAD_BYTES)):
            line += unzip.decompress(raw) if unzip else raw
    return bytes(line).partition(b"\n")[0]


def file_headers(files: DataFrame) -> DataFrame:
    """Path and ``header``, the first line of each file as text."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "header": [_header(p) for p in batch["path"]]})

    lines = files.select("path").mapInPandas(read, "path string, header binary")
    return lines.select("path", first_line(F.col("header")).alias("header"))


def file_heads(files: DataFrame, size: int = HEAD_BYTES) -> DataFrame:
    """Adds ``head``: the first bytes of each file, decompressed for ``.gz``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(head=[_head(p, size) for p in batch["path"]])

    listing = files.select("path", "length")
    return listing.mapInPandas(read, "path string, length long, head binary")


def first_line(head: Column) -> Column:
    """The first line of a head, as text; invalid bytes are replaced, not fatal."""
    line = F.substring_index(F.call_function("make_valid_utf8", head.cast("string")), "\n", 1)
    return F.regexp_replace(line, r"^\uFEFF|\r$", "")


def rejection_reason(length: Column, head: Column) -> Column:
    """Why a landed file does not look like separated text, or NULL when it does."""
    header = first_line(head)
    seen = F.lit(False)
    for sep in SEPARATORS:
        seen = seen | F.contains(header, F.lit(sep))
    return (
        F.when((length == 0) | (F.length(head) == 0), "empty file")
        .when(F.contains(head, F.lit(b"\x00")), "holds NUL bytes: binary data, not text")
        .when(~header_decodes(head), "header is not valid UTF-8")
        .when(~seen, F.concat(F.lit("header without a known separator: "), F.substring(header, 1, 120)))
    )


def header_decodes(head: Column) -> Column:
    """Whether the first line is valid UTF-8; the head may stop inside a later character."""
    return F.call_function("is_valid_utf8", F.substring_index(head.cast("string"), "\n", 1))


def file_health(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """One row per landed file with the reason it is refused, if any."""
    heads = file_heads(list_files(spark, paths, pattern))
    empty = empty_files(spark, paths, pattern).withColumn("head", F.lit(b""))
    return heads.unionByName(empty).select("path", "length", rejection_reason(F.col("length"), F.col("head")).alias("reason"))


def fingerprints(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """path, length and sha256 of every file.

    Every file is hashed piece by piece in constant memory, whatever its size; the digest of a whole file has to be
    computed in order, so one file is one task's work. :mod:`terrier.sources.blocks` hashes the parts of a file apart.
    """
    import hashlib

    def hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for path in batch["path"]:
                digest = hashlib.sha256()
                with _open(path) as stream:
                    while block := stream.read(8 * 1024 * 1024):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield batch.assign(sha256=digests)

    return list_files(spark, paths, pattern).mapInPandas(hash_files, "path string, length long, sha256 string")


def below(path: Column, root: str) -> Column:
    """A file's path below a root; without a root, the path as it is."""
    return path if not root else F.substring_index(path, root.rstrip("/") + "/", -1)


def agreement(first: DataFrame, second: DataFrame, first_root: str, second_root: str) -> DataFrame:
    """Compares the fingerprints of two landings of the same files, by path below each root.

    A file counts as agreed only when both landings have it, with equal length and content.
    """

    def keyed(df: DataFrame, root: str, side: str) -> DataFrame:
        return df.select(
            below(F.col("path"), root).alias("file"), F.col("length").alias(f"length_{side}"), F.col("sha256").alias(f"sha256_{side}")
        )

    both = keyed(first, first_root, "first").join(keyed(second, second_root, "second"), "file", "full_outer")
    same = (F.col("length_first") == F.col("length_second")) & (F.col("sha256_first") == F.col("sha256_second"))
    return both.withColumn("agreed", F.coalesce(same, F.lit(False)))
