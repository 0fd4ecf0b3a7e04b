"""Document fingerprints by one-permutation MinHash.

The shingles of a document are hashed once; the hash picks a bin, and a bin keeps its smallest hash.
An empty bin borrows from the bins that are filled, in a random order of its own (optimal
densification). Of each bin the lowest ``BITS`` bits are kept, one hexadecimal digit per bin, and the
likeness of two fingerprints is corrected for bits that agree by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm.words import blocks, hash_words, mix, shingles
from terrier.session import materialize

BINS, BITS, SHINGLE_WORDS = 256, 4, 5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _lenders() -> np.ndarray:
    """For each bin, the place of every other bin in the order in which it asks them."""
    pairs = np.arange(1, BINS * BINS + 1, dtype=np.uint64).reshape(BINS, BINS)
    return mix(pairs * np.uint64(0x9E3779B97F4A7C15)).argsort(axis=1).argsort(axis=1)


_ORDER = _lenders()


def digits_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The low bits of each bin of each text (UTF-8 bytes or None), and whether a text has shingles."""
    low, some = [], []
    for start, end in blocks(texts):
        values, counts = shingles(*hash_words(texts[start:end]), SHINGLE_WORDS)
        bins = np.full((len(counts), BINS), _EMPTY, dtype=np.uint64)
        owner = np.repeat(np.arange(len(counts)), counts)
        where = owner * BINS + (values >> np.uint64(56)).astype(np.int64)
        np.minimum.at(bins.ravel(), where, values & np.uint64((1 << 56) - 1))
        empty = bins == _EMPTY
        for row in np.flatnonzero(empty.any(axis=1) & (counts > 0)):
            filled, gaps = np.flatnonzero(~empty[row]), np.flatnonzero(empty[row])
            lender = filled[_ORDER[np.ix_(gaps, filled)].argmin(axis=1)]
            bins[row, gaps] = bins[row, lender]
        low.append((mix(bins) & np.uint64((1 << BITS) - 1)).astype(np.uint8))
        some.append(counts > 0)
    if not low:
        return np.zeros((0, BINS), dtype=np.uint8), np.zeros(0, dtype=bool)
    return np.concatenate(low), np.concatenate(some)


def as_text(low: np.ndarray, some: np.ndarray) -> list[str]:
    letters = _DIGITS[low]
    return [row.tobytes().decode() if has else "" for row, has in zip(letters, some)]


def likeness(low_a: np.ndarray, some_a: np.ndarray, low_b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated similarity row by row; two texts without shingles are alike, one with and one without are not."""
    chance = 2.0**-BITS
    agree = (low_a == low_b).mean(axis=1) if len(low_a) else np.zeros(0)
    corrected = np.clip((agree - chance) / (1 - chance), 0, 1)
    return np.where(some_a & some_b, corrected, (some_a == some_b).astype(float))


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        prints = as_text(*digits_of([t.encode() if t else None for t in texts]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t or "") for t in texts], pa.int64()), pa.array(prints, pa.string())],
            ["doc_id", "n_chars", "fingerprint"],
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of each row; texts that are null or have no word have an empty one."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_plain, f"doc_id {kind}, n_chars long, fingerprint string")


_COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(texts: list[str], following: list[str]) -> list[pa.Array]:
    """Result columns of texts whose next documents are ``following``."""
    edited = []
    for text, after in zip(texts, following):
        cut = len(text) // 3
        edited.append((text[: len(text) - cut] + after[:cut]).encode())
    own, own_some = digits_of([t.encode() for t in texts])
    if texts and following[:-1] == texts[1:]:  # consecutive documents: all but the last have their print already
        last, last_some = digits_of([following[-1].encode()])
        after, after_some = np.concatenate((own[1:], last)), np.concatenate((own_some[1:], last_some))
    else:
        after, after_some = digits_of([t.encode() for t in following])
    new, new_some = digits_of(edited)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
        pa.array(as_text(own, own_some), pa.string()),
        pa.array(as_text(new, new_some), pa.string()),
        pa.array(likeness(own, own_some, new, new_some), pa.float64()),
        pa.array(likeness(own, own_some, after, after_some), pa.float64()),
    ]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order: all but the last compared with the next, the last one left as an edge."""
    first = held_id = held = kind = None
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        if not ids:
            continue
        kind = batch.schema.field(0).type
        if first is None:
            first = texts[0]
        else:
            ids, texts = [held_id, *ids], [held, *texts]
        held_id, held = ids[-1], texts[-1]
        n = len(ids) - 1
        if n:
            columns = _compared(texts[:-1], texts[1:])
            empty = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[:-1], kind), *columns, *empty], ["doc_id", *_COLUMNS, "part", "head_text", "tail_text"]
            )
    if first is not None:
        types = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        edge = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first]), pa.array([held])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([held_id], kind), *[pa.nulls(1, t) for t in types], *edge],
            ["doc_id", *_COLUMNS, "part", "head_text", "tail_text"],
        )


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), *_compared(texts, following)], ["doc_id", *_COLUMNS])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document, and their likeness.

    The next document is the one with the next smaller id; the smallest is followed by the largest,
    a single document by itself. The last third of the characters of a text is replaced by the first
    as many (or all) of the next. Null texts are empty; rows without id come last; rows that repeat an
    id follow each other by text; other columns are ignored; an empty table gives an empty result.

    The texts are shuffled once, by ranges of ids. Within a range the next document is the next row;
    the last row of each range meets the first of the next one in a second step over as many rows as
    there are ranges.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id").desc_nulls_last()
    done = materialize(
        source.repartitionByRange(ranges, order)
        .sortWithinPartitions(order, "text")
        .mapInArrow(_in_order, f"doc_id {kind}, {_RESULT}, part int, head_text string, tail_text string"),
        "fingerprints",
    )
    edges = done.where("part IS NOT NULL")
    parts = edges.select("part")
    # One number per range of ids, so one task orders as many rows as there are ranges.
    in_order = Window.orderBy("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(in_order), F.min("part").over(in_order)).alias("next_part"))
    heads = edges.select(F.col("part").alias("next_part"), F.col("head_text").alias("next_text"))
    joined = edges.join(following, "part").join(heads, "next_part").select("doc_id", "tail_text", "next_text")
    last = joined.mapInArrow(_at_edges, f"doc_id {kind}, {_RESULT}")
    return done.where("part IS NULL").select("doc_id", *_COLUMNS).unionByName(last)
