"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function serves all: a document's sketch is the ``sketch_size`` smallest hashes of its
shingles. Inverted lists of the retained values bring documents together, the sketch of the union of
two documents estimates their similarity, and whole shingle sets confirm it.

How it stays whole and bounded:

* Documents with equal sets are one class; only classes are compared.
* Two sets as similar as asked for share at least ``shared`` retained values (but for a chance of
  ``MISS``; surely where sets are smaller than the sketch). With values ranked from rare to common,
  the rarest values of each class, as many as leave ``shared - 1`` out, must then have one in common.
  So common lines and passages enter the lists only of classes that consist of little else.
* Lists with the same smallest class are merged into one group. A group of any size is cut into
  blocks; each pair of blocks is one task, which compares its classes by array operations and returns
  a spanning forest of the links it finds, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.components import connected_components
from terrier.llm.words import as_bytes, blocks, distinct, hash_words, lists, mix, shingles
from terrier.session import materialize

#: Chance that two documents exactly as similar as asked for share fewer retained values than assumed.
MISS = 1e-8
#: Classes in a block of a group; bounds what one task holds.
BLOCK = 512
#: Hot classes are spread over so many values when documents look up their class.
SALTS = 8


def shared_values(sketch_size: int, percent: int) -> int:
    """How many values of the union's sketch lie in both sets, with probability of 1 - ``MISS`` or more."""
    p, below = percent / 100, 0.0
    for hits in range(sketch_size + 1):
        below += math.comb(sketch_size, hits) * p**hits * (1 - p) ** (sketch_size - hits)
        if below > MISS:
            return max(hits, 1)
    return sketch_size


def _shingle_sets(texts: list, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for start, end in blocks(texts):
        yield distinct(*shingles(*hash_words(texts[start:end]), size))


def _fingerprints(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit numbers per set that depend on all of its values."""
    found = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mix(values ^ np.uint64(salt)), out=total[1:])
        ends = np.cumsum(counts)
        found.append((total[ends] - total[ends - counts]).view(np.int64))
    return found


def _sketch_batches(size: int, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            done = 0
            for values, counts in _shingle_sets(texts, size):
                first, second = _fingerprints(values, counts)
                kept = np.minimum(counts, keep)
                place = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(counts)),
                        pa.array(counts, pa.int64()),
                        pa.array(first),
                        pa.array(second),
                        lists(values[place < keep], kept),
                        batch.column(2).slice(done, len(counts)),
                    ],
                    ["doc_id", "n_shingles", "h1", "h2", "sketch", "text_hash"],
                )
                done += len(counts)

    return run


def _set_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, done = as_bytes(batch.column(1)), 0
            for values, counts in _shingle_sets(texts, size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(counts)), lists(values, counts)], ["cid", "shingles"]
                )
                done += len(counts)

    return run


class _Forest:
    """Union-find over the classes of a block pair."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> bool:
        x, y = self.label[a], self.label[b]
        if x == y:
            return False
        self.label[self.label == max(x, y)] = min(x, y)
        return True


def _overlaps(sketches: list[np.ndarray]) -> np.ndarray:
    """How many retained values each two sketches share."""
    owners = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
    _, value, n = np.unique(np.concatenate(sketches), return_inverse=True, return_counts=True)
    common = n[value] > 1
    owners = owners[common]
    value = np.unique(value[common], return_inverse=True)[1] if common.any() else value[common]
    order = np.argsort(value, kind="stable")
    owners, value = owners[order], value[order]
    total = np.zeros((len(sketches), len(sketches)), dtype=np.float32)
    columns = 1024
    for first in range(0, int(value[-1]) + 1 if len(value) else 0, columns):
        start, end = np.searchsorted(value, [first, first + columns])
        part = np.zeros((len(sketches), columns), dtype=np.float32)
        part[owners[start:end], value[start:end] - first] = 1
        total += part @ part.T
    return total


def _union_hits(one: np.ndarray, others: np.ndarray, keep: int) -> np.ndarray:
    """Of the ``keep`` smallest values of each union of ``one`` and another sketch, how many lie in both."""
    merged = np.sort(np.concatenate((np.broadcast_to(one, others.shape), others), axis=1), axis=1)
    twice = merged[:, 1:] == merged[:, :-1]
    rank = np.arange(1, merged.shape[1]) - np.cumsum(twice, axis=1) + 1
    return (twice & (rank <= keep)).sum(axis=1)


def _links(keep: int, shared: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("cid").to_numpy()
        side = table.column("side").to_numpy()
        column = table.column("shingles").combine_chunks()
        flat = column.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(np.asarray(column.value_lengths()))
        sets = np.split(flat, ends[:-1])
        sizes = np.array([len(s) for s in sets])
        need = np.minimum(-(-percent * sizes // 100), shared)
        overlap = _overlaps([s[:keep] for s in sets])
        full = sizes >= keep
        sketches = np.zeros((len(sets), keep), dtype=np.uint64)
        for i in np.flatnonzero(full):
            sketches[i] = sets[i][:keep]
        forest, found = _Forest(len(sets)), []
        same_block = table.column("one_block")[0].as_py()
        for i in range(len(sets)):
            able = (overlap[i] >= np.maximum(need, need[i])) & (forest.label != forest.label[i])
            able &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
            able[: i + 1] = False
            if not same_block:
                able &= side != side[i]
            others = np.flatnonzero(able)
            if full[i] and len(others):
                both = others[full[others]]
                weak = both[_union_hits(sketches[i], sketches[both], keep) < shared] if len(both) else both
                others = np.setdiff1d(others, weak, assume_unique=True)
            if not len(others):
                continue
            values = np.concatenate([sets[j] for j in others])
            place = np.minimum(np.searchsorted(sets[i], values), sizes[i] - 1)
            equal = np.concatenate(([0], np.cumsum(sets[i][place] == values)))
            stops = np.cumsum(sizes[others])
            common = equal[stops] - equal[stops - sizes[others]]
            linked = others[100 * common >= percent * (sizes[i] + sizes[others] - common)]
            found += [(ids[i], ids[j]) for j in linked if forest.join(i, j)]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    sketch_size: int = 64,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    shingles of ``shingle_words`` words; a shorter document is one shingle. ``component_id`` is the
    smallest id reachable over links. Defined results at the edges: a text that is null or has no
    word has no shingles and is linked with nothing; a row without id is linked with nothing, has no
    component and is kept; rows that repeat an id with one text stay or go together; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    kind = source.schema["doc_id"].dataType.simpleString()
    shared = shared_values(sketch_size, percent)

    sketches = materialize(
        source.mapInArrow(
            _sketch_batches(shingle_words, sketch_size),
            f"doc_id {kind}, n_shingles long, h1 long, h2 long, sketch array<long>, text_hash long",
        ),
        "sketches",
    )
    classes = materialize(
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"),
            F.count("*").alias("copies"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        .select("h1", "h2", "copies", "n", "sketch", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )

    values = classes.select("cid", "n", F.explode("sketch").alias("value"))
    frequent = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (
        values.join(frequent, "value")
        .groupBy("cid", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("ranked"))
    )
    held = F.least(F.col("n"), F.lit(sketch_size))
    must_share = F.least(F.ceil(F.col("n") * percent / 100), F.lit(shared))
    # Values of no other class count as the rarest ones.
    room = (F.size("ranked") - must_share + 1).cast("int")
    entries = materialize(
        ranked.where(room > 0).select("cid", F.explode(F.slice("ranked", F.lit(1), room)).alias("x")).select("cid", "x.value"),
        "inverted-lists",
    )
    least = entries.groupBy("value").agg(F.min("cid").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = materialize(entries.join(least, "value").select("pivot", "cid").distinct(), "groups")

    # An id may be repeated with another text, so the text's own hash is asked for, too.
    wanted = members.select("cid").distinct().join(classes.select("cid", "first_id", "first_hash"), "cid")
    here = (F.col("doc_id") == F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    texts = source.join(wanted, here).select("cid", "text")
    sets = materialize(
        texts.mapInArrow(_set_batches(shingle_words), "cid long, shingles array<long>"), "shingle-sets"
    )
    lost = members.select("cid").distinct().join(sets.select("cid"), "cid", "left_anti").count()
    if lost:
        raise RuntimeError(f"{lost} classes of documents have no shingle set; the documents changed while they were read")
    cut = members.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    block = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    pieces = (
        members.join(cut, "pivot")
        .select("pivot", "cid", block.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(
            "pivot",
            "cid",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            (F.col("own") == F.col("other")).alias("one_block"),
        )
    )
    edges = (
        pieces.join(sets, "cid")
        .groupBy("pivot", "low", "high")
        .applyInArrow(_links(sketch_size, shared, percent), "a long, b long")
    )
    components = connected_components(edges)

    named = classes.join(components, classes["cid"] == components["node"], "left").select(
        "h1", "h2", "first_id", "copies", F.coalesce("component", "cid").alias("component")
    )
    named = materialize(named, "class-components")
    heads = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("documents"))
    # Only documents of components with more than one document need the look-up.
    targets = (
        named.join(heads.where("documents > 1"), "component")
        .select("h1", "h2", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    asking = sketches.drop("sketch", "text_hash").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).cast(kind)
    return (
        asking.join(targets, ["h1", "h2", "salt"], "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce("kept", F.lit(True)).alias("kept"))
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without those whose id has only documents that are not kept."""
    found = near_duplicates(docs, id_col=id_col, **options)
    gone = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
