"""The prefix trie of conversations, from range-partitioned shards and a broadcast skeleton.

A conversation is the path of its turns. A node of the trie is a path's beginning, a turn is known by
128 bits of its SHA-256, and conversations are ordered by path, then by id, so that a node's
members lie side by side. Splitters cut that order into shards. A node with members on both
sides of a splitter is a beginning of the splitter's path, so the trie of the splitters' paths, the
skeleton, holds every node that no single shard can finish. It is broadcast; each shard walks its
sorted conversations once, finishes all other nodes, and gives partial sums for those of the skeleton,
which are combined by a reduction, and summed up the skeleton at last.

Conversations with one and the same path are cut by id like any others, so no group is too large for a shard.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.session import materialize

#: Conversations of a shard, about.
SHARD_CONVERSATIONS = 50_000
#: Conversations drawn for each splitter.
DRAWN = 4
#: A splitter keeps so many turns of its path, and all of them together take no more bytes than that.
SPLITTER_TURNS = 64
SKELETON_BYTES = 64 << 20
#: Bytes of a list of ids that are handed on as one row.
CHUNK_BYTES = 1 << 16
_STEP = 32  # hexadecimal digits of a turn
_EMPTY = hashlib.sha256(b"").hexdigest()
#: Rows of one Arrow batch of results.
BATCH_ROWS = 100_000

NODE = "node long, conv_id long, depth long, parent_conv_id long, parent_node long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, words long, chunk binary, shard long, seq long"


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """128 bits of a turn's role and text as hexadecimal digits; null counts as empty."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    return F.substring(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said).cast("binary"), 256), 1, _STEP)


def conversation_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, steps``: the digests and word counts of each conversation's turns in order.

    Turns are ordered by number, null first, and turns of one number by their digest. Only digests and
    counts are shuffled, never texts. Rows without ``conv_id`` belong to no conversation.
    """
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    step = F.struct(F.col("turn"), turn_digest().alias("digest"), words.alias("words"))
    steps = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), step.alias("step"))
    listed = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    return listed.select("conv_id", F.transform("steps", lambda s: F.struct(s["digest"].alias("digest"), s["words"].alias("words"))).alias("steps"))


def as_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path, words``: the path as one text that sorts as the turns do, and the words of each turn."""
    return conversations.select("conv_id", F.array_join("steps.digest", "").alias("path"), F.col("steps.words").alias("words"))


def _splitters(paths: DataFrame, shards: int, rows: int) -> list[tuple[str, int]]:
    """At most ``shards - 1`` places in the order of conversations, evenly drawn; they decide balance, not results."""
    if shards < 2:
        return []
    share = min(1.0, DRAWN * shards / rows)
    drawn = paths.where(F.pmod(F.xxhash64(F.lit("splitter"), "conv_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    cut = SPLITTER_TURNS * _STEP
    # A path that is cut stands before all that begin like it, whatever their ids.
    place = F.when(F.length("path") > cut, F.lit(-(1 << 63))).otherwise(F.col("conv_id"))
    drawn = sorted((r[0], r[1]) for r in drawn.select(F.substring("path", 1, cut), place).toLocalIterator())
    step = max(len(drawn) / shards, 1)
    while True:
        chosen = sorted({drawn[int(i * step)] for i in range(1, shards) if int(i * step) < len(drawn)})
        if sum(len(path) for path, _ in chosen) <= SKELETON_BYTES:
            return chosen
        step *= 2


class Skeleton:
    """The trie of the splitters' paths. Nodes are numbered in depth-first order, 0 is the root."""

    def __init__(self, splitters: list[tuple[str, int]]) -> None:
        self.splitters = splitters
        self.children: list[dict[str, int]] = [{}]
        self.parent, self.depth, self.last = [-1], [0], [0]
        stack, before = [0], ""
        for path in sorted({path for path, _ in splitters}):
            shared = common_steps(before, path)
            del stack[shared + 1 :]
            for d in range(shared, len(path) // _STEP):
                node = len(self.parent)
                self.children[stack[-1]][path[d * _STEP : (d + 1) * _STEP]] = node
                self.children.append({})
                self.parent.append(stack[-1])
                self.depth.append(d + 1)
                self.last.append(node)
                stack.append(node)
            before = path
        for node in range(len(self.parent) - 1, 0, -1):
            above = self.parent[node]
            self.last[above] = max(self.last[above], self.last[node])


def common_steps(a: str, b: str) -> int:
    """How many turns two paths share at their beginning."""
    if a == b:
        return len(a) // _STEP
    low, high = 0, min(len(a), len(b)) // _STEP
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * _STEP] == b[: middle * _STEP] else (low, middle - 1)
    return low


class _Node:
    __slots__ = ("conv", "n", "children", "leaves", "saved", "words", "skeleton", "ends", "chunk", "size", "below")

    def __init__(self, words: int, skeleton: int) -> None:
        self.conv, self.n, self.children, self.leaves, self.saved = 1 << 63, 0, 0, 0, 0
        self.words, self.skeleton = words, skeleton
        self.ends = None  # state of the digest of the ids that end here, outside the skeleton
        self.chunk, self.size = [], 0  # the ids themselves, in the skeleton
        self.below: list[list] = []  # finished children, which wait for this node's smallest member


class _Walk:
    """One shard's conversations in order: nodes outside the skeleton are finished, the others get partial sums."""

    def __init__(self, skeleton: Skeleton, shard: int) -> None:
        self.skeleton, self.shard, self.seq = skeleton, shard, 0
        self.path, self.stack, self.rows = "", [_Node(0, 0)], []

    def _hand_on(self, node: _Node) -> None:
        """Gives on the ids that end at a skeleton node so far."""
        if node.chunk:
            self.rows.append((node.skeleton, *[None] * 10, b",".join(node.chunk), self.shard, self.seq))
            self.seq += 1
        node.chunk, node.size = [], 0

    def _close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        if node.skeleton >= 0:
            self._hand_on(node)
            sums = (node.n, node.children, node.leaves, node.saved)
            self.rows.append((node.skeleton, node.conv, depth, None, None, *sums, None, node.words, None, None, None))
            return
        above = self.stack[-1]
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.words
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        ends = node.ends.hexdigest() if node.ends else _EMPTY
        for child in node.below:
            child[3] = node.conv
            self.rows.append(tuple(child))
        row = [None, node.conv, depth, None, None, node.n, node.children, leaves, saved, ends, None, None, None, None]
        if above.skeleton >= 0:
            row[4] = above.skeleton
            self.rows.append(tuple(row))
        else:
            above.below.append(row)

    def add(self, conv: int, path: str, words: list[int]) -> None:
        shared = common_steps(self.path, path)
        while len(self.stack) > shared + 1:
            self._close()
        for d in range(shared, len(words)):
            above = self.stack[-1].skeleton
            at = self.skeleton.children[above].get(path[d * _STEP : (d + 1) * _STEP], -1) if above >= 0 else -1
            self.stack.append(_Node(words[d], at))
        self.path = path
        for node in self.stack:
            node.n += 1
            if conv < node.conv:
                node.conv = conv
        last, name = self.stack[-1], b"%d" % conv
        if last.skeleton >= 0:
            last.chunk.append(name)
            last.size += len(name) + 1
            if last.size >= CHUNK_BYTES:
                self._hand_on(last)
        elif last.ends is None:
            last.ends = hashlib.sha256(name)
        else:
            last.ends.update(b"," + name)

    def finish(self) -> None:
        while self.stack:
            self._close()


_SCHEMA = pa.schema(
    [
        (name, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
        for name, kind in (field.split() for field in NODE.split(", "))
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _shard_of(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = shared.value.splitters
        for batch in batches:
            places = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shards = pa.array([bisect_right(splitters, place) for place in places], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], [*batch.schema.names, "shard"])

    return run


def _walk(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "words")]
            for shard, conv, path, words in zip(*columns):
                if walk is None or shard != walk.shard:
                    if walk is not None:
                        walk.finish()
                        yield _batch(walk.rows)
                    walk = _Walk(shared.value, shard)
                walk.add(conv, path, words)
                if len(walk.rows) >= BATCH_ROWS:
                    yield _batch(walk.rows)
                    walk.rows = []
        if walk is not None:
            walk.finish()
            yield _batch(walk.rows)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each skeleton node's chunks, which come in order; one digest's state is held at a time."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    for batch in batches:
        for at, chunk in zip(batch.column("node").to_pylist(), batch.column("chunk").to_pylist()):
            if at != node:
                if node is not None:
                    yield row()
                node, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(chunk)
    if node is not None:
        yield row()


def _finished_skeleton(skeleton: Skeleton, partial: DataFrame, chunks: DataFrame) -> DataFrame:
    """Nodes of the skeleton with the sums of all shards, and of their subtrees.

    The table has a row per skeleton node, so the sums along its depth-first order are one small window.
    """
    spark = partial.sparkSession
    known = [(n, skeleton.parent[n], skeleton.last[n], len(skeleton.children[n])) for n in range(len(skeleton.parent))]
    known = spark.createDataFrame(known, "node long, above long, last long, skeleton_children long")
    sums = partial.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.max("words").alias("words"),
    )
    ends = (
        chunks.repartition("node").sortWithinPartitions("node", "shard", "seq").select("node", "chunk").mapInArrow(_ends, "node long, ends_sha256 string")
    )
    rows = known.join(sums, "node").join(ends, "node", "left")
    rows = rows.withColumn("n_children", F.col("n_children") + F.col("skeleton_children"))
    rows = rows.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
    rows = rows.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    rows = materialize(rows, "skeleton-nodes")
    so_far = Window.orderBy("node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select("node", F.sum("n_leaves").over(so_far).alias("leaves"), F.sum("saved_tokens").over(so_far).alias("saved"))
    upto_last = running.toDF("last", "leaves_last", "saved_last")
    above = rows.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    joined = rows.join(running, "node").join(upto_last, "last").join(above, "above", "left")
    return joined.select(
        "node",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaves_last") - F.col("leaves") + F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved_last") - F.col("saved") + F.col("saved_tokens")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def prefix_trie(paths: DataFrame, shard_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """One row per node of the trie of ``conv_id, path, words`` (see :func:`as_paths`).

    ``conv_id`` is the node's smallest member, ``n_convs`` its members, ``n_children`` its children,
    ``n_leaves`` the childless nodes of its subtree, itself included, ``saved_tokens`` the words that
    sharing saves in its subtree, and ``ends_sha256`` the digest of the ids of the conversations that end at it.

    Conversations without turns are members of the root. No conversation, no node. An id must not
    occur twice. A conversation is one row of about 40 bytes a turn, and a shard's nodes are held as far as
    their parent is open, both in one task; of the corpus only the splitters reach the driver.
    """
    spark = paths.sparkSession
    paths = materialize(paths, "conversation-paths")
    rows = paths.count()
    shards = -(-rows // shard_conversations)
    skeleton = Skeleton(_splitters(paths, shards, rows))
    shared = spark.sparkContext.broadcast(skeleton)
    dealt = paths.mapInArrow(_shard_of(shared), "conv_id long, path string, words array<int>, shard int")
    sorted_shards = dealt.repartitionById(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = materialize(sorted_shards.mapInArrow(_walk(shared), NODE), "trie-nodes")
    chunks = found.where("chunk IS NOT NULL").select("node", "chunk", "shard", "seq")
    top = materialize(_finished_skeleton(skeleton, found.where("node IS NOT NULL AND chunk IS NULL"), chunks), "skeleton")
    under = F.broadcast(top.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("_above")))
    local = found.where("node IS NULL").join(under, "parent_node", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return local.select(*columns).unionByName(top.select(*columns))


def rebuilt_conversations(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """``conv_id, steps`` where each conversation begins with turns of the first one of its family.

    A conversation c takes the first h turns of conversation ``c - c % family`` (as many as there are; none
    if it is absent) and its own turns after its first h, h being a checksum of the id modulo ``most``.
    A family's beginnings are joined by id: one row of at most ``most - 1`` turns for ``family`` conversations.
    """
    own = materialize(conversation_paths(turns), "conversations")
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_first"), F.slice("steps", 1, most - 1).alias("_beginning"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("_first"), "left").withColumn("_h", h)
    begin = F.coalesce(F.slice("_beginning", F.lit(1), F.col("_h")), F.array().cast(first.schema["_beginning"].dataType))
    rest = F.slice("steps", F.col("_h") + 1, F.size("steps"))
    return joined.select("conv_id", F.concat(begin, rest).alias("steps"))
