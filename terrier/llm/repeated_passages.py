"""Removal of passages that occur earlier in the corpus, by sorting the suffixes that may repeat.

A string of ``LENGTH`` bytes is repeated if it also starts earlier: in a smaller document, or before in the
same one. Every string has an anchor, the ``GRAM`` bytes in it with the least hash, which equal strings
have at the same place. Strings with one anchor are neighbours, and so are found together in a few bytes.

1. Each text is cut into units at places its content selects. Of units with equal bytes the earliest
   stays; what starts in the others is repeated, without further ado. Hot copies melt in this aggregate.
2. The anchors of the units that stayed are sorted by range, where repeated ones are neighbours and frequent ones
   fall into blocks. Around repeated anchors bytes are cut out of the texts, and shuffled by anchor and block.
3. A block's suffixes from their anchors on, and the bytes before the anchors read backwards, are sorted
   by :mod:`deep_shallow`. Two strings are equal if their halves share enough bytes, so the lengths that
   neighbours in both orders share tell all classes of equal strings; the earliest of each stays.
4. Strings of an anchor with several blocks meet once more by digest, one per block and class.
5. Texts are joined with what stayed of them; bytes of repeated strings are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm import deep_shallow
from terrier.llm.words import as_bytes
from terrier.session import materialize

#: Repeated strings are at least so many bytes long.
LENGTH = 100
#: Bytes of an anchor.
GRAM = 16
#: One anchor in so many ends a unit, and at the latest the one after ``UNIT_ANCHORS``.
UNIT_ONE_IN = 8
UNIT_ANCHORS = 64
#: Occurrences of one anchor that are sorted together.
BLOCK_MEMBERS = 1 << 14
#: Members sorted by one call at most, as far as a block isn't larger.
BATCH_MEMBERS = 1 << 14
#: Bytes of text whose anchors are found at once; longer texts are taken slice by slice.
SCAN_BYTES = 1 << 18
SLICE_BYTES = 1 << 20
#: Depth of the quicksort beyond the anchor's own bytes.
SHALLOW = 16
#: Bytes of text given on at once.
OUT_BYTES = 8 << 20

_PLACE = np.uint64((1 << 24) - 1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _pieces(texts: list) -> Iterator[list[tuple[int, int, bytes]]]:
    """Slices ``(text, place of the slice, bytes)`` that are scanned together; slices overlap by LENGTH - 1 bytes."""
    some, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), SLICE_BYTES):
            some.append((i, at, text[at : at + SLICE_BYTES + LENGTH - 1]))
            size += len(some[-1][2])
            if size >= SCAN_BYTES:
                yield some
                some, size = [], 0
    if some:
        yield some


class Anchors:
    """Anchors of all strings of some slices: a row for each stretch of starts with one anchor, in order.

    ``text``, ``first`` and ``place`` are the text, the first start and the anchor's place in the text;
    ``count`` starts share the anchor, whose hash is ``hash``. ``opens`` marks the rows that begin a unit.
    """

    def __init__(self, pieces: list[tuple[int, int, bytes]]) -> None:
        joined = b"".join(p[2] for p in pieces)
        self.data = joined
        lengths = np.array([len(p[2]) for p in pieces], dtype=np.int64)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        padded = joined + bytes(GRAM)
        eight = np.ndarray((len(joined) + GRAM - 7,), "<u8", padded, strides=(1,))
        hashes = (eight[: len(joined)] * _A) ^ (eight[8 : len(joined) + 8] * _B)
        hashes ^= hashes >> np.uint64(29)
        hashes *= _C
        hashes ^= hashes >> np.uint64(32)
        least = (hashes & ~_PLACE) | np.arange(len(joined), dtype=np.uint64)
        width, window = 1, LENGTH - GRAM + 1
        while width < window:
            step = min(width, window - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        # ``least[s]`` covers the grams of the string at s; strings that reach over a slice's end don't count.
        counts = lengths - LENGTH + 1
        starts = np.arange(int(counts.sum())) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
        anchor = (least[starts] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        piece = np.searchsorted(ends, starts[new], side="right")
        shift = np.array([p[1] for p in pieces], dtype=np.int64) - begins
        self.local = starts[new]
        self.count = np.diff(np.append(new, len(starts)))
        self.text = np.array([p[0] for p in pieces], dtype=np.int64)[piece]
        self.first = self.local + shift[piece]
        self.place = anchor[new] + shift[piece]
        self.hash = hashes[anchor[new]]
        natural = (self.hash % np.uint64(UNIT_ONE_IN) == 0) | np.concatenate(([True], piece[1:] != piece[:-1]))
        row = np.arange(len(new))
        self.opens = (row - np.maximum.accumulate(np.where(natural, row, 0))) % UNIT_ANCHORS == 0

    def bytes_at(self, rows: np.ndarray) -> list[bytes]:
        """The bytes of the strings of each of the rows."""
        firsts, lasts = self.local[rows], self.local[rows] + self.count[rows] + LENGTH - 1
        return [self.data[a:b] for a, b in zip(firsts.tolist(), lasts.tolist())]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in as_bytes(batch.column("text"))]
        for pieces in _pieces(texts):
            found = Anchors(pieces)
            units = np.flatnonzero(found.opens)
            after = np.append(units[1:], len(found.opens))
            total = np.add.reduceat(found.count, units)
            firsts, lasts = found.local[units], found.local[units] + total + LENGTH - 1
            view = memoryview(found.data)
            digests = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(firsts.tolist(), lasts.tolist())]
            offsets = pa.array(np.append(units, after[-1]).astype(np.int32))
            owner = pa.array(found.text[units])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    batch.column("doc_id").take(owner),
                    batch.column("mark").take(owner),
                    pa.array(found.first[units]),
                    pa.array(total),
                    pa.ListArray.from_arrays(offsets, pa.array(found.hash.view(np.int64))),
                ],
                ["digest", "doc_id", "mark", "first", "count", "anchors"],
            )


def _repeated_anchors(block_members: int):
    """Of rows sorted by anchor those that share theirs, in blocks of one anchor.

    ``split`` marks anchors with several blocks. A partition's first and last anchor may have rows in the
    next partition, so theirs always stay, and count as split. A batch and a block are held at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_block = TaskContext.get().partitionId() << 32

        def marked(rows: pa.Table, begin: np.ndarray, before: int, edge: bool) -> Iterator[pa.RecordBatch]:
            """Rows of the anchors that begin at ``begin``, the first of which had ``before`` rows already."""
            size = np.diff(np.append(begin, len(rows)))
            split = size > block_members
            split[0] |= edge or before > 0
            rank = np.arange(len(rows)) - np.repeat(begin, size)
            rank[: size[0]] += before
            stays = np.repeat(split | (size > 1), size)
            block = pa.array((first_block + rank // block_members)[stays])
            kept = rows.filter(pa.array(stays)).append_column("block", block)
            yield from kept.append_column("split", pa.array(np.repeat(split, size)[stays])).to_batches()

        held, anchor, given, edge = None, None, 0, True  # rows of the last anchor, and how many of it were given on
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            anchors = rows.column("anchor").to_numpy()
            if not len(anchors):
                continue
            given = given if anchors[0] == anchor else 0
            begin = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
            last = int(begin[-1])
            if last:
                yield from marked(rows.slice(0, last), begin[:-1], given, edge)
                given, edge = 0, False
            held, anchor = rows.slice(last), anchors[-1]
            if given + len(held) > block_members:
                yield from marked(held, begin[:1], given, True)
                held, given = None, given + len(held)
        if held is not None:
            yield from marked(held, np.zeros(1, dtype=np.int64), given, True)

    return run


def _mixed(first: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    x = (first.astype(np.uint64) * _A) ^ anchor.astype(np.uint64)
    return (x ^ (x >> np.uint64(31))) * _B


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each wanted anchor, with its block."""
    for batch in batches:
        texts = [t or b"" for t in as_bytes(batch.column("text"))]
        asked = batch.column("wanted")
        offsets, fields = asked.offsets.to_numpy(), asked.values
        for pieces in _pieces(texts):
            found = Anchors(pieces)
            unit = np.maximum.accumulate(np.where(found.opens, np.arange(len(found.opens)), 0))
            keys = _mixed(found.first[unit], found.hash.view(np.int64)) ^ _mixed(found.text, found.text)
            low, high = int(offsets[found.text[0]]), int(offsets[found.text[-1] + 1])
            text = np.repeat(np.arange(len(texts)), np.diff(offsets))[low - offsets[0] : high - offsets[0]]
            wanted = [fields.field(name).to_numpy()[low:high] for name in ("first", "anchor", "block")]
            split = fields.field("split").to_numpy(zero_copy_only=False)[low:high]
            sought = _mixed(wanted[0], wanted[1]) ^ _mixed(text, text)
            if not len(sought):
                continue
            order = np.argsort(sought)
            at = order[np.minimum(np.searchsorted(sought, keys, sorter=order), len(sought) - 1)]
            rows = np.flatnonzero(sought[at] == keys)
            owner = pa.array(found.text[rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.hash[rows].view(np.int64)),
                    pa.array(wanted[2][at[rows]]),
                    pa.array(split[at[rows]]),
                    batch.column("doc_id").take(owner),
                    batch.column("mark").take(owner),
                    pa.array(found.first[rows]),
                    pa.array((found.place - found.first)[rows]),
                    pa.array(found.bytes_at(rows), pa.binary()),
                ],
                ["anchor", "block", "split", "doc_id", "mark", "first", "lead", "bytes"],
            )


def repeated_starts(group: np.ndarray, lead: np.ndarray, data: list[bytes]) -> np.ndarray:
    """Which strings of each member equal one of an earlier member of its group, as a matrix.

    A member is ``data``, the bytes of consecutive strings that have the anchor ``lead`` bytes after the
    first one's start. Column l is the string that starts l bytes before the anchor.
    """
    n, most = len(data), LENGTH - GRAM
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    least = lead - (sizes - LENGTH)
    right = np.zeros((n, -(-LENGTH // 8) * 8), dtype=np.uint8)
    left = np.zeros((n, -(-most // 8) * 8), dtype=np.uint8)
    whole = np.frombuffer(b"".join(data), dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    for matrix, count, start, step in ((right, sizes - lead, begin + lead, 1), (left, lead, begin + lead - 1, -1)):
        rows = np.repeat(np.arange(n), count)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        matrix[rows, place] = whole[np.repeat(start, count) + step * place]
    right_order, right_shared = deep_shallow.sort(right, sizes - lead, group, GRAM + SHALLOW)
    left_order, left_shared = deep_shallow.sort(left, lead, group, SHALLOW)
    repeated = np.zeros((n, most + 1), dtype=bool)
    of_right, of_left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for column in range(most + 1):
        active = np.flatnonzero((least <= column) & (column <= lead))
        if len(active) < 2:
            continue
        of_right[right_order] = np.cumsum(right_shared < LENGTH - column)
        of_left[left_order] = np.cumsum(left_shared < column)
        alike = of_right[active] * (n + 1) + of_left[active]
        order = np.argsort(alike, kind="stable")
        later = np.flatnonzero(alike[order][1:] == alike[order][:-1]) + 1
        repeated[active[order[later]], column] = True
    return repeated


class _Members:
    """Members of blocks that are collected until they are enough for one sort."""

    def __init__(self) -> None:
        self.group, self.split, self.key, self.lead, self.data = [], [], [], [], []

    def result(self, kinds: list[pa.DataType]) -> pa.RecordBatch:
        """Ranges of repeated starts, and digests of the first strings of classes that may have more elsewhere."""
        lead, n = np.array(self.lead, dtype=np.int64), len(self.data)
        sizes = np.array([len(d) for d in self.data], dtype=np.int64)
        repeated = repeated_starts(np.array(self.group, dtype=np.int64), lead, self.data)
        # A range of columns read backwards is a range of starts.
        flat = np.pad(repeated[:, ::-1], ((0, 0), (1, 1))).astype(np.int8)
        edges = np.diff(flat, axis=1)
        owner, begin = np.nonzero(edges == 1)
        end = np.nonzero(edges == -1)[1]
        anchor = np.array([k[2] for k in self.key], dtype=np.int64) + lead
        most = LENGTH - GRAM
        first, last = anchor[owner] - most + begin, anchor[owner] - most + end
        more, digest = [], []
        for i in np.flatnonzero(np.array(self.split)).tolist():
            for offset in range(int(sizes[i]) - LENGTH + 1):
                if not repeated[i, lead[i] - offset]:
                    more.append((i, self.key[i][2] + offset))
                    digest.append(hashlib.blake2b(self.data[i][offset : offset + LENGTH], digest_size=16).digest())
        owners = owner.tolist() + [i for i, _ in more]
        firsts = first.tolist() + [start for _, start in more]
        lasts = last.tolist() + [start + 1 for _, start in more]
        columns = [pa.array([self.key[i][c] for i in owners], kinds[c]) for c in (0, 1)]
        digests = pa.array([None] * len(owner) + digest, pa.binary())
        return pa.RecordBatch.from_arrays([*columns, pa.array(firsts, pa.int64()), pa.array(lasts, pa.int64()), digests], _STARTS)


_STARTS = ["doc_id", "mark", "first", "last", "digest"]


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    members, block, kinds, group = _Members(), None, None, 0
    for batch in batches:
        kinds = [batch.schema.field(c).type for c in ("doc_id", "mark")]
        names = ("anchor", "block", "split", "doc_id", "mark", "first", "lead", "bytes")
        for anchor, part, split, doc_id, mark, first, lead, data in zip(*(batch.column(c).to_pylist() for c in names)):
            key = (doc_id, mark, first)
            if (anchor, part) != block:
                if len(members.data) >= BATCH_MEMBERS:
                    yield members.result(kinds)
                    members = _Members()
                block, group = (anchor, part), group + 1
            elif members.key and members.key[-1] == key and members.lead[-1] == lead:
                continue  # a repeated row
            members.group.append(group)
            members.split.append(split)
            members.key.append(key)
            members.lead.append(lead)
            members.data.append(data)
    if members.data:
        yield members.result(kinds)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of repeated strings."""

    def given(ids: list[int], sizes: list[int], removed: list, kept: list[bytes], batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        columns = [batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "removed", "kept"])

    for batch in batches:
        ids, sizes, removed, kept, held = [], [], [], [], 0
        for i, (text, ranges) in enumerate(zip(as_bytes(batch.column("text")), batch.column("ranges").to_pylist())):
            text, ranges = text or b"", ranges or []
            # Starts outside the units that stayed are repeated, and so are those that the sort found.
            at, again = 0, [(r["first"], r["last"]) for r in ranges if not r["stays"]]
            for r in sorted((r["first"], r["last"]) for r in ranges if r["stays"]):
                if r[0] > at:
                    again.append((at, r[0]))
                at = max(at, r[1])
            if at < len(text) - LENGTH + 1:
                again.append((at, len(text) - LENGTH + 1))
            spans: list[dict] = []
            for first, last in sorted(again):
                if spans and first <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], last + LENGTH - 1)
                else:
                    spans.append({"start": first, "end": last + LENGTH - 1})
            edges = [0, *(x for span in spans for x in (span["start"], span["end"])), len(text)]
            ids.append(i)
            sizes.append(len(text))
            removed.append(spans)
            kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])) if spans else text)
            held += len(kept[-1])
            if held >= OUT_BYTES:
                yield given(ids, sizes, removed, kept, batch)
                ids, sizes, removed, kept, held = [], [], [], [], 0
        yield given(ids, sizes, removed, kept, batch)


def _owner() -> Column:
    """Documents as a key; a null id equals itself inside a struct."""
    return F.struct("doc_id", "mark").alias("owner")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` of each row: the spans removed and the bytes left.

    Texts are UTF-8 bytes, and positions count bytes. A string of 100 bytes is judged on the input, not on what is
    left of it, and never reaches over a text's end; the spans removed may cut a character, so ``kept`` is binary.
    Documents are ordered by id (null first), and those with one id by a hash of their text; rows with the
    same id and text are one document and get equal rows. Null and empty texts have no bytes. Other columns are
    ignored, an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    kind = source.schema["doc_id"].dataType.simpleString()
    owner = f"doc_id {kind}, mark long"
    units = source.mapInArrow(_units, f"digest binary, {owner}, first long, count long, anchors array<long>")
    earliest = F.min(F.struct("doc_id", "mark", "first", "count", "anchors")).alias("unit")
    stay = materialize(units.groupBy("digest").agg(earliest).select("unit.*"), "first-units", release=True)

    anchors = stay.select("doc_id", "mark", "first", F.explode("anchors").alias("anchor"))
    place = ["anchor", "doc_id", "mark", "first"]
    sorted_anchors = anchors.select(*place).repartitionByRange(*place).sortWithinPartitions(*place)
    again = sorted_anchors.mapInArrow(_repeated_anchors(block_members), f"anchor long, {owner}, first long, block long, split boolean")
    listed = F.collect_list(F.struct("first", "anchor", "block", "split")).alias("wanted")
    wanted = materialize(again.groupBy(_owner()).agg(listed), "repeated-anchors", release=True)
    cut = _with(source, wanted, "inner").mapInArrow(
        _segments, f"anchor long, block long, split boolean, {owner}, first long, lead long, bytes binary"
    )
    in_order = cut.repartition("anchor", "block").sortWithinPartitions("anchor", "block", "doc_id", "mark", "first")
    starts = materialize(in_order.mapInArrow(_sort_blocks, f"{owner}, first long, last long, digest binary"), "repeated-starts", release=True)

    # A class has one string per block at most here.
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("doc_id", "mark", "first"))
    met = starts.where("digest IS NOT NULL").withColumn("nth", nth).where("nth > 1")
    more = starts.where("digest IS NULL").unionByName(met.drop("nth")).select("doc_id", "mark", "first", "last", F.lit(False).alias("stays"))
    first = stay.select("doc_id", "mark", "first", (F.col("first") + F.col("count")).alias("last"), F.lit(True).alias("stays"))
    ranges = first.unionByName(more).groupBy(_owner()).agg(F.collect_list(F.struct("first", "last", "stays")).alias("ranges"))
    return _with(source, ranges, "left").mapInArrow(
        _cut, f"doc_id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    )


def _with(source: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """The texts with the list that belongs to each."""
    return source.withColumn("owner", _owner()).join(lists, "owner", how).drop("owner")


def passage_report(removed: DataFrame) -> DataFrame:
    """One digest row per document."""
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return removed.select(
        "doc_id",
        "n_bytes",
        size.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
