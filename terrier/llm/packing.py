"""Token sequences of a fixed capacity, packed by best fit and improved by swaps.

Documents are tokenized in Arrow tasks and cut where they exceed the capacity; a piece that fills a
sequence needs no packing. The other pieces, a few bytes each, are dealt at random into blocks of
about ``BLOCK_ITEMS``. A block is packed best fit decreasing; then local search takes the emptiest
sequence and moves its pieces into gaps, exchanges one for one or two for one, as long as that
increases the sum of the squared fills, until the sequence is empty or nothing helps. Sequences of all
blocks that stayed underfull are dealt anew and packed and searched once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.words import as_bytes
from terrier.session import materialize

CAPACITY = 2048
#: The id that ends each document.
END = 0
#: Pieces packed by one task; their number per block stays the same at every size.
BLOCK_ITEMS = 20_000
#: Bytes of text whose distinct words are tokenized together; bounds a task's memory.
BLOCK_BYTES = 8 << 20
#: Strings tokenized by one call.
STRINGS_AT_ONCE = 4000

#: Stands alone between strings; a string that holds it is tokenized by itself.
_MARK = "\0"
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
#: Letters, digits and other ASCII characters; bytes of longer characters are of no class at first.
_LETTER, _DIGIT, _OTHER, _LONG = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.int8)
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _LONG


def _normal(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte, and the bytes in lower case.

    Characters from U+00C0 to U+00FF are letters too, but for U+00D7 and U+00F7; those up to U+00DE are capitals.
    """
    kind, lower = _CLASS[data], data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] & 0xDF) != 0x97]
    kind[second - 1] = kind[second] = _LETTER
    lower[second[data[second] <= 0x9E]] += 32
    return kind, lower


def _strings(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings of ``data`` cut at ``offsets``, and which of them each string is."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _spread(index: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of a sequence of lists that lie in a row, and how many each member of it has."""
    lengths = sizes[index]
    begin = (np.cumsum(sizes) - sizes)[index]
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(begin - before, lengths), lengths


class WordIds:
    """Token ids of texts, as the tokenizer gives them for whole texts.

    A token never reaches over white space, nor over the edge of a pre-token: a run of letters, a
    digit, or a run of other characters. So a text's ids are those of its words in a row, and a word's those
    of its pre-tokens. Both are cut and put in lower case by array operations, and the distinct pre-tokens
    of a block are tokenized many at a time; the last token of each is marked as a word end. Words with other
    letters than those of Latin-1, with an apostrophe (which may belong to a pre-token with letters) or with what
    may be a special token are tokenized whole, with a mark between them; special tokens are found there as
    they are in texts.
    """

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        (self.mark,) = self.encode(_MARK)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.without_normalizer = Tokenizer.from_file(tokenizer_path)
        self.without_normalizer.normalizer = normalizers.Sequence([])

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _of_strings(self, strings: list[bytes], cut: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings without white space in a row, and how many each has.

        ``cut`` strings are single pre-tokens in lower case.
        """
        found: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for first in range(0, len(strings), STRINGS_AT_ONCE):
            some = [x.decode("utf-8", "replace") for x in strings[first : first + STRINGS_AT_ONCE]]
            tokenizer, joined = (self.without_normalizer, " ".join(some)) if cut else (self.tokenizer, f" {_MARK} ".join(some))
            (encoded,) = tokenizer.encode_batch_fast([joined], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            if cut:
                last = np.flatnonzero(self.ends[ids])
                size, right = np.diff(last, prepend=-1), len(last) == len(some) and last[-1] == len(ids) - 1
            else:
                marks = np.flatnonzero(ids == self.mark)
                size, right = np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1, len(marks) == len(some) - 1
                ids = ids[ids != self.mark]
            if right:
                found.append(ids)
                sizes.append(size)
            else:  # one that holds the mark itself, or isn't what it seems
                alone = [self.encode(x) for x in some]
                found += alone
                sizes.append(np.array([len(x) for x in alone]))
        return np.concatenate([np.empty(0, "<u4"), *found]), np.concatenate([np.empty(0, np.int64), *sizes]).astype(np.int64)

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and how many each has."""
        if not len(words):
            return self._of_strings([], True)
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[: len(words) + 1]
        data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[: offsets[-1]]
        kind, lower = _normal(data)
        special = (data == ord("<")) & (np.append(data[1:], 0) == ord("|"))
        whole = np.add.reduceat((kind == _LONG) | (data == ord("'")) | special, offsets[:-1]) > 0
        inside = np.repeat(whole, np.diff(offsets))
        # Edges of pre-tokens: words, changes of class, every digit; words to be taken whole have none inside.
        edge = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))) & ~inside
        edge[offsets[:-1]] = True
        cuts = np.flatnonzero(edge)
        word_of = np.searchsorted(offsets, cuts, side="right") - 1
        parts, which = _strings(np.where(inside, data, lower), np.append(cuts, len(data)))
        # A string that occurs both as a word to be taken whole and as a part of one can't be: whole words hold what parts don't.
        as_whole = np.zeros(len(parts), dtype=bool)
        as_whole[which] = whole[word_of]
        listed = parts.to_pylist()
        by_kind = [self._of_strings([listed[i] for i in np.flatnonzero(as_whole == kind)], not kind) for kind in (False, True)]
        ids, counts = np.concatenate([x[0] for x in by_kind]), np.concatenate([x[1] for x in by_kind])
        rank = np.empty(len(parts), dtype=np.int64)
        rank[np.concatenate([np.flatnonzero(~as_whole), np.flatnonzero(as_whole)])] = np.arange(len(parts))
        places, lengths = _spread(rank[which], counts)
        return ids[places], np.bincount(word_of, weights=lengths, minlength=len(words)).astype(np.int64)

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, each with the end id after it, and how many each has."""
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        inside = ~_GAP[data]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        starts, ends = edges[0::2], edges[1::2]  # the last byte is a space, so every word ends
        distinct, which = _strings(data[inside], np.concatenate(([0], np.cumsum(ends - starts))))
        ids, sizes = self._of_words(distinct)
        # The end id is one more word, which follows each text's own.
        ids, sizes = np.append(ids, np.uint32(END)).astype("<u4"), np.append(sizes, 1)
        text_starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[:-1]
        first_word = np.append(np.searchsorted(starts, text_starts), len(starts))
        places, lengths = _spread(np.insert(which, first_word[1:], len(distinct)), sizes)
        last = np.cumsum(lengths)[first_word[1:] + np.arange(len(texts))]
        return ids[places], np.diff(np.concatenate(([0], last)))


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(tokenizer_path: str) -> WordIds:
    """The worker's own tokenizer; it lasts from task to task."""
    if tokenizer_path not in _WORD_IDS:
        _WORD_IDS[tokenizer_path] = WordIds(tokenizer_path)
    return _WORD_IDS[tokenizer_path]


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_BYTES or i + 1 == len(texts):
            yield start, i + 1
            start, size = i + 1, 0


def _pieces(tokenizer_path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer_path)
        for batch in batches:
            texts = [text or b"" for text in as_bytes(batch.column(1))]
            for first, last in _blocks(texts):
                ids, counts = ids_of.texts(texts[first:last])
                pieces = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(counts[owner] - start, capacity)
                at = (np.cumsum(counts) - counts)[owner] + start
                data = memoryview(ids).cast("B")
                checks = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner + first)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(checks, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and the end id, cut at the capacity.

    A null or empty text is the end id alone; repeated rows are documents of their own. A special token's
    string in a text is that token, as it is to the tokenizer by default.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        _pieces(tokenizer_path, capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: largest items first, each into the bin with the smallest gap that holds it."""
    bins = np.zeros(len(sizes), dtype=np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g is set if there is a bin with gap g
    used = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = gaps >> size
        if fitting:
            gap = size + ((fitting & -fitting).bit_length() - 1)
            into = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
        else:
            gap, into, used = capacity, used, used + 1
        bins[i] = into
        left = gap - size
        by_gap[left].append(into)
        gaps |= 1 << left
    return bins


def _best_change(sizes: np.ndarray, place: np.ndarray, gap: np.ndarray, source: int) -> tuple | None:
    """The change that fills another bin best: items of ``source`` to give, the item to take (or -1), the bin.

    Moving ``d`` tokens out of a bin into bin B raises the sum of squared fills by
    ``2 * d * (fill[B] - fill[source] + d)``, which is positive for every d above 0 if B is no emptier.
    """
    own = np.flatnonzero(place == source)
    able = (gap > 0) & (gap <= gap[source])
    able[source] = False
    open_bins = np.flatnonzero(able)
    if not len(open_bins):
        return None
    by_gap = open_bins[np.argsort(gap[open_bins], kind="stable")]
    at = np.searchsorted(gap[by_gap], sizes[own])
    fits = at < len(by_gap)
    if fits.any():  # move one
        left = np.where(fits, gap[by_gap[np.minimum(at, len(by_gap) - 1)]] - sizes[own], np.iinfo(np.int64).max)
        x = int(left.argmin())
        return (int(own[x]),), -1, int(by_gap[at[x]])
    others = np.flatnonzero(able[place])
    room = gap[place[others]] + sizes[others]  # what may come in where this item goes out
    order = np.argsort(room, kind="stable")
    others, room = others[order], room[order]
    first, second = np.triu_indices(len(own), 1)
    given = np.concatenate((sizes[own], sizes[own[first]] + sizes[own[second]]))  # one for one, two for one
    # The tightest room whose item is smaller than what is given.
    at = _first_below(sizes[others], np.searchsorted(room, given), given)
    fits = at < len(room)
    if not fits.any():
        return None
    left = np.where(fits, room[np.minimum(at, len(room) - 1)] - given, np.iinfo(np.int64).max)
    j = int(left.argmin())
    items = (int(own[j]),) if j < len(own) else (int(own[first[j - len(own)]]), int(own[second[j - len(own)]]))
    taken = int(others[at[j]])
    return items, taken, int(place[taken])


def _first_below(values: np.ndarray, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each start ``at`` the first place from there on whose value is below its limit, or the end."""
    n = len(values)
    at = at.copy()
    inside = np.minimum(at, max(n - 1, 0))
    for _ in range(4):  # mostly it is near
        wrong = np.flatnonzero((at < n) & (values[inside] >= limit)) if n else np.empty(0, dtype=np.int64)
        if not len(wrong):
            return at
        at[wrong] += 1
        inside[wrong] = np.minimum(at[wrong], n - 1)
    # Least values of 1, 2, 4, ... places; steps over all stretches without a value below the limit.
    least = [values]
    while 2 ** len(least) <= n:
        half = 2 ** (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    for level in range(len(least) - 1, -1, -1):
        size = 2**level
        can = np.flatnonzero(at + size <= n)
        over = can[least[level][at[can]] >= limit[can]]
        at[over] += size
    return at


def improve(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Local search: empties the emptiest bins by changes that raise the sum of squared fills.

    Ends when the bins are as few as the tokens need, or when a pass over all open bins finds no
    change any more; it does end, because the sum rises with every change.
    """
    place = bins.copy()
    fewest = -(-int(sizes.sum()) // capacity)
    fill = np.bincount(place, weights=sizes).astype(np.int64)
    changed = True
    while changed and np.count_nonzero(fill) > fewest:
        changed, tried = False, np.zeros(len(fill), dtype=bool)
        while np.count_nonzero(fill) > fewest:
            ahead = np.where((fill > 0) & (fill < capacity) & ~tried, fill, capacity)
            source = int(ahead.argmin())
            if ahead[source] == capacity:
                break
            tried[source] = True
            while fill[source]:
                change = _best_change(sizes, place, np.where(fill > 0, capacity - fill, 0), source)
                if change is None:
                    break
                given, taken, into = change
                place[list(given)] = into
                if taken >= 0:
                    place[taken] = source
                moved = int(sizes[list(given)].sum()) - (int(sizes[taken]) if taken >= 0 else 0)
                fill[into] += moved
                fill[source] -= moved
                changed = True
    return place


def _pack_block(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("uid").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, sizes = ids[order], table.column("length").to_numpy()[order]
        bins = improve(sizes, best_fit(sizes, capacity), capacity)
        by_bin = np.lexsort((ids, bins))
        sorted_bins, lengths = bins[by_bin], sizes[by_bin]
        starts = np.flatnonzero(np.concatenate(([True], sorted_bins[1:] != sorted_bins[:-1])))
        counts = np.diff(np.append(starts, len(sorted_bins)))
        ends = np.cumsum(lengths)
        first = np.repeat((ends - lengths)[starts], counts)
        return pa.table(
            {
                "uid": ids[by_bin],
                "length": lengths,
                "bin": np.repeat(ids[by_bin][starts], counts),
                "offset": ends - lengths - first,
                "fill": np.repeat(np.add.reduceat(lengths, starts), counts),
            }
        )

    return run


def _pack(items: DataFrame, capacity: int, salt: int) -> DataFrame:
    """``uid, length, bin, offset, fill``; a bin is named by one of its items."""
    n = items.count()
    blocks = max(1, -(-n // BLOCK_ITEMS))
    dealt = items.withColumn("block", F.pmod(F.xxhash64(F.lit(salt), "uid"), F.lit(blocks)).cast("int"))
    packed = dealt.groupBy("block").applyInArrow(_pack_block(capacity), "uid long, length long, bin long, offset long, fill long")
    return materialize(packed, "packed-blocks")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless and hold at most ``capacity`` tokens."""
    rows = materialize(pieces.withColumn("uid", F.monotonically_increasing_id()), "token-pieces")
    first = _pack(rows.where(F.col("length") < capacity).select("uid", "length"), capacity, 1)
    second = _pack(first.where(F.col("fill") < capacity).select("uid", "length"), capacity, 2)
    placed = first.where(F.col("fill") == capacity).select("uid", "bin", "offset").unionByName(second.select("uid", "bin", "offset"))
    full = rows.where(F.col("length") == capacity).select("uid", F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"))
    return rows.join(placed.unionByName(full), "uid").select(*pieces.columns, F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document, with its sequence and place. An empty table gives no rows."""
    return pack(token_pieces(docs, tokenizer_path, id_col, text_col, capacity), capacity)
