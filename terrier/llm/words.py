"""Words and word shingles of UTF-8 texts as 64-bit hashes, for use inside Arrow tasks.

A word is a run of bytes other than ASCII white space; letters A-Z count as a-z. All texts of a
block are hashed together by array operations: every byte selects a random number that depends on
its value and place in the word, and a word's hash is the mixed sum of them (tabulation hashing).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a longer text forms a block of its own.
BLOCK_BYTES = 1 << 20
_PLACES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    numbers = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(_PLACES, 256)
    numbers[:, 65:91] = numbers[:, 97:123]
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return numbers, space


_NUMBERS, _SPACE = _tables()


def as_bytes(column: pa.Array) -> list:
    """UTF-8 bytes (or None) of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def blocks(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``BLOCK_BYTES`` together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= BLOCK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def hash_words(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the number of words of each text (None has none)."""
    joined = b" ".join(t or b"" for t in texts) + b" "
    data = np.frombuffer(joined, dtype=np.uint8)
    gap = _SPACE[data]
    inside = ~gap
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]  # the last byte is a space, so every word ends
    lengths = ends - starts
    text_starts = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts])))[:-1]
    counts = np.diff(np.concatenate((np.searchsorted(starts, text_starts), [len(starts)])))
    if not len(starts):
        return np.empty(0, dtype=np.uint64), counts
    letters = data[inside]
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(letters), dtype=np.int64) - np.repeat(firsts, lengths)
    value = _NUMBERS.ravel()[((place & (_PLACES - 1)) << 8) | letters]
    far = np.flatnonzero(place >= _PLACES)  # by the byte's own place only, so that a word's hash is the same in every block
    value[far] = mix(value[far] + (place[far] // _PLACES).astype(np.uint64))
    return mix(np.add.reduceat(value, firsts) + lengths.astype(np.uint64)), counts


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text, in order, and how many each text has.

    A text with fewer words is one shingle, one without words has none.
    """
    n = len(words)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    width = np.minimum(counts, size)[text]
    first = place + width <= counts[text]
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        if i >= n:
            break
        part = mix(total[: n - i] + words[i:])
        total[: n - i] = np.where(width[: n - i] > i, part, total[: n - i])
    return total[first], np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each text sorted and without repeats, and how many are left."""
    values = values.copy()
    ends = np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        values[start:end].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[(ends - counts)[counts > 0]] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    return values[new], kept[ends] - kept[ends - counts]


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow column with one list of signed 64-bit numbers per text."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))
