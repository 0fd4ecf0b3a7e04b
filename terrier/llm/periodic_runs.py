"""Runs of words that repeat with a period, found by string synchronising sets.

A run is a stretch of consecutive words with a smallest period q, at least ``4 * q`` words long, that
no neighbouring word extends. Periods 1 to 3 are found by comparing neighbours. For each t = 4, 8, ...
a position is in the synchronising set of scale t if the least hash of the t-grams at it and at the t
positions after it belongs to the first or the last of them. This depends on its next 2t words only,
so equal contexts are selected alike, and wherever the t-grams don't all lie in regions of a smaller
period, t positions in a row hold a selected one. t-grams inside regions found before, of period t/4 or
less, are left out, for there ties would select everything.

A run of period t <= q < 2t therefore holds a selected position and, q words on, its next selected
position with the same 2t words. Such pairs propose periods; comparing words extends each proposal
to its run or refutes it, so hashes decide only where to look.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.words import as_bytes, blocks, mix

#: A run is at least so many words long, and so many times its period.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Periods up to this one are found by comparing neighbours.
SMALL_PERIOD = 3

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _streaks(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def _marked(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` positions lie in one of the half-open ranges, which may overlap."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _shift(values: np.ndarray, by: int) -> np.ndarray:
    """``values[i + by]`` at i, and nothing beyond the end."""
    moved = np.full_like(values, _NONE)
    moved[: len(values) - by] = values[by:]
    return moved


def _small_periods(ids: np.ndarray, owner: np.ndarray) -> Iterator[np.ndarray]:
    for q in range(1, min(SMALL_PERIOD, len(ids) - 1) + 1):
        first, last = _streaks((ids[:-q] == ids[q:]) & (owner[:-q] == owner[q:]))
        long = last - first >= (LEAST_TIMES - 1) * q
        first, last = first[long], last[long] + q
        # A smaller period of so long a stretch divides q; 2 and 3 are prime, so it is 1.
        own = np.ones(len(first), dtype=bool) if q == 1 else (ids[first] != ids[first + 1]) | (ids[first] != ids[first + q - 1])
        yield np.stack((first[own], last[own], np.full(int(own.sum()), q)), axis=1)


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries are equal; looks at twice as many each time, no further than needed."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differs = np.flatnonzero(a[at : at + step] != b[at : at + step][: len(a[at : at + step])])
        if len(differs):
            return at + int(differs[0])
        at, step = at + step, 2 * step
    return n


def _proposals(hashes: np.ndarray, left: np.ndarray, owner: np.ndarray, omitted: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of selected positions and their next one with the same context, t to 2t apart."""
    ids = np.where((left >= t) & ~omitted, hashes, _NONE)
    least, width = ids, 1
    while width < t:
        least, width = np.minimum(least, _shift(least, width)), 2 * width
    least = np.minimum(least, _shift(ids, t))  # over t + 1 positions
    selected = np.flatnonzero((least != _NONE) & (left >= 2 * t) & ((least == ids) | (least == _shift(ids, t))))
    context = mix(hashes[selected] * _ODD + hashes[selected + t])
    by_context = np.argsort(context, kind="stable")
    place, context = selected[by_context], context[by_context]
    apart = np.diff(place)
    pair = (context[1:] == context[:-1]) & (apart >= t) & (apart < 2 * t) & (owner[place[1:]] == owner[place[:-1]])
    order = np.argsort(place[:-1][pair], kind="stable")
    return place[:-1][pair][order], apart[pair][order]


def find_runs(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows ``(text, start, length, period)`` of all runs in texts given as word numbers in a row.

    ``counts`` holds the number of words of each text; ``start`` counts from the text's first word.
    Rows are sorted by text, start and period.
    """
    ids, counts = np.asarray(ids, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    regions = np.concatenate([np.empty((0, 3), dtype=np.int64), *_small_periods(ids, owner)])
    # The arrays below hold the texts long enough for the scale at hand.
    place, whose, hashes, t = np.arange(len(ids)), owner, mix(ids.astype(np.uint64) * _ODD + np.uint64(1)), 1
    while True:
        long = counts[whose] >= LEAST_TIMES * t
        place, whose, hashes = place[long], whose[long], hashes[long]
        if not len(place):
            break
        if t > SMALL_PERIOD:
            small = regions[(regions[:, 2] * LEAST_TIMES <= t) & (regions[:, 1] - regions[:, 0] >= t)]
            small = small[counts[owner[small[:, 0]]] >= LEAST_TIMES * t]
            first = np.searchsorted(place, small[:, 0])
            omitted = _marked(len(place), first, first + (small[:, 1] - small[:, 0]) - t + 1)
            found, seen = [], {}
            for at, q in zip(*(x.tolist() for x in _proposals(hashes, ends[whose] - place, whose, omitted, t))):
                at = int(place[at])
                if at < seen.get(q, 0):
                    continue  # inside the stretch of an earlier proposal
                begin, end = int(ends[owner[at]] - counts[owner[at]]), int(ends[owner[at]])
                after = _matching(ids[at : end - q], ids[at + q : end])
                before = _matching(ids[begin:at][::-1], ids[begin + q : at + q][::-1])
                seen[q] = at + after
                if before + after + q >= LEAST_TIMES * q:
                    found.append((at - before, at + after + q, q))
            regions = np.concatenate([regions, np.array(found, dtype=np.int64).reshape(-1, 3)])
        hashes, t = mix(hashes * _ODD + _shift(hashes, t)), 2 * t
    regions = regions[regions[:, 1] - regions[:, 0] >= LEAST_WORDS]
    text = owner[regions[:, 0]]
    start = regions[:, 0] - (ends - counts)[text]
    rows = np.stack((text, start, regions[:, 1] - regions[:, 0], regions[:, 2]), axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _collapse(texts: list) -> pa.RecordBatch:
    """Words, runs and collapsed text of each text of a block."""
    words = [(text or b"").split() for text in texts]  # bytes are split at ASCII white space only
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for some in words for w in some], dtype=np.int64)
    counts = np.array([len(some) for some in words], dtype=np.int64)
    runs = find_runs(ids, counts)
    firsts = np.cumsum(counts) - counts
    begin = firsts[runs[:, 0]] + runs[:, 1]
    gone = _marked(len(ids), begin + runs[:, 3], begin + runs[:, 2])
    collapsed = [b" ".join(some) for some in words]
    for i in np.unique(runs[:, 0]).tolist():
        kept = ~gone[firsts[i] : firsts[i] + counts[i]]
        collapsed[i] = b" ".join(compress(words[i], kept.tolist()))
    offsets = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
    fields = pa.StructArray.from_arrays([pa.array(runs[:, c].copy()) for c in (1, 2, 3)], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), fields), pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["n_words", "runs", "collapsed"],
    )


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column(1))
        for first, last in blocks(texts):
            found = _collapse(texts[first:last])
            ids = batch.column(0).slice(first, last - first)
            yield pa.RecordBatch.from_arrays([ids, *found.columns], ["doc_id", *found.schema.names])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row; nothing is shuffled.

    Words are separated by ASCII white space and compared as they are written. ``runs`` holds the start
    (a word number), length and period of every run, by start and period; ``collapsed`` is the text
    without the words that a run repeats, the others joined by one space. A null or empty text has no
    words, no runs and an empty text. Repeated rows and rows without id get a row each, other columns
    are ignored, an empty table gives an empty result. A task holds a block of about 1 MiB of texts, or
    one longer text, whose words need some hundred bytes each.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        _run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def planted_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``, where a tenth of the texts, chosen by a checksum h of the id, repeat some of their words.

    With g = h / 10 (whole), the n words from word a = g % n on become repetitions of the p words there,
    p = 1 + (n - a) / (3 + g % 8). The other texts, and texts without id or words, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    cut = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    cut = cut.withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    cut = cut.withColumn("n", n).withColumn("a", F.when(n > 0, g % n))
    cut = cut.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(F.col("words"), place(i).cast("int")))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def run_report(collapsed: DataFrame) -> DataFrame:
    """One digest row per document: how many runs, the longest of them, and checksums of runs and text."""
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")))
    best = F.array_max(ranked)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return collapsed.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["back"]).alias("start"),
        best["length"].alias("length"),
        (-best["less"]).alias("period"),
        F.floor(1000 * best["length"] / -best["less"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
