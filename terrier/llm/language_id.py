"""Language identification by rank-order profiles of character n-grams.

Letters are compared in lower case, everything between them is one boundary. A profile is the list of
the most frequent 1- to 3-grams of a language by rank. A document is compared with each profile by the
out-of-place distance: for each of its own most frequent n-grams the difference of the two ranks, or
the profile's length where the profile lacks it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: N-grams in a profile and, at most, of a document.
PROFILE = 400
#: Expected number of labelled documents per language from which a profile is learnt.
SAMPLE = 3000
UNKNOWN = "und"
_BOUNDARY = 1


def _letters() -> np.ndarray:
    """The lower-case code point of each letter, the boundary for any other code point."""
    table = np.full(0x110000, _BOUNDARY, dtype=np.int64)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Lower-case letters of a text with one boundary between, before and after words; empty without letters."""
    if not _TABLE:
        _TABLE.append(_letters())
    codes = _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    padded = np.concatenate(([_BOUNDARY], codes, [_BOUNDARY]))
    kept = padded[np.concatenate(([True], (padded[1:] != _BOUNDARY) | (padded[:-1] != _BOUNDARY)))]
    return kept if len(kept) > 1 else kept[:0]


def ngrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams (21 bits a character) and their counts; boundaries alone don't count."""
    two = (codes[:-1] << 21) | codes[1:]
    three = (two[:-1] << 21) | codes[2:]
    return np.unique(np.concatenate((codes[codes != _BOUNDARY], two, three)), return_counts=True)


def most_frequent(grams: np.ndarray, counts: np.ndarray, limit: int = PROFILE) -> np.ndarray:
    """The ``limit`` most frequent n-grams by rank; ties go by the n-gram itself."""
    if len(grams) > limit:
        least = np.partition(counts, len(counts) - limit)[len(counts) - limit]
        near = counts >= least
        grams, counts = grams[near], counts[near]
    return grams[np.lexsort((grams, -counts))][:limit]


class Profiles:
    """Profiles of all languages side by side, for comparing a document with all at once."""

    def __init__(self, profiles: dict[str, list[int]]) -> None:
        self.languages = sorted(profiles)
        self.grams = np.unique(np.concatenate([np.array(profiles[x], dtype=np.int64) for x in self.languages] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.languages), len(self.grams) + 1), -1, dtype=np.int64)
        for i, name in enumerate(self.languages):
            self.ranks[i, np.searchsorted(self.grams, profiles[name])] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language, and one minus its distance as a share of the largest possible distance."""
        codes = symbols(text) if text else np.zeros(0, np.int64)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        top = most_frequent(*ngrams(codes))
        place = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        place = np.where(self.grams[place] == top, place, len(self.grams))
        rank = self.ranks[:, place]
        apart = np.where(rank < 0, PROFILE, np.minimum(np.abs(rank - np.arange(len(top))), PROFILE)).sum(axis=1)
        best = int(apart.argmin())
        return self.languages[best], float(1 - apart[best] / (PROFILE * len(top)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts per language of a partition; what one partition keeps grows with distinct n-grams only."""
    totals: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = symbols(text) if text else ()
            if len(codes):
                grams, counts = ngrams(codes)
                total = totals.setdefault(lang, Counter())
                for gram, n in zip(grams.tolist(), counts.tolist()):
                    total[gram] += n
    for lang, total in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(total), pa.string()), pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
            ["lang", "gram", "n"],
        )


def is_held_out(id_col: str) -> Column:
    """Documents that are never learnt from: a quarter by checksum of the id. Rows without id count among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> dict[str, list[int]]:
    """The profile of each language from labelled documents that aren't held out.

    Of each language about ``sample`` documents are used, chosen by a hash of the id, or all if there
    are fewer. Languages are a short list by nature; a profile has ``PROFILE`` numbers.
    """
    known = docs.where(F.col(lang_col).isNotNull() & ~is_held_out(id_col)).select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    shares = {r["lang"]: sample / r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return {}
    share = F.try_element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("lang"))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    counted = drawn.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Spark limits each language's rows before the shuffle, so a profile is all that a task orders.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE).orderBy("lang", "rank").collect()
    return {lang: [r["gram"] for r in ranked if r["lang"] == lang] for lang in sorted({r["lang"] for r in ranked})}


def _predict(profiles: dict[str, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = Profiles(profiles)
        for batch in batches:
            found = [compare.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row; ``und`` and 0 for texts without a letter.

    Null texts, repeated rows and rows without id get a row each; other columns are ignored. Without
    profiles every text is ``und``.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), is_held_out(id_col).alias("held_out"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_predict(profiles), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` with a language found and a score of ``least`` or more, as they are."""
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = Profiles(profiles)
        for batch in batches:
            found = [compare.predict(text.as_py()) for text in batch.column(at)]
            yield batch.filter(pa.array([name != UNKNOWN and score >= least for name, score in found], pa.bool_()))

    return docs.mapInArrow(run, schema)
