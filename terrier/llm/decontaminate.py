"""Benchmark decontamination with DataFrame functions only.

A window is 13 consecutive words of a benchmark item; an item with fewer words is one window. The
scan has two steps. Any occurrence of a window covers a run of a few words that starts at a multiple
of a stride in the document, so only those runs are hashed and looked up in the broadcast hash
set of all such runs of the benchmark. Each length of windows has its own stride, so a short item makes
nobody look at more runs on behalf of the long ones. Documents that pass are then cut into windows of the lengths
they passed for, which are compared with the benchmark's as text. A hash set too large to be broadcast at once
is broadcast part by part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.session import materialize

WINDOW = 13
#: Words in the runs of the first step.
RUN = 4
#: Windows broadcast at once (about 100 bytes each).
BROADCAST_WINDOWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_WITH_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Words of digits, letters and non-ASCII characters, A-Z in lower case; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAKS), "")


def _runs(words: str, length: Column | int, step: int, make) -> Column:
    """``make`` of each run of ``length`` words that starts at a multiple of ``step``."""
    last = F.size(words) - length + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: make(F.slice(words, i, length)))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(win, length, items)``: each distinct window as text and the items it comes from.

    Items without words give none; a window of items without id counts, but names no item.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("words"))
    items = items.withColumn("length", F.least(F.size("words"), F.lit(WINDOW))).where("length > 0")
    cut = items.select("item", "length", F.explode(_runs("words", F.col("length"), 1, lambda w: F.array_join(w, " "))).alias("win"))
    return cut.groupBy("win", "length").agg(F.collect_set("item").alias("items"))


def _key(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _same_row(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["h1"] == right["h1"]) & (left["h2"] == right["h2"])


def _numbered_windows(length: int) -> Column:
    """All windows of one length with their first word's number."""
    windows = _runs("words", length, 1, lambda w: F.array_join(w, " "))
    return F.transform(windows, lambda win, i: F.struct(win.alias("win"), i.alias("start"), F.lit(length).alias("length")))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, h1, h2, n_words, n_hit, items, spans``.

    ``h1, h2`` identify the text, ``items`` are the ids (as sorted strings) of the items with windows
    in it, ``spans`` the word ranges ``[start, end)`` of the windows found, ``n_hit`` the words inside
    any of them. Null and empty texts have no words; repeated rows and rows without id get a row each;
    an empty benchmark hits nothing; other columns are ignored.
    """
    source = docs.select(*_key(id_col, text_col), F.col(text_col).alias("text"))
    windows = materialize(benchmark_windows(benchmark, item_id_col, item_text_col), "benchmark-windows")
    n_windows, lengths = windows.agg(F.count("*"), F.sort_array(F.collect_set("length"))).first()
    parts = max(1, -(-n_windows // BROADCAST_WINDOWS))

    def looked_up(rows: DataFrame, hash_set: DataFrame, on: list[str]) -> DataFrame:
        """``rows`` beside what the hash set holds for them, which is broadcast in parts."""
        part = F.pmod(F.xxhash64(*on), F.lit(parts))
        return reduce(DataFrame.unionByName, [rows.join(F.broadcast(hash_set.where(part == n)), on) for n in range(parts)])

    def run_hash(length: int | Column):
        return lambda words: F.xxhash64(length if isinstance(length, Column) else F.lit(length), words)

    tokens = source.select("doc_id", "h1", "h2", word_list(F.col("text")).alias("words"))
    strided = [_runs("words", min(RUN, n), n - min(RUN, n) + 1, run_hash(n)) for n in lengths]
    runs = F.concat(F.array().cast("array<bigint>"), *strided)
    scanned = materialize(
        tokens.select("doc_id", "h1", "h2", F.size("words").cast("long").alias("n_words"), runs.alias("runs")), "scanned-runs"
    )
    of_benchmark = (
        windows.select("length", F.split("win", " ").alias("words"))
        .select("length", F.explode(_runs("words", F.least(F.lit(RUN), F.col("length")), 1, run_hash(F.col("length")))).alias("run"))
        .distinct()
    )
    suspects = (
        looked_up(scanned.select("doc_id", "h1", "h2", F.explode("runs").alias("run")), of_benchmark, ["run"])
        .groupBy(F.col("doc_id").alias("s_id"), F.col("h1").alias("s1"), F.col("h2").alias("s2"))
        .agg(F.collect_set("length").alias("lengths"))
    )
    held = source.join(
        suspects,
        F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")),
    ).select("doc_id", "h1", "h2", "lengths", word_list(F.col("text")).alias("words"))

    none = F.array().cast("array<struct<win:string,start:int,length:int>>")
    asked = [F.when(F.array_contains("lengths", n), _numbered_windows(n)).otherwise(none) for n in lengths]
    pieces = held.select("doc_id", "h1", "h2", F.explode(F.concat(none, *asked)).alias("piece")).select("doc_id", "h1", "h2", "piece.*")
    verified = looked_up(pieces, windows, ["win", "length"])
    reach = F.struct(F.col("start").alias("start"), (F.col("start") + F.col("length")).alias("end"))
    hits = verified.groupBy("doc_id", "h1", "h2").agg(
        F.sort_array(F.collect_set(reach)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    rows, hit = scanned.select("doc_id", "h1", "h2", "n_words").alias("d"), hits.alias("h")
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("last")),
        lambda acc, x: F.struct(
            (acc["words"] + F.greatest(F.lit(0), x["end"] - F.greatest(acc["last"], x["start"]))).alias("words"),
            F.greatest(acc["last"], x["end"]).alias("last"),
        ),
        lambda acc: acc["words"].cast("long"),
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.h1") == F.col("h.h1")) & (F.col("d.h2") == F.col("h.h2"))
    return rows.join(hit, same, "left").select(
        "d.doc_id",
        "d.h1",
        "d.h2",
        "n_words",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def is_contaminated() -> Column:
    """At least one hit, and hits in 5 % of the words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def _beside(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    same = (
        docs[id_col].eqNullSafe(found["found_id"])
        & (F.xxhash64(text) == found["found_h1"])
        & (F.xxhash64(F.lit(1), text) == found["found_h2"])
    )
    return docs.join(found, same, how)


def remove_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    found = contamination(docs, benchmark, id_col, text_col, **names).where(is_contaminated())
    keys = found.select(F.col("doc_id").alias("found_id"), F.col("h1").alias("found_h1"), F.col("h2").alias("found_h2")).distinct()
    return _beside(docs, keys, id_col, text_col, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """All rows of ``docs``; words inside benchmark windows, and the breaks before them, are cut out."""
    found = contamination(docs, benchmark, id_col, text_col, **names).where("n_hit > 0")
    keys = found.select(
        F.col("doc_id").alias("found_id"), F.col("h1").alias("found_h1"), F.col("h2").alias("found_h2"), F.col("spans").alias("found_spans")
    ).dropDuplicates(["found_id", "found_h1", "found_h2"])
    joined = _beside(docs, keys, id_col, text_col, "left")
    pieces = F.regexp_extract_all(docs[text_col], F.lit(_WORD_WITH_BREAK), F.lit(0))
    spans = keys["found_spans"]
    kept = F.filter(pieces, lambda _, i: ~F.exists(spans, lambda s: (i >= s["start"]) & (i < s["end"])))
    tail = F.substring(docs[text_col], F.length(F.array_join(pieces, "")) + 1, F.length(docs[text_col]))
    edited = F.when(spans.isNull(), docs[text_col]).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.select(*[edited.alias(c) if c == text_col else docs[c] for c in docs.columns])
