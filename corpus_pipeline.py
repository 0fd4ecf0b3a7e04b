"""A corpus from raw documents to packed sequences; every stage is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrier.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from terrier.llm.registered import WORD_BPE, table
from terrier.session import scratch_path

#: A text must come this near to a language's profile (1 is the profile itself, 0 has nothing of it).
LEAST_LANGUAGE_SCORE = 0.05


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every language learnt from the labelled ones, go."""
    profiles = language_id.learn(docs)
    return language_id.keep_identified(docs, profiles, least=LEAST_LANGUAGE_SCORE)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; lines on more than a tenth of a source's documents are cut out of their texts.

    ``n_chars`` follows the text.
    """
    return line_dedup.drop_boilerplate_lines(docs, length_col="n_chars").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return near_dedup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark windows in a twentieth of their words or more go, the others stay as they are."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece with its sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Language profiles and swap-based packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage on all that the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
