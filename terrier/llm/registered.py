"""The queries of this subpackage on the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.llm import conversation_trie, decontaminate, fingerprints, language_id, line_dedup, packing, periodic_runs
from terrier.llm import personal_data, repeated_passages, secrets, structure_oracles, token_counts, warc
from terrier.llm.near_dedup import near_duplicates
from terrier.session import scratch_path

#: Vocabulary files; a parameter of the operators, never part of the repository.
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are on more than a tenth of their source's documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate_lines(docs)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by base patterns and by formats learnt from what these find."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by base patterns and by a classifier trained under weak supervision."""
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of each document in a sequence of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under links of 3-word shingle sets at 85 % similarity."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives with repeated payloads stored once, and read back."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.resolve_revisits(pages), path)
    return warc.read_archives(spark, path, dict(pages.dtypes)["page_id"])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by rank-order profiles of the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside 13-word windows of the benchmark."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under a unigram model over a public vocabulary."""
    scores = token_counts.zipf_scores(token_counts.load_pieces(public_tokenizers.path(PIECES)))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), scores)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document, its edited text and the next document, with their likeness."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of each document, and digests of the texts without their repetitions."""
    docs = periodic_runs.planted_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.run_report(periodic_runs.collapse_runs(docs))


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document in strings of 100 bytes that start earlier in the corpus, and what is left."""
    return repeated_passages.passage_report(repeated_passages.remove_repeated(table(spark, sf_dir, "documents")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of conversations that share beginnings within families of twenty."""
    rebuilt = conversation_trie.rebuilt_conversations(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.as_paths(rebuilt))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_secret_scan,
        op3_personal_data,
        op4_best_fit_packing,
        op5_minhash_near_dedup,
        op6_warc_revisits,
        op7_language_id,
        op8_decontamination,
        op9_token_counts,
        op10_fingerprints,
        op11_periodic_runs,
        op12_repeated_passages,
        op13_conversation_trie,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_SHINGLE_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
            FROM documents),
        bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS body FROM lines),
        boilerplate AS (
            SELECT source, body FROM bare JOIN (SELECT source, count(*) AS total FROM documents GROUP BY source) USING (source)
            WHERE body <> '' GROUP BY source, body, total
            HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) > 0.1 * total),
        judged AS (
            SELECT bare.*, boilerplate.body IS NOT NULL AS gone
            FROM bare LEFT JOIN boilerplate ON bare.source = boilerplate.source AND bare.body = boilerplate.body)
        SELECT doc_id, source,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text,
               count(*) AS lines_before,
               count(*) FILTER (gone) AS lines_dropped
        FROM judged GROUP BY doc_id, source""",
    "op5_minhash_near_dedup": rf"""
        WITH RECURSIVE words AS (SELECT doc_id, {_SHINGLE_WORDS} AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
            FROM words),
        items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        common AS (
            SELECT a.doc_id AS i, b.doc_id AS j, a.n AS n, b.n AS m, count(*) AS c
            FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT i, j FROM common WHERE 100 * c >= 85 * (n + m - c)),
        both_ways AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, e.j FROM reached r JOIN both_ways e ON r.other = e.i)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
        FROM sets JOIN (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY doc_id) USING (doc_id)""",
    "op6_warc_revisits": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest FROM pages),
        firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM payloads GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM payloads JOIN firsts USING (payload_digest)""",
    "op8_decontamination": rf"""
        WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        items AS (SELECT item_id, w, least(len(w), 13) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
        scanned AS (
            SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items))),
        hits AS (SELECT doc_id, i, size, item_id FROM scanned JOIN windows USING (size, win)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_periodic_runs": structure_oracles.periodic_runs(),
    "op12_repeated_passages": structure_oracles.REPEATED_PASSAGES,
    "op13_conversation_trie": structure_oracles.CONVERSATION_TRIE,
}
