"""The registered text queries next to their SQL, and the pipeline stage by stage."""

import re

import corpus_pipeline
import pytest

from compare import compare, connect
from terrier.llm import line_dedup
from terrier.llm.registered import ORACLES, QUERIES
from test_text_scans import plain_windows
from test_words_and_dedup import brute_components, brute_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    same, note = compare(spark, con, name, SF)
    assert same, note


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_every_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, "12 -- 34", None, None, 8), (10**6 + 1, None, None, "src0", None), (None, "the of and to", "en", "src1", 13)], docs.schema)
    docs, kept = docs.unionByName(odd), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert after.columns == docs.columns
        kept.append((docs.collect(), after.collect()))
        docs = after
    before, after = kept[0]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {10**6, 10**6 + 1}
    before, after = kept[1]
    want = brute_lines([(r["doc_id"], r["text"], r["source"]) for r in before], line_dedup.MAX_SHARE, line_dedup.MIN_PAGES)
    assert sorted(((str(r["doc_id"]), r["text"]) for r in after)) == sorted((str(i), t) for i, t in want)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = kept[2]
    components = brute_components([(r["doc_id"], r["text"]) for r in before], 5, 80)
    stay = {i for i, (_, root) in components.items() if i == root} | {None}
    assert {r["doc_id"] for r in after} == stay and len(after) == len(stay)
    before, after = kept[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = plain_windows([(r["doc_id"], r["text"]) for r in before], items)
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r, (n, hit, _) in zip(before, judged) if not (hit and 20 * hit >= n)}
    before, after = kept[4]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    fill = {}
    for r in after:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
