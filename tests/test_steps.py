"""What the larger queries write, read and sort by, on the smallest driver tables."""

import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from fixtures import SALE, sale_lines
from terrier import session
from terrier.operators.sales import collapse, market_sales, typed_lines
from terrier.operators.sources import prefer_later_sources, sale_match_key
from terrier.plans import prepare
from terrier.registry import queries
from terrier.sources import coverage, delimited

SF = "/root/testdata/sf0.001"


def written(monkeypatch, name, spark):
    """Columns of each table that a query stages."""
    seen, write = {}, queries.materialize

    def noted(df, label, *rest):
        seen[label] = df.columns
        return write(df, label, *rest)

    monkeypatch.setattr(queries, "materialize", noted)
    queries.REGISTERED[name](spark, SF)
    return seen


def test_enrichment_stages_what_it_joins(spark, monkeypatch):
    seen = written(monkeypatch, "sale_enrichment", spark)
    assert set(seen["sales"]) == {"id_mutation", "id_parcelle", "date_mutation", "code_departement"}


def lines_of(spark, *rows):
    return delimited.complete_sale_lines(sale_lines(spark, [{**SALE, **r} for r in rows]))


def test_wide_lines_are_sorted_by_digests(spark):
    both = [lines_of(spark, {"id_mutation": "1"}), lines_of(spark, {"id_mutation": "2"})]
    kept = prefer_later_sources(both, sale_match_key())
    assert "_m_digest" in kept._jdf.queryExecution().analyzed().toString().split("LeftAnti, ")[1].split("<=>")[0]
    sales = collapse(typed_lines(market_sales(both[0])))
    grouped = sales._jdf.queryExecution().analyzed().toString().split("Aggregate [")[1]
    assert grouped.startswith("xxhash64(id_mutation")


def test_digest_keeps_equal_keys_equal(spark):
    """Prices that are one number in two spellings, zero with either sign, and missing values."""
    odd = [{"valeur_fonciere": "-0.0"}, {"valeur_fonciere": "1e3"}, {"valeur_fonciere": None, "date_mutation": None}]
    same = [{"valeur_fonciere": "0"}, {"valeur_fonciere": "1000.00"}, {"valeur_fonciere": None, "date_mutation": None}]
    older = lines_of(spark, *[{**r, "id_mutation": f"a{i}"} for i, r in enumerate(odd)], {"id_mutation": "alone", "valeur_fonciere": "7"})
    newer = lines_of(spark, *[{**r, "id_mutation": f"b{i}"} for i, r in enumerate(same)])
    kept = prefer_later_sources([older, newer], sale_match_key()).collect()
    assert sorted(r["id_mutation"] for r in kept) == ["alone", "b0", "b1", "b2"]


def test_departments_are_read_from_the_lines_once(spark, monkeypatch):
    calls, read = [], coverage.departments_of
    monkeypatch.setattr(coverage, "departments_of", lambda *a: calls.append(a) or read(*a))
    queries.coverage_record(spark, SF)
    assert len(calls) == 1


def test_joint_report_stages_what_it_counts(spark, monkeypatch):
    seen = written(monkeypatch, "joint_report", spark)
    assert "valeur_fonciere" not in seen["sales"] and "emprise_sol" not in seen["buildings"]


def landed(monkeypatch, tmp_path, query, spark):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    assert query(spark, SF).count() > 0
    return [p.name for p in Path(tmp_path).rglob("part-*")]


def test_union_reads_compressed_landings(spark, monkeypatch, tmp_path):
    names = landed(monkeypatch, tmp_path, queries.scan_union_by_name, spark)
    assert names and all(n.endswith(".csv.gz") for n in names)


def test_tagged_landings_are_compressed(spark, monkeypatch, tmp_path):
    names = landed(monkeypatch, tmp_path, queries.source_priority_tag, spark)
    assert names and all(n.endswith(".csv.gz") for n in names)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_joint_report_sorts_no_links(spark, monkeypatch):
    """The parcels behind the report come from one combining aggregate of the links."""
    plans, write = [], queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, label, *rest: plans.append((label, optimized(df))) or write(df, label, *rest))
    queries.joint_report(spark, SF)
    plan = dict(plans)["parcels-won"]
    assert "Window" not in plan and plan.count("Aggregate [") == 1 and "Aggregate [parcelle_id" in plan


def test_orders_are_written_as_text_before_they_meet_their_lines(spark):
    above, below = optimized(queries.collapsed(spark, SF)).split("Join Inner")
    assert " AS id_mutation" not in above and " AS id_mutation" in below


def orders_with_lines(spark, root):
    """Sales on both sides of the official window, with twins, lines that come twice, and keys that are missing or met nowhere."""
    days = [datetime(1996, 12, 30), datetime(1997, 1, 1), datetime(1997, 6, 2), None]
    orders = [(k, days[k % 4], 1000.0 + k // 8, "5-LOW" if k % 7 == 0 else "1-URGENT") for k in range(1, 60)]
    orders += [(None, days[0], 5.0, "1-URGENT"), (200, days[1], None, None), orders[4]]
    lines = [(k, k % 5 + 1, n % 3 + 1, n, 10.0 + n, "R" if n == 2 else "N") for k in [*range(1, 70), 200] for n in range(1, 4)]
    lines += [lines[8], (None, 1, 1, 1, 1.0, "N"), (9, None, None, None, None, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string"
    spark.createDataFrame(lines, kinds).write.parquet(f"{root}/lineitem.parquet")


def test_consolidation_in_pieces_leaves_only_the_sales(spark, monkeypatch, tmp_path):
    """The same sales as in one go; what is left to the reader is a ranking of staged rows, and the lines are gone."""
    root, paths, write = str(tmp_path), [], session.scratch_path
    orders_with_lines(spark, root)
    whole = prepare.sales_from_lines(prepare.effective_lines(queries.two_sources(spark, root)), 100)
    whole = queries.rounded(whole, surface_bati=2, surface_terrain=2, longitude=6, latitude=6)
    monkeypatch.setattr(prepare, "PIECE_LINES", 50)
    monkeypatch.setattr(session, "scratch_path", lambda spark, label: paths.append(write(spark, label)) or paths[-1])
    got = queries.consolidated_sales(spark, root)
    assert "Join" not in optimized(got) and "Aggregate" not in optimized(got)
    assert [Path(p).name.rsplit("-", 1)[0] for p in paths] == ["sale-lines", "lines-left", "collapsed-sales"]
    assert [Path(p).exists() for p in paths] == [False, False, True]
    assert all(p.name.endswith(".zstd.parquet") for p in Path(paths[-1]).glob("part-*"))
    assert got.columns == whole.columns and {str(r["id_mutation"])[0] for r in got.collect()} == {"1", "A", "N"}
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_precedence_in_pieces_is_that_of_the_whole(spark):
    """Also for missing keys and prices in two spellings; a line that is not kept takes precedence all the same."""
    days = ["2019-01-01", "2019-01-02", None]
    older = [{"id_mutation": f"a{i}", "date_mutation": days[i % 3], "valeur_fonciere": ["0", "1e3", None, "n.c.", "7"][i % 5]} for i in range(30)]
    newer = [{"id_mutation": "b0", "date_mutation": days[0], "valeur_fonciere": "-0.0"}]
    newer += [{"id_mutation": "b1", "date_mutation": days[1], "valeur_fonciere": "1000", "nature_mutation": "Echange"}]
    newer += [{"id_mutation": "b2", "date_mutation": None, "valeur_fonciere": None}]
    both = [lines_of(spark, *older, older[0]), lines_of(spark, *newer)]
    only = F.col("nature_mutation") == "Vente"
    whole = prefer_later_sources(both, sale_match_key(), tag="p").filter(only)
    for pieces in (1, 3):
        got = prefer_later_sources(both, sale_match_key(), tag="p", only=only, pieces=pieces)
        assert got.columns == whole.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    kept = {r["id_mutation"] for r in got.collect()}
    assert {"b0", "b2", "a4"} <= kept and not {"b1", "a0", "a1"} & kept


def test_pieces_drop_their_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    rows, before = spark.range(1000).withColumn("k", F.col("id") % 7), shuffled()
    pieces = [p.groupBy("k").count() for p in session.in_pieces(rows, F.xxhash64("k"), 4)]
    found = session.materialize_pieces(pieces, "counted")
    assert len(pieces) == 4 and sorted(map(tuple, found.collect())) == sorted((k, len(range(k, 1000, 7))) for k in range(7))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
