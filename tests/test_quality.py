import json

import pytest

from terrier.operators import quality
from terrier.operators.changes import changed_sources, dataset_marks, remember
from terrier.sources.tables import manifest_baseline, missing_partitions

POINTS = "dept string, latitude double, longitude double"


def bounds(spark, rows):
    stats = quality.measure(spark.createDataFrame(rows, POINTS), "dpe")
    return {r["dept"]: r["niveau"] for r in quality.bounds_findings(stats).collect()}


def test_bounds(spark):
    rows = [("974", 56.0 + i, -3.0) for i in range(3)] + [("971", 16.05, -61.57), ("971", 18.08, -63.08), ("33", 16.05, -61.57)]
    rows += [("75", 48.0, 2.0)] * 2000 + [("75", 0.0, 0.0)]
    rows += [("92", 48.0, 2.0)] * 50 + [("92", 83.5, 2.0)] * 50
    rows += [("48", None, None), ("2A", 42.0, None), ("988", -22.0, 166.0)]
    assert bounds(spark, rows) == {
        "974": "echec",
        "971": "ok",
        "33": "echec",
        "75": "avertissement",
        "92": "echec",
        "48": "avertissement",
        "2A": "ok",
        "988": "ok",
    }


def test_exactly_one_percent_blocks(spark):
    assert bounds(spark, [("75", 48.0, 2.0)] * 99 + [("75", 0.0, 2.0)]) == {"75": "echec"}


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, dept string")


def test_volume_and_presence(spark):
    tables = {"dvf": spark.createDataFrame([("48", 44.5, 3.5)], POINTS)}
    expected = pairs(spark, ("dvf", "48"), ("dvf", "67"), ("dvf", "33"), ("dpe", "67"), ("dpe", None), ("bdnb", None), ("dvf", None))
    found = {(r["controle"], r["source"], r["dept"]): r["niveau"] for r in quality.check(tables, expected).collect()}
    assert found == {
        ("volume", "dvf", "48"): "ok",
        ("volume", "dvf", "67"): "ok",
        ("volume", "dvf", "33"): "echec",
        ("volume", "dpe", "67"): "echec",
        ("emprise", "dvf", "48"): "ok",
        ("presence", "dvf", "67"): "echec",
        ("presence", "dvf", "33"): "echec",
        ("presence", "dpe", "67"): "echec",
        ("presence", "dpe", None): "echec",
        ("presence", "bdnb", None): "echec",
    }


def test_only_sales_produced_is_blocked_when_more_was_asked(spark):
    tables = {"dvf": spark.createDataFrame([("48", 44.5, 3.5)], POINTS)}
    with pytest.raises(ValueError, match="dpe"):
        quality.require_publishable(quality.check(tables, pairs(spark, ("dvf", None), ("dpe", None))))
    quality.require_publishable(quality.check(tables, pairs(spark, ("dvf", None))))
    with pytest.raises(ValueError, match="no dataset"):
        quality.require_publishable(quality.check(tables).limit(0))


def test_regression(spark):
    counts = {"01": (100, 1000), "02": (1100, 1000), "03": (900, 1000), "04": (800, 1000), "05": (799, 1000), "06": (5, 0), "07": (5, None)}
    rows = [(d, float(i)) for d, (n, _) in counts.items() for i in range(n)] + [("08", 1.0)]
    stats = quality.measure(spark.createDataFrame(rows, "dept string, v double"), "dvf")
    baseline = spark.createDataFrame([("dvf", d, b) for d, (_, b) in counts.items()], "source string, dept string, lignes long")
    got = {r["dept"]: r["niveau"] for r in quality.regression_findings(stats, baseline).collect()}
    assert got == {"01": "echec", "02": "ok", "03": "avertissement", "04": "avertissement", "05": "echec", "06": "ok", "07": "ok"}
    # A table without coordinates has no bounds to check.
    assert quality.bounds_findings(stats).isEmpty()


def test_verdict(spark):
    tables = {"dvf": spark.createDataFrame([("48", 44.5, 3.5), ("33", 0.0, 0.0)], POINTS), "bdnb": spark.createDataFrame([("48", 1)], "dept string, n int")}
    got = {r["source"]: (r["verdict"], r["n_ok"], r["n_echecs"]) for r in quality.verdict(quality.check(tables), ["source"]).collect()}
    assert got == {"dvf": ("bloque", 3, 1), "bdnb": ("publiable", 1, 0)}


def test_manifest_baseline(spark):
    files = [
        {"fichier": "dept-33.parquet", "lignes": 120000, "octets": 1, "sha256": "a"},
        {"fichier": "dept-33.csv.gz", "octets": 1, "sha256": "b"},
        {"fichier": "dept=2A/part-0.parquet", "lignes": 7},
        {"fichier": "dept=2A/part-1.parquet", "lignes": 8},
    ]
    text = json.dumps({"millesime": "m", "sources": {"dvf": {"fichiers": files}, "dpe": {"fichiers": []}}})
    got = manifest_baseline(spark.createDataFrame([(text,)], "value string")).collect()
    assert {(r["source"], r["dept"], r["lignes"]) for r in got} == {("dvf", "33", 120000), ("dvf", "2A", 15)}


def test_missing_partitions(spark):
    asked = pairs(spark, ("dvf", "33"), ("dvf", "48"), ("dpe", "33"))
    there = pairs(spark, ("dvf", "33"), ("dvf", "33"))
    assert {tuple(r) for r in missing_partitions(asked, there).collect()} == {("dvf", "48"), ("dpe", "33")}
    assert missing_partitions(asked, there, force=True).count() == 3


MARKS = "source string, etag string, last_modified string, size long"

TRUTH = [
    # seen (etag, modified, size), known, changed
    ("never", ("a", "d", 1), (None, None, None), True),
    ("only date known", ("a", "d", 1), (None, "d", None), True),
    ("same etag", ("a", "d2", 2), ("a", "d1", 1), False),
    ("other etag", ("b", "d1", 1), ("a", "d1", 1), True),
    ("etag lost, same date", (None, "d1", 2), ("a", "d1", 1), False),
    ("etag lost, other date", (None, "d2", 1), ("a", "d1", 1), True),
    ("size only, same", (None, None, 1), (None, "d", 1), False),
    ("size only, other", (None, None, 2), (None, "d", 1), True),
    ("size lost", (None, None, None), ("a", None, 1), True),
    ("no size on either side", (None, None, None), ("a", "d", None), False),
]


def test_change_detection(spark):
    seen = spark.createDataFrame([(n, *s) for n, s, _, _ in TRUTH] + [("new", "a", None, None)], MARKS)
    known = spark.createDataFrame([(n, *k) for n, _, k, _ in TRUTH] + [("gone", "z", None, None)], MARKS)
    got = {r["source"]: r["changed"] for r in changed_sources(seen, known).collect()}
    assert got == {n: c for n, _, _, c in TRUTH} | {"new": True}
    kept = {r["source"]: r["etag"] for r in remember(seen, known).collect()}
    assert kept["new"] == "a" and kept["gone"] == "z" and kept["other etag"] == "b" and kept["same etag"] == "a"


def test_data_date_counts(spark):
    rows = [("a", "2026-07-01", "2026-05-01", 15471503), ("b", None, "2026-05-01", 3), ("c", None, None, 3), ("d", "", "2026-05-01", None)]
    got = {r["source"]: r["etag"] for r in dataset_marks(spark.createDataFrame(rows, "source string, dataUpdatedAt string, updatedAt string, count long")).collect()}
    assert got == {"a": "2026-07-01:15471503", "b": "2026-05-01:3", "c": None, "d": "2026-05-01:None"}


def test_refusals_count_all_failures(spark):
    tables = {"dvf": spark.createDataFrame([("48", 44.5, 3.5)], POINTS)}
    expected = pairs(spark, *[("dpe", f"{n:03d}") for n in range(120)], ("dvf", "57"))
    with pytest.raises(ValueError, match=r"refused, 241 blocking check\(s\), the first 50"):
        quality.require_publishable(quality.check(tables, expected))


def test_bounds_name_the_expected_box(spark):
    stats = quality.measure(spark.createDataFrame([("971", 16.0, -61.5), ("971", 0.0, 0.0)], POINTS), "dvf")
    detail = quality.bounds_findings(stats).first()["detail"]
    assert detail["emprise_attendue"] == "15.7, 18.2, -63.2, -60.9" and detail["part_hors_emprise"] == "0.5"


def test_marks_are_kept_between_runs(spark, tmp_path):
    from terrier.plans.prepare import refresh_marks

    path = str(tmp_path / "marks")
    for etag, changed in (("a", True), ("a", False), ("b", True)):
        seen = spark.createDataFrame([("s", etag, None, None)], MARKS)
        assert {r["source"]: r["changed"] for r in refresh_marks(spark, seen, path).collect()} == {"s": changed}


def test_marks_survive_a_run_that_dies(spark, tmp_path, monkeypatch):
    from terrier.plans.prepare import refresh_marks
    from terrier.sources import ledger

    path = str(tmp_path / "marks")
    marks = lambda etag: spark.createDataFrame([("s", etag, None, None)], MARKS)
    refresh_marks(spark, marks("a"), path)

    def die(*_):
        raise RuntimeError("killed")

    for step in ("write", "trim"):
        with monkeypatch.context() as patch:
            patch.setattr(ledger, step, die)
            with pytest.raises(RuntimeError, match="killed"):
                refresh_marks(spark, marks("b"), path)
        # Written or not, the marks are there: the former ones, or the new ones with the former not yet removed.
        changed = {r["changed"] for r in refresh_marks(spark, marks("b"), path).collect()}
        assert changed == ({True} if step == "write" else {False})
