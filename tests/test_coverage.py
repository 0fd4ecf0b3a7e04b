"""The record of covered departments: resuming, emptied departments, presence, and runs that die."""

import pytest

from fixtures import LINE_COLUMNS, SALE, diagnostics, write_buildings, write_csv
from terrier.operators import quality
from terrier.plans import export
from terrier.plans.prepare import prepare_buildings, prepare_diagnostics, prepare_joint, prepare_sales, publish, verify
from terrier.sources import coverage, ledger
from terrier.sources.coverage import Scope
from terrier.sources.tables import datasets, read_table

PLACES = {"33": ("415022", "6422103"), "988": ("400000", "300000"), None: (None, None)}


def pages(spark, *names):
    """A diagnostic per (number, department)."""
    rows = [
        {
            "numero_dpe": n,
            "code_departement_ban": d,
            "coordonnee_cartographique_x_ban": PLACES[d][0],
            "coordonnee_cartographique_y_ban": PLACES[d][1],
        }
        for n, d in names
    ]
    return diagnostics(spark, rows)


def held(spark, path):
    return {r["numero_dpe"]: r["dept"] for r in read_table(spark, path).collect()}


def test_unforced_run_takes_every_department_of_the_input(spark, tmp_path):
    out = str(tmp_path / "dpe")
    first = pages(spark, ("N1", "33"), ("N2", "988"), ("N3", None))
    prepare_diagnostics(spark, first, out, force=False)
    assert held(spark, out) == {"N1": "33", "N2": "988", "N3": None}
    assert coverage.covered_departments(spark, out) == {"33": 1, "988": 1, None: 1}
    # Everything is covered, so a second run changes nothing, and one with a new department adds that one only.
    runs = ledger.numbers(spark, f"{out}/{coverage.RECORD}")
    prepare_diagnostics(spark, pages(spark, ("M1", "33")), out, force=False)
    assert ledger.numbers(spark, f"{out}/{coverage.RECORD}") == runs
    out2 = str(tmp_path / "other")
    prepare_diagnostics(spark, pages(spark, ("N1", "33")), out2, force=False)
    prepare_diagnostics(spark, pages(spark, ("M1", "33"), ("M2", "988"), ("M3", None)), out2, force=False)
    assert held(spark, out2) == {"N1": "33", "M2": "988", "M3": None}


def test_full_rerun_empties_departments_that_are_gone(spark, tmp_path):
    out = str(tmp_path / "dpe")
    prepare_diagnostics(spark, pages(spark, ("N1", "33"), ("N2", "988"), ("N3", None)), out)
    prepare_diagnostics(spark, pages(spark, ("N2", "988")), out)
    assert held(spark, out) == {"N2": "988"}
    assert coverage.covered_departments(spark, out) == {"33": 0, "988": 1, None: 0}
    # A run over one department leaves the others alone, rows and record.
    prepare_diagnostics(spark, pages(spark, ("N4", "33")), out, departments="33")
    assert held(spark, out) == {"N2": "988", "N4": "33"}
    assert coverage.covered_departments(spark, out) == {"33": 1, "988": 1, None: 0}


def sale(n, dept):
    place = {"15": {}, "63": {"code_departement": "63", "code_commune": "63001"}, "67": {"code_departement": "67", "code_commune": "67001"}}[dept]
    return {**SALE, "id_mutation": n, **place}


def test_uncovered_register_is_excused_once_it_was_asked_for(spark, tmp_path):
    out = str(tmp_path / "out")
    path = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [sale("1", "15")])
    prepare_sales(spark, [[path]], f"{out}/dvf", departments="15,67")
    assert coverage.covered_departments(spark, f"{out}/dvf") == {"15": 1, "67": 0}
    expected = spark.createDataFrame([("dvf", "15"), ("dvf", "67")], "source string, dept string")
    found = {(r["controle"], r["dept"]): r["niveau"] for r in verify(spark, out, ["dvf"], expected).collect()}
    assert found == {("volume", "15"): "ok", ("volume", "67"): "ok", ("emprise", "15"): "ok"}
    # Another department that is asked for and stays empty blocks; one never asked for isn't there at all.
    prepare_sales(spark, [[path]], f"{out}/dvf", departments="63")
    with pytest.raises(ValueError, match="dvf/63 : aucune ligne"):
        verify(spark, out, ["dvf"])
    with pytest.raises(ValueError, match="presence: dvf/68"):
        verify(spark, out, ["dvf"], spark.createDataFrame([("dvf", "68")], "source string, dept string"))


def test_table_without_any_row(spark, tmp_path):
    out = str(tmp_path / "out")
    path = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [sale("1", "15")])
    report = prepare_sales(spark, [[path]], f"{out}/dvf", departments="67")
    assert report.count() == 0 and coverage.covered_departments(spark, f"{out}/dvf") == {"67": 0}
    assert datasets(spark, out) == ["dvf"]
    found = {(r["controle"], r["dept"]): r["niveau"] for r in verify(spark, out).collect()}
    assert found == {("volume", "67"): "ok"}
    with pytest.raises(ValueError, match="no dataset to publish"):
        publish(spark, out, vintage="2026-01")


def test_sales_that_left_their_department(spark, tmp_path):
    out = str(tmp_path / "dvf")
    both = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [sale("1", "15"), sale("2", "63")])
    one = write_csv(tmp_path / "b.csv", LINE_COLUMNS, [sale("3", "15")])
    prepare_sales(spark, [[both]], out, force=False)
    prepare_sales(spark, [[one]], out, force=False)
    assert {r["id_mutation"] for r in read_table(spark, out).collect()} == {"1", "2"}
    prepare_sales(spark, [[one]], out)
    assert {r["id_mutation"] for r in read_table(spark, out).collect()} == {"3"}
    assert coverage.covered_departments(spark, out) == {"15": 1, "63": 0}


def test_run_that_dies_before_its_record_is_run_again(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "dpe")
    prepare_diagnostics(spark, pages(spark, ("N1", "33"), ("N2", "988")), out)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(coverage, "add_run", die)
        with pytest.raises(RuntimeError, match="killed"):
            prepare_diagnostics(spark, pages(spark, ("N3", "33")), out)
    assert coverage.covered_departments(spark, out) == {"33": 1, "988": 1}
    prepare_diagnostics(spark, pages(spark, ("N3", "33")), out)
    assert held(spark, out) == {"N3": "33"}
    assert coverage.covered_departments(spark, out) == {"33": 1, "988": 0}


def test_entry_without_its_mark_is_not_read(spark, tmp_path):
    table = str(tmp_path / "t")
    coverage.add_run(spark, table, {"33": 5})
    coverage.add_run(spark, table, {"33": 7, "48": 1})
    (tmp_path / "t" / coverage.RECORD / "entry=2" / "_SUCCESS").unlink()
    assert coverage.covered_departments(spark, table) == {"33": 5}
    coverage.add_run(spark, table, {"33": 9})
    assert coverage.covered_departments(spark, table) == {"33": 9}


def test_record_is_summed_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(coverage, "RUNS_KEPT", 4)
    table, want = str(tmp_path / "t"), {}
    for n in range(11):
        rows = {f"{n % 3:02d}": n, None: n}
        want |= rows
        coverage.add_run(spark, table, rows)
        assert coverage.covered_departments(spark, table) == want
        assert len(ledger.folders(spark, f"{table}/{coverage.RECORD}")) <= 5
    runs = {r["dept"]: r["run"] for r in coverage.covered(spark, table).collect()}
    assert runs == {"00": 10, "01": 11, "02": 9, None: 11}


def test_scope():
    assert "33" in Scope() and None in Scope() and "33" not in Scope(done=("33",))
    assert None not in Scope(only=("33",)) and Scope(only=("33",), done=("33",)).empty and not Scope(done=("33",)).empty


def test_scope_as_a_column(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("33",), ("48",), (None,)], "dept string")
    for scope in (Scope(), Scope(("33", "99")), Scope(done=("33",)), Scope(done=(None,)), Scope(("33", "48"), ("48", None))):
        kept = {r[0] for r in rows.filter(scope.holds(F.col("dept"))).collect()}
        assert kept == {d for d in ("33", "48", None) if d in scope}


def test_buildings_and_joint_table_resume(spark, tmp_path):
    out, root = str(tmp_path / "out"), write_buildings(tmp_path / "csv")
    prepare_buildings(spark, root, f"{out}/bdnb", departments="64", force=False)
    assert coverage.covered_departments(spark, f"{out}/bdnb") == {"64": 2}
    prepare_buildings(spark, root, f"{out}/bdnb", force=False)
    assert coverage.covered_departments(spark, f"{out}/bdnb") == {"64": 2, "15": 1}
    assert {r["run"] for r in coverage.covered(spark, f"{out}/bdnb").collect()} == {1, 2}
    prepare_buildings(spark, root, f"{out}/bdnb", force=False)
    assert {r["run"] for r in coverage.covered(spark, f"{out}/bdnb").collect()} == {1, 2}
    lines = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [sale("1", "15")])
    prepare_sales(spark, [[lines]], f"{out}/dvf")
    with pytest.warns(UserWarning):
        prepare_joint(spark, f"{out}/dvf", f"{out}/joint", force=False)
    more = write_csv(tmp_path / "b.csv", LINE_COLUMNS, [sale("9", "15"), sale("2", "63")])
    prepare_sales(spark, [[more]], f"{out}/dvf")
    prepare_joint(spark, f"{out}/dvf", f"{out}/joint", f"{out}/bdnb", force=False)
    assert {r["id_mutation"]: r["dept"] for r in read_table(spark, f"{out}/joint").collect()} == {"1": "15", "2": "63"}
    prepare_joint(spark, f"{out}/dvf", f"{out}/joint", f"{out}/bdnb")
    assert {r["id_mutation"]: r["dept"] for r in read_table(spark, f"{out}/joint").collect()} == {"9": "15", "2": "63"}


def test_datasets_are_found(spark, tmp_path):
    out = str(tmp_path / "out")
    prepare_diagnostics(spark, pages(spark, ("N1", "33")), f"{out}/dpe")
    path = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [sale("1", "15")])
    prepare_sales(spark, [[path]], f"{out}/dvf")
    assert datasets(spark, out) == ["dpe", "dvf"]
    verify(spark, out)
    publish(spark, out, vintage="2026-01")
    assert datasets(spark, out) == ["dpe", "dvf"]  # what was exported is no dataset
    with pytest.raises(ValueError, match="no dataset"):
        verify(spark, str(tmp_path / "nothing"))


def test_pairs_without_tables():
    with pytest.raises(ValueError, match="no dataset"):
        quality.check({})


def test_rows_are_observed_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("01", 1), ("01", 2), (None, 4)], "code_departement string, v int")
    export.write_run(df, path, Scope(), {"02"})
    assert coverage.covered_departments(spark, path) == {"01": 2, None: 1, "02": 0}
    now = export.write_run(df.limit(0), path, Scope(), set())
    assert now.count() == 0 and now.columns == ["code_departement", "v", "dept"]
    assert coverage.covered_departments(spark, path) == {"01": 0, None: 0, "02": 0}
