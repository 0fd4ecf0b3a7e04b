import math

import pytest
from pyspark.sql import functions as F

from fixtures import diagnostics, write_csv
from terrier.functions import footprints as fp
from terrier.functions.projection import add_lon_lat
from terrier.functions.territories import OVERSEAS_BOX, parse_selector, select_departments, territories
from terrier.operators.diagnostics import mark_replaced, prepare_diagnostic_rows, typed_diagnostics
from terrier.operators.reports import diagnostics_report
from terrier.plans.prepare import prepare_diagnostics
from terrier.sources import delimited
from terrier.sources.tables import read_table

POINTS = [("33", 415022.0, 6422103.0, 44.84, -0.61), ("974", 337000.0, 7676000.0, -21.01, 55.43), ("971", 653431.0, 1774592.0, 16.05, -61.57)]

# A point near the middle of each territory without a published expectation, in its own system.
INSIDE = [
    ("972", 715000.0, 1620000.0),
    ("973", 300000.0, 450000.0),
    ("975", 560000.0, 5190000.0),
    ("976", 520000.0, 8580000.0),
    ("977", 517000.0, 1980000.0),
    ("978", 492000.0, 2000000.0),
    ("988", 400000.0, 300000.0),
]


def place(spark, rows):
    df = spark.createDataFrame(rows, "dept string, x double, y double")
    return {r["dept"]: r for r in add_lon_lat(df, "dept", "x", "y").collect()}


def test_reprojection(spark):
    placed = place(spark, [p[:3] for p in POINTS])
    for dept, _, _, lat, lon in POINTS:
        assert abs(placed[dept]["latitude"] - lat) < 0.02 and abs(placed[dept]["longitude"] - lon) < 0.02


def test_other_territories_fall_inside_their_box(spark):
    for dept, row in place(spark, INSIDE).items():
        lat_min, lat_max, lon_min, lon_max = OVERSEAS_BOX[dept]
        assert lat_min <= row["latitude"] <= lat_max and lon_min <= row["longitude"] <= lon_max, row
    origin = place(spark, INSIDE)["988"]
    assert math.isclose(origin["latitude"], -21.5, abs_tol=1e-9) and math.isclose(origin["longitude"], 166, abs_tol=1e-9)


def test_missing_coordinate_and_unknown_territory(spark):
    placed = place(spark, [("33", None, 1.0), ("75", 1.0, None), ("999", None, None)])
    assert all(r["longitude"] is None and r["latitude"] is None for r in placed.values())
    for column in ("longitude", "latitude"):
        df = spark.createDataFrame([("999", 1.0, 2.0)], "dept string, x double, y double")
        with pytest.raises(Exception, match="unknown territory"):
            add_lon_lat(df, "dept", "x", "y").select(column).collect()


def test_column_and_array_projections_agree(spark):
    rows = [p[:3] for p in POINTS] + INSIDE
    placed = place(spark, rows)
    srid = {r["dept"]: r["srid"] for r in territories(spark).collect()}
    import numpy as np

    for dept, x, y in rows:
        lon, lat = fp.lon_lat_arrays(srid[dept], np.array([x]), np.array([y]))
        assert abs(lon[0] - placed[dept]["longitude"]) < 1e-9 and abs(lat[0] - placed[dept]["latitude"]) < 1e-9


def test_replaced_mark(spark):
    raw = diagnostics(
        spark,
        [
            {"numero_dpe": "OLD"},
            {"numero_dpe": "NEW", "numero_dpe_remplace": "OLD"},
            {"numero_dpe": "KEPT"},
            # Not classed, so its citation does not count.
            {"numero_dpe": "X", "numero_dpe_remplace": "KEPT", "etiquette_dpe": None},
            {"numero_dpe": None},
        ],
    )
    got = {r["numero_dpe"]: r["est_remplace"] for r in prepare_diagnostic_rows(raw).collect()}
    assert got == {"OLD": True, "NEW": False, "KEPT": False, None: None}
    nothing_cited = diagnostics(spark, [{"numero_dpe": None}, {"numero_dpe": "A"}])
    assert {r["est_remplace"] for r in prepare_diagnostic_rows(nothing_cited).collect()} == {False}


def test_replaced_mark_scope(spark):
    raw = typed_diagnostics(
        diagnostics(
            spark,
            [
                {"numero_dpe": "OLD"},
                {"numero_dpe": "NEW", "numero_dpe_remplace": "OLD", "code_departement_ban": "75"},
                {"numero_dpe": None},
                {"numero_dpe": None, "code_departement_ban": "75"},
            ],
        )
    )
    everywhere = {r["numero_dpe"]: r["est_remplace"] for r in mark_replaced(raw).collect()}
    within = {(r["numero_dpe"], r["code_departement"]): r["est_remplace"] for r in mark_replaced(raw, scope="code_departement").collect()}
    assert everywhere["OLD"] is True
    assert within == {("OLD", "33"): False, ("NEW", "75"): False, (None, "33"): False, (None, "75"): None}


def test_position_flags_and_class_filter(spark):
    raw = diagnostics(
        spark,
        [
            {"numero_dpe": "low", "score_ban": "0.2"},
            {"numero_dpe": "none", "coordonnee_cartographique_x_ban": None, "coordonnee_cartographique_y_ban": None},
            {"numero_dpe": "unscored", "score_ban": None},
            {"numero_dpe": "good"},
            {"numero_dpe": "unclassed", "etiquette_dpe": None},
        ],
    )
    got = {r["numero_dpe"]: r for r in prepare_diagnostic_rows(raw).collect()}
    assert {k: r["qualite_position"] for k, r in got.items()} == {
        "low": "position_incertaine",
        "none": "sans_position",
        "unscored": "score_inconnu",
        "good": "ok",
    }
    assert (got["good"]["classe_dpe"], got["good"]["annee_construction"], got["good"]["conso_kwh_m2"]) == ("D", 1975, 210.5)
    assert got["good"]["latitude"] > got["good"]["longitude"] and 41 < got["good"]["latitude"] < 52


def test_label_alignment(spark, tmp_path):
    columns = [c.replace("usages_par_m2", "usages par_m2") for c in delimited.DIAGNOSTIC_COLUMNS if c != "statut_geocodage"]
    path = write_csv(
        tmp_path / "page1.csv",
        columns,
        [{"numero_dpe": "1", "emission_ges_5_usages par_m2": "50", "etiquette_dpe": "A", "code_departement_ban": "75"}],
    )
    other = write_csv(tmp_path / "page2.csv", list(reversed(columns)), [{"numero_dpe": "2", "etiquette_dpe": "B", "code_departement_ban": "75"}])
    report = prepare_diagnostics(spark, [path, other], str(tmp_path / "out")).collect()
    rows = {r["numero_dpe"]: r for r in read_table(spark, str(tmp_path / "out")).collect()}
    assert rows["1"]["ges_kg_m2"] == 50 and rows["2"]["classe_dpe"] == "B" and rows["1"]["statut_geocodage"] is None
    assert [(r["code_departement"], r["diagnostics"], r["remplaces"]) for r in report] == [("75", 2, 0)]


def test_refusals(spark, tmp_path):
    with pytest.raises(ValueError, match="recognised"):
        delimited.align_labels(spark.createDataFrame([("1", "2")], "colonne_a string, colonne_b string"))
    with pytest.raises(ValueError, match="unknown territory"):
        prepare_diagnostics(spark, diagnostics(spark, [{"code_departement_ban": "999"}]), str(tmp_path / "o"))
    with pytest.raises(ValueError, match="no diagnostic"):
        prepare_diagnostics(spark, diagnostics(spark, [{}]).limit(0), str(tmp_path / "o"))
    assert not (tmp_path / "o").exists()
    partial = diagnostics(spark, [{"date_etablissement_dpe": "2020"}])
    with pytest.raises(Exception, match="2020"):
        prepare_diagnostic_rows(partial).collect()


def test_records_are_read_as_text(spark):
    typed = spark.createDataFrame([("1", "a", 0.75, 12, "75")], "numero_dpe string, etiquette_dpe string, score_ban double, annee_construction int, code_departement_ban string")
    full = typed.select("*", *[F.lit(None).alias(c) for c in delimited.DIAGNOSTIC_COLUMNS if c not in typed.columns])
    row = delimited.align_labels(full).first()
    assert (row["score_ban"], row["annee_construction"]) == ("0.75", "12")


def test_report_counts(spark):
    raw = diagnostics(spark, [{"numero_dpe": "A"}, {"numero_dpe": "B", "numero_dpe_remplace": "A"}, {"numero_dpe": "C", "score_ban": "0.1"}])
    row = diagnostics_report(prepare_diagnostic_rows(raw), by=[]).first()
    assert (row["diagnostics"], row["courants"], row["remplaces"], row["part_bien_positionnee"]) == (3, 2, 1, 66.7)


def test_selector_and_dimension(spark):
    assert parse_selector("33,40, 2a") == ["33", "40", "2A"]
    assert parse_selector("all") is parse_selector("TOUS") is parse_selector(None) is None
    df = spark.createDataFrame([("33",), ("2A",), ("75",)], "dept string")
    assert {r[0] for r in select_departments(df, "33,2a").collect()} == {"33", "2A"}
    assert select_departments(df, "all").count() == 3
    dim = territories(spark)
    assert dim.filter("is_department").count() == 101 and dim.filter("dept = '20'").isEmpty()
    assert {r["dept"]: r["srid"] for r in dim.filter("not is_department").collect()} == {"975": 4467, "977": 5490, "978": 5490, "988": 3163}
