import random
import struct

import pytest
from pyspark.sql import functions as F

from fixtures import write_buildings, write_csv
from terrier.functions import footprints as fp
from terrier.operators.buildings import BUILDING_OUTPUT, arbitrate_parcels, prepare_building_rows, star
from terrier.operators.reports import buildings_report
from terrier.plans.prepare import prepare_buildings
from terrier.sources import delimited
from terrier.sources.tables import read_table


@pytest.fixture
def tables(spark, tmp_path):
    return delimited.scan_building_tables(spark, write_buildings(tmp_path / "csv"))


def rows(df):
    return {r["batiment_groupe_id"]: r for r in df.collect()}


def test_principal_link_wins_the_parcel(tables):
    got = rows(prepare_building_rows(tables))
    assert got["H11"]["parcelle_id"] == "64024000BK0033" and got["H10"]["parcelle_id"] is None
    assert got["H12"]["parcelle_id"] == "15101000ZD0310"


def test_dwellings_break_ties_and_nulls_come_last(spark):
    relation = spark.createDataFrame(
        [("A", "p", None), ("B", "p", "0"), ("C", "p", "f"), ("A", "q", "T"), ("C", "q", "true"), ("D", "r", "1"), ("E", "r", "1")],
        "batiment_groupe_id string, parcelle_id string, parcelle_principale string",
    )
    sizes = spark.createDataFrame([("A", None), ("B", 3), ("C", 2), ("D", 1), ("E", 1)], "batiment_groupe_id string, nb_logements int")
    got = {r["parcelle_id"]: r["batiment_groupe_id"] for r in arbitrate_parcels(relation, sizes).collect()}
    assert got == {"p": "B", "q": "C", "r": "D"}


def test_arbitration_against_brute_force(spark):
    """Buildings numbered in several partitions, links listed twice with either mark, parcels and dwellings unknown."""
    rng = random.Random(5)
    sizes = [(f"B{i:03d}", rng.choice([None, 0, 1, 2, 7, -3])) for i in range(300)]
    links = [(f"B{rng.randrange(320):03d}", rng.choice([None, *"pqrstuvwxyz"]), rng.choice([None, "T", "f", "0"])) for _ in range(900)]
    links += [(b, "dup", flag) for b in ("B001", "B002") for flag in ("f", "T")] + [("B001", "dup", "f")]
    known, best = dict(sizes), {}
    for b, parcel, flag in links:
        if b in known:
            place = (flag != "T", known[b] is None, -(known[b] or 0), b)
            best[parcel] = min(best.get(parcel, place), place)
    relation = spark.createDataFrame(links, "batiment_groupe_id string, parcelle_id string, parcelle_principale string")
    buildings = spark.createDataFrame(sizes, "batiment_groupe_id string, nb_logements int")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        for chosen in ("false", "true"):
            spark.conf.set("spark.sql.adaptive.enabled", chosen)
            got = [tuple(r) for r in arbitrate_parcels(relation, buildings).collect()]
            assert len(got) == len(best) and dict(got) == {p: place[-1] for p, place in best.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_department_filter_restricts_parcels(tables):
    got = rows(prepare_building_rows(tables, ["15"]))
    assert set(got) == {"H12"}


def test_optional_tables(tables):
    row = rows(prepare_building_rows({k: tables[k] for k in ("groupe", "ffo")}))["H10"]
    assert row["classe_dpe"] is None and row["hauteur_moyenne"] is None and row["parcelle_id"] is None
    assert list(row.asDict()) == BUILDING_OUTPUT


def test_lenient_columns(tables):
    got = rows(star(tables))
    assert got["H11"]["emprise_sol"] == 62 and got["H11"]["annee_construction"] is None and got["H10"]["annee_construction"] == 1934


def test_job_and_report(spark, tmp_path):
    report, absent = prepare_buildings(spark, write_buildings(tmp_path / "csv"), str(tmp_path / "out"))
    assert absent == ["batiment_groupe_bdtopo_bat", "batiment_groupe_dpe_representatif_logement"]
    total = buildings_report(read_table(spark, str(tmp_path / "out")), by=[]).first()
    assert (total["batiments"], total["logements"], total["part_rattachee_parcelle"], total["part_avec_geometrie"]) == (3, 13, 66.7, 66.7)
    assert {r["code_departement"]: r["batiments"] for r in report.collect()} == {"64": 2, "15": 1}


def test_mandatory_tables_and_separators(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="batiment_groupe_ffo_bat"):
        delimited.scan_building_tables(spark, write_buildings(tmp_path / "a", leave_out=("batiment_groupe_ffo_bat",)))
    for i, sep in enumerate(";,\t|"):
        path = write_csv(tmp_path / f"{i}.csv", ["id", "geom"], [{"id": "1", "geom": "POLYGON((0 0,1 0,1 1,0 0))"}], sep)
        assert delimited.scan_with_dialect(spark, path).columns == ["id", "geom"]
    (tmp_path / "bare.csv").write_text("identifiant\n1\n")
    with pytest.raises(ValueError, match="separator"):
        delimited.scan_with_dialect(spark, str(tmp_path / "bare.csv"))


SQUARE = "MULTIPOLYGON(((415000 6422000,415010 6422000,415010 6422010,415000 6422000),(415002 6422001,415003 6422001,415003 6422002,415002 6422001)))"


def test_text_and_binary_footprints_agree(spark):
    raw = fp.write_wkb(fp.read_wkt(SQUARE)).hex()
    big_endian = ">" and (struct.pack(">BI", 0, 1) + struct.pack(">dd", 415022.0, 6422103.0)).hex()
    df = spark.createDataFrame(
        [("a", SQUARE, "33"), ("b", raw.upper(), "33"), ("c", None, "33"), ("d", "POINT(415022 6422103)", "33"), ("e", big_endian, "33"), ("f", "POINT (337000 7676000)", "974")],
        "id string, g string, dept string",
    )
    got = {r["id"]: r["geom"] for r in fp.add_footprints(df, "g", "dept").collect()}
    assert got["a"] == got["b"] and got["c"] is None and got["d"] == got["e"]
    (kind, width, (polygon,)), end = fp.read_wkb(bytes(got["a"]))
    assert (kind, width, end, [len(r) for r in polygon[2]]) == (6, 2, len(got["a"]), [4, 4])
    lon, lat = fp.read_wkb(bytes(got["d"]))[0][2][0][0]
    assert abs(lon + 0.6074) < 1e-3 and abs(lat - 44.8395) < 1e-3
    lon, lat = fp.read_wkb(bytes(got["f"]))[0][2][0][0]
    assert abs(lon - 55.43) < 0.02 and abs(lat + 21.01) < 0.02
    forced = fp.add_footprints(df.filter("id = 'd'").withColumn("dept", F.lit("zz")), "g", "dept", srid=2154).first()
    assert forced["geom"] == got["d"]


@pytest.mark.parametrize("bad", ["nonsense", "CIRCLE(1 2)", "POLYGON M((1 2 3,4 5 6))", "POLYGON((1 2,3 4)"])
def test_unknown_footprint_fails_the_job(spark, bad):
    df = spark.createDataFrame([(bad, "33")], "g string, dept string")
    with pytest.raises(Exception, match="(?i)footprint|geometry|unbalanced"):
        fp.add_footprints(df, "g", "dept").collect()


@pytest.mark.parametrize(
    "text", ["POINT(1 2)", "LINESTRING(1 2,3 4)", "POLYGON((0 0,1 0,1 1,0 0))", "MULTIPOINT((1 2),(3 4))", "MULTILINESTRING((1 2,3 4),(5 6,7 8))", "POLYGON Z((0 0 5,1 0 5,1 1 5,0 0 5))", "MULTIPOLYGON EMPTY"]
)
def test_binary_round_trip(text):
    encoded = fp.write_wkb(fp.read_wkt(text))
    again, end = fp.read_wkb(encoded)
    assert end == len(encoded) and fp.write_wkb(again) == encoded
