import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.operators.joins import left_join_many, left_join_spread, nearest_in_time
from terrier.operators.joint import BUILDING_CAVEAT, BUILDING_SIDE, DIAGNOSTIC_SIDE, enrich_sales
from terrier.operators.reports import absent_sources, joint_report

SALES = "cle_vente string, id_parcelle string, date_mutation date, code_departement string"


def make(spark, schema, rows):
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], schema)


def buildings(spark, rows):
    return make(spark, BUILDING_SIDE, rows)


def diagnostics(spark, rows):
    return make(spark, DIAGNOSTIC_SIDE, [{"est_remplace": False, **r} for r in rows])


def day(text):
    return dt.date.fromisoformat(text)


def test_tolerance_is_in_calendar_years(spark):
    sales = spark.createDataFrame(
        [("in", "p", day("2020-12-31"), "33"), ("edge", "p", day("2019-01-01"), "33"), ("out", "p", day("2019-12-31"), "33")], SALES
    )
    known = buildings(spark, [{"parcelle_id": "p", "batiment_groupe_id": "B", "identifiant_dpe": "D", "classe_dpe": "G"}])
    for sold, expected in (("2023-12-31", {"in": "ademe", "edge": "bdnb", "out": "bdnb"}), ("2022-06-01", {"in": "ademe", "edge": "ademe", "out": "ademe"})):
        energy = diagnostics(spark, [{"numero_dpe": "D", "date_dpe": day(sold), "classe_dpe": "B"}])
        got = {r["cle_vente"]: r["source_dpe"] for r in enrich_sales(sales, known, energy).collect()}
        assert got == expected


def test_unmatched_replaced_and_caveat(spark):
    sales = spark.createDataFrame(
        [("m", "p", day("2020-06-01"), "33"), ("n", None, day("2020-06-01"), "33"), ("u", "zz", day("2020-06-01"), "33"), ("q", "q", None, "33")], SALES
    )
    known = buildings(
        spark,
        [{"parcelle_id": "p", "batiment_groupe_id": "B", "identifiant_dpe": "D", "classe_dpe": None}, {"parcelle_id": "q", "batiment_groupe_id": "C"}, {"parcelle_id": None, "batiment_groupe_id": "N"}],
    )
    energy = diagnostics(spark, [{"numero_dpe": "D", "date_dpe": day("2020-01-01"), "classe_dpe": "B", "est_remplace": True}])
    got = {r["cle_vente"]: r for r in enrich_sales(sales, known, energy).collect()}
    assert set(got) == {"m", "n", "u", "q"}
    assert got["m"]["batiment_groupe_id"] == "B" and got["m"]["classe_dpe"] is None and got["m"]["source_dpe"] is None
    assert got["m"]["precision_bati"] == BUILDING_CAVEAT and got["u"]["precision_bati"] is None
    assert got["q"]["batiment_groupe_id"] == "C"
    unknown = energy.withColumn("est_remplace", F.lit(None).cast("boolean"))
    assert {r["cle_vente"]: r["classe_dpe"] for r in enrich_sales(sales, known, unknown).collect()}["m"] == "B"


def test_two_buildings_on_a_parcel_keep_one_sale(spark):
    sales = spark.createDataFrame([("m", "p", day("2020-06-01"), "33")], SALES)
    known = buildings(spark, [{"parcelle_id": "p", "batiment_groupe_id": b, "identifiant_dpe": f"D{b}"} for b in "CAB"])
    row = enrich_sales(sales, known).collect()
    assert len(row) == 1 and row[0]["batiment_groupe_id"] == "A"
    energy = diagnostics(spark, [{"numero_dpe": "DC", "date_dpe": day("2020-05-30"), "classe_dpe": "F"}, {"numero_dpe": "DB", "date_dpe": day("2020-07-30"), "classe_dpe": "A"}])
    row = enrich_sales(sales, known, energy).first()
    assert (row["batiment_groupe_id"], row["classe_dpe"], row["date_dpe"]) == ("C", "F", day("2020-05-30"))


def test_absent_sources(spark):
    sales = spark.createDataFrame([("m", "p", day("2020-06-01"), "33")], SALES)
    energy = diagnostics(spark, [{"numero_dpe": "D", "date_dpe": day("2020-01-01"), "classe_dpe": "B"}])
    full = enrich_sales(sales, buildings(spark, []), energy)
    for df in (enrich_sales(sales), enrich_sales(sales, None, energy)):
        assert df.schema == full.schema and df.first()["classe_dpe"] is None
    assert absent_sources(None, energy) == ["bdnb", "dpe"] and absent_sources(full, None) == ["dpe"]
    report = joint_report(full, by=[]).first()
    assert (report["ventes"], report["part_avec_batiment"]) == (1, 0.0)


def test_nearest_against_brute_force(spark):
    """One key holds a third of both sides."""
    rng = random.Random(7)

    def rows(n, prefix):
        return [
            ("hot" if rng.random() < 0.33 else f"k{rng.randrange(12)}", dt.date(2015, 1, 1) + dt.timedelta(days=rng.randrange(4000)), f"{prefix}{i:04d}")
            for i in range(n)
        ]

    left, right = rows(600, "s"), rows(90, "d")
    right += [("hot", right[0][1], "d0000a"), ("k1", None, "dx"), (None, right[0][1], "dy")]
    left_df = spark.createDataFrame(left, "k string, sold date, id string")
    right_df = spark.createDataFrame(right, "k string, seen date, num string")
    got = {(r["k"], r["sold"]): r["_nearest"] for r in nearest_in_time(left_df, right_df, "k", "sold", "seen", ["num"]).collect()}
    assert set(got) == {(k, d) for k, d, _ in left}
    for (k, sold), found in got.items():
        fits = [(abs((d - sold).days), n, d) for rk, d, n in right if rk == k and d and abs(d.year - sold.year) <= 3]
        best = min(fits, default=None)
        assert (found and (found["num"], found["seen"])) == (best and (best[1], best[2]))


def test_null_keys_are_spread(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("k")).alias("k"), F.col("id").cast("string").alias("cle_vente"))
    right = spark.createDataFrame([("k", 1), (None, 2)], T.StructType([T.StructField("r", T.StringType()), T.StructField("v", T.IntegerType())]))
    joined = left_join_spread(left, right, ["k"], ["r"])
    counts = {r["v"]: r["count"] for r in joined.groupBy("v").count().collect()}
    assert counts == {1: 334, None: 666} and joined.columns == ["k", "cle_vente", "v"]


def test_a_key_with_most_matches(spark):
    left = spark.createDataFrame([("hot", 1), ("few", 2), ("none", 3)], "k string, v int")
    right = spark.range(1000).select(F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 5)).alias("k"), F.concat(F.lit("p"), F.col("id")).alias("p"))
    right = right.unionByName(spark.createDataFrame([("few", "x"), ("few", "y"), ("hot", None)], "k string, p string"))
    plain = left.join(right, "k", "left")
    cut = left_join_many(left, right, "k")
    assert cut.columns == plain.columns
    assert sorted(map(tuple, cut.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
