import datetime as dt
import decimal
import gzip
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import DIAGNOSTIC, LINE_COLUMNS, SALE, write_buildings, write_csv
from terrier.plans import export
from terrier.plans.prepare import prepare_buildings, prepare_diagnostics, prepare_joint, prepare_sales, publish, verify
from terrier.sources import delimited, landing
from terrier.sources.tables import manifest_baseline, produced, read_table

SCHEMA = T.StructType(
    [
        T.StructField("id_mutation", T.StringType()),
        T.StructField("date_mutation", T.DateType()),
        T.StructField("annee", T.ShortType()),
        T.StructField("code_commune", T.StringType()),
        T.StructField("valeur_fonciere", T.DoubleType()),
        T.StructField("montant_exact", T.DecimalType(10, 2)),
        T.StructField("nb_pieces", T.IntegerType()),
        T.StructField("marque", T.BooleanType()),
        T.StructField("qualite_prix_m2", T.StringType()),
    ]
)


def test_ddl():
    ddl = export.schema_ddl(SCHEMA, "dvf")
    body = ddl[ddl.index("(\n") + 2 : ddl.index("\n);")]
    lines = {line.split()[0]: " ".join(line.split()[1:]).rstrip(",") for line in body.splitlines()}
    assert lines == {
        "id_mutation": "text",
        "date_mutation": "date",
        "annee": "smallint",
        "code_commune": "text",
        "valeur_fonciere": "double precision",
        "montant_exact": "numeric",
        "nb_pieces": "integer",
        "marque": "boolean",
        "qualite_prix_m2": "text",
    }
    assert "ON dvf (code_commune)" in ddl and "for f in" in ddl and "batiment_groupe_id" not in ddl and "PRIMARY KEY" not in ddl
    keyed = export.schema_ddl(T.StructType([*SCHEMA, T.StructField("cle_vente", T.StringType())]), "dvf")
    assert "cle_vente text PRIMARY KEY" in keyed and "ON CONFLICT (cle_vente)" in keyed
    assert export.sql_type(T.BinaryType()) == "bytea" and export.sql_type(T.ArrayType(T.StringType())) == "text"
    assert export.sql_type(T.TimestampType()) == "timestamptz" and export.sql_type(T.TimestampNTZType()) == "timestamp"


def test_partitions_are_text_and_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("01", 1), ("01", 2), ("2A", 3), (None, 4)], "code_departement string, v int")
    export.write_table(rows, path)
    assert {(r["dept"], r["v"]) for r in read_table(spark, path).collect()} == {("01", 1), ("01", 2), ("2A", 3), (None, 4)}
    export.write_table(spark.createDataFrame([("01", 9)], "code_departement string, v int"), path, mode="replace")
    assert {(r["dept"], r["v"]) for r in read_table(spark, path).collect()} == {("01", 9), ("2A", 3), (None, 4)}
    there = produced({"dvf": read_table(spark, path)}).filter("dept is not null")
    assert {tuple(r) for r in there.collect()} == {("dvf", "01"), ("dvf", "2A")}


def test_one_huge_department_is_split_and_sorted(spark, tmp_path):
    """Most rows are in one department; its files are several, each sorted."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(60000).select(
            F.when(F.col("id") % 3 != 0, "13").otherwise(F.lpad((F.col("id") % 9).cast("string"), 2, "0")).alias("code_departement"),
            F.sha2(F.col("id").cast("string"), 256).alias("batiment_groupe_id"),
        )
        export.write_table(rows, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t" / "dept=13").glob("*.parquet"))
    assert len(files) > 1
    for file in files:
        ids = [r[0] for r in spark.read.parquet(str(file)).select("batiment_groupe_id").collect()]
        assert ids == sorted(ids)
    assert read_table(spark, str(tmp_path / "t")).count() == 60000


def test_csv_export(spark, tmp_path):
    row = ("a,\"b\"", bytes([1, 171]), decimal.Decimal("1.50"), dt.date(2024, 1, 2), None)
    df = spark.createDataFrame([row], "t string, geom binary, m decimal(10,2), d date, n int").coalesce(1)
    export.write_csv(df, str(tmp_path / "csv"))
    (file,) = (tmp_path / "csv").glob("*.csv.gz")
    assert gzip.decompress(file.read_bytes()).decode() == 't,geom,m,d,n\n"a,""b""",\\x01ab,1.50,2024-01-02,\n'
    back = delimited.read_text_table(spark, str(tmp_path / "csv")).first()
    assert back["t"] == 'a,"b"' and back["n"] is None


def test_fingerprints(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, size in (("small file.bin", 100), ("large.bin", 5000)):
        (tmp_path / "in" / name).write_bytes(bytes(i % 251 for i in range(size)))
    got = {Path(r["path"].replace("%20", " ")).name: r for r in landing.fingerprints(spark, str(tmp_path / "in")).collect()}
    for name, row in got.items():
        data = (tmp_path / "in" / name).read_bytes()
        assert (row["length"], row["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert len(got) == 2


def test_health(spark, tmp_path):
    cases = {
        "comma.csv": (b"a,b\n1,2\n", None),
        "semi.csv": (b"a;b\n", None),
        "tab.csv": (b"a\tb\n", None),
        "pipe.csv": (b"a|b\n\xff", None),
        "zip.csv.gz": (gzip.compress(b"a,b\n1,2\n"), None),
        "nul.csv": (b"a,b\n\x00\x01", "NUL"),
        "empty.csv": (b"", "empty"),
        "latin.csv": ("année,é\n".encode("latin-1"), "UTF-8"),
        "bare.csv": (b"abc\n1,2\n", "separator"),
    }
    for name, (data, _) in cases.items():
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in landing.file_health(spark, str(tmp_path)).collect()}
    assert set(got) == set(cases)
    for name, (_, expected) in cases.items():
        assert (got[name] is None) if expected is None else (expected in got[name]), (name, got[name])


def test_agreement(spark, tmp_path):
    for side, files in (("a", {"x": b"1", "y": b"22", "z/w": b"3"}), ("b", {"x": b"1", "y": b"23", "v": b"4"})):
        for name, data in files.items():
            (tmp_path / side / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / side / name).write_bytes(data)
    roots = [str(tmp_path / s) for s in "ab"]
    prints = [landing.fingerprints(spark, r) for r in roots]
    got = {r["file"]: r["agreed"] for r in landing.agreement(*prints, *roots).collect()}
    assert got == {"x": True, "y": False, "z/w": False, "v": False}


def test_whole_chain(spark, tmp_path):
    """Landed files to published tables, manifest and the next vintage's comparison."""
    out = str(tmp_path / "out")
    lines = write_csv(
        tmp_path / "raw" / "48.csv",
        LINE_COLUMNS,
        [
            {**SALE, "id_mutation": "1", "id_parcelle": "15101000ZD0310", "date_mutation": "2022-08-01"},
            {**SALE, "id_mutation": "2", "code_departement": "64", "code_commune": "64024", "id_parcelle": "64024000BK0033", "latitude": "43.3", "longitude": "-0.4"},
        ],
    )
    prepare_sales(spark, [[lines]], f"{out}/dvf")
    page = write_csv(tmp_path / "pages" / "p1.csv", delimited.DIAGNOSTIC_COLUMNS, [{**DIAGNOSTIC, "numero_dpe": "D3"}])
    prepare_diagnostics(spark, [page], f"{out}/dpe")
    root = write_buildings(tmp_path / "csv")
    write_csv(
        tmp_path / "csv" / "batiment_groupe_dpe_representatif_logement.csv",
        ["batiment_groupe_id", "identifiant_dpe", "classe_bilan_dpe", "classe_emission_ges", "conso_5_usages_ep_m2"],
        [{"batiment_groupe_id": "H12", "identifiant_dpe": "D3", "classe_bilan_dpe": "e"}, {"batiment_groupe_id": "H11", "identifiant_dpe": "D9", "classe_bilan_dpe": "f"}],
        ";",
    )
    prepare_buildings(spark, root, f"{out}/bdnb")
    report, absent = prepare_joint(spark, f"{out}/dvf", f"{out}/joint", f"{out}/bdnb", f"{out}/dpe")
    assert absent == [] and {r["code_departement"]: r["part_energie_depuis_ademe"] for r in report.collect()} == {"15": 100.0, "64": 0.0}
    joint = {r["id_mutation"]: r for r in read_table(spark, f"{out}/joint").collect()}
    assert (joint["1"]["classe_dpe"], joint["1"]["source_dpe"]) == ("D", "ademe")
    assert (joint["2"]["batiment_groupe_id"], joint["2"]["classe_dpe"], joint["2"]["source_dpe"]) == ("H11", "F", "bdnb")

    sources = ["dvf", "dpe", "bdnb", "joint"]
    with pytest.raises(ValueError, match="refused"):
        publish(spark, out, [*sources, "autre"], "2026-01")
    text = publish(spark, out, sources, "2026-01")
    manifest = json.loads(text.first()["value"])
    entry = manifest["sources"]["dvf"]
    assert entry["lignes_totales"] == 2 and entry["ddl"] == "schema/dvf" and len(entry["fichiers"]) == 4
    assert all(len(f["sha256"]) == 64 and f["octets"] > 0 for f in entry["fichiers"])
    baseline = {(r["source"], r["dept"]): r["lignes"] for r in manifest_baseline(text).collect()}
    assert baseline[("dvf", "15")] == 1 and baseline[("bdnb", "64")] == 2
    verify(spark, out, sources, manifest_path=f"{out}/manifest")
    ddl = "\n".join(r["value"] for r in spark.read.text(f"{out}/schema/dvf").collect())
    assert "cle_vente text PRIMARY KEY" in ddl and " dept " not in ddl
    with pytest.raises(ValueError, match="refused"):
        verify(spark, out, [*sources, "autre"])


def test_layouts_differ_beyond_any_head(spark, tmp_path):
    """Two headers alike for many kilobytes are two layouts, plain or compressed."""
    wide = ",".join(f"column_{i}" for i in range(20_000))
    (tmp_path / "a.csv").write_text(f"{wide},x\n1\n")
    (tmp_path / "b.csv").write_text(f"{wide},y\n1\n")
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(f"{wide},x\r\n1\n".encode()))
    found = delimited.layouts(spark, [str(tmp_path)])
    assert sorted((header[-2:], len(files)) for header, files in found) == [(",x", 2), (",y", 1)]


def groups_met(path, column, value):
    """Row groups of a table's files, and those whose bounds on a column hold a value."""
    import pyarrow.parquet as pq

    total = met = 0
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            (stats,) = [c.statistics for i in range(meta.num_columns) if (c := meta.row_group(g).column(i)).path_in_schema == column]
            total, met = total + 1, met + (stats.min <= value <= stats.max)
    return total, met


def test_look_ups_meet_few_row_groups(spark, tmp_path):
    """By date and by commune alike, where an order by date alone would leave communes everywhere."""
    rows = spark.range(60_000).select(
        F.lit("63").alias("code_departement"),
        F.concat(F.lit("63"), F.lpad((F.xxhash64("id") % 400 + 400).cast("string"), 3, "0")).alias("code_commune"),
        F.date_add(F.lit("2014-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4000)).cast("int")).alias("date_mutation"),
        F.sha2(F.col("id").cast("string"), 256).alias("cle_vente"),
    )
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 * 1024))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size.row.check.min", "100")
    try:
        export.write_table(rows.coalesce(1), str(tmp_path / "t"))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size.row.check.min")
    total, by_commune = groups_met(tmp_path / "t", "code_commune", "63333")
    _, by_date = groups_met(tmp_path / "t", "date_mutation", dt.date(2019, 5, 5))
    assert total >= 16 and by_commune <= total / 2 and by_date <= total / 2
    assert read_table(spark, str(tmp_path / "t")).count() == 60_000


def test_keys_have_bloom_filters(spark, tmp_path):
    rows = spark.range(5000).select(F.lit("63").alias("code_departement"), F.sha2(F.col("id").cast("string"), 256).alias("cle_vente"))
    export.write_table(rows, str(tmp_path / "t"))
    key = rows.first()["cle_vente"]
    assert read_table(spark, str(tmp_path / "t")).filter(F.col("cle_vente") == key).count() == 1
    # The filters lie in the files.
    plain = tmp_path / "plain"
    rows.write.option("compression", "zstd").parquet(str(plain))
    size = lambda root: sum(f.stat().st_size for f in Path(root).rglob("*.parquet"))
    assert size(tmp_path / "t") > size(plain)


def test_curve():
    place = lambda a, b: sum(((a >> i) & 1) << (2 * i + 1) | ((b >> i) & 1) << (2 * i) for i in range(13))
    assert place(1, 0) == 2 and place(0, 1) == 1 and place(3, 3) == 15


def test_curve_as_a_column(spark):
    rows = spark.createDataFrame([(a, b) for a in (0, 1, 5, 8000) for b in (0, 3, 999)], "a long, b int")
    got = {(r["a"], r["b"]): r["p"] for r in rows.select("a", "b", export.curve(F.col("a"), F.col("b")).alias("p")).collect()}
    for (a, b), p in got.items():
        assert p == sum(((a >> i) & 1) << (2 * i + 1) | ((b >> i) & 1) << (2 * i) for i in range(13))
