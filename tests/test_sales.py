import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import LINE_COLUMNS, SALE, sale_lines, write_csv
from terrier.operators.ranking import exact_median, rank_in_group
from terrier.operators.reports import median_price, sales_report
from terrier.operators.sales import key_suffix
from terrier.operators.sources import prefer_later_sources, sale_match_key
from terrier.plans.prepare import effective_lines, prepare_sales, sales_from_lines
from terrier.sources import delimited
from terrier.sources.tables import read_table

LINES = [
    {**SALE, "id_mutation": "2024-1", "valeur_fonciere": "300000", "surface_reelle_bati": "100", "id_parcelle": "P1"},
    {**SALE, "id_mutation": "2024-1", "valeur_fonciere": "300000", "surface_reelle_bati": "50", "id_parcelle": "P2"},
    {**SALE, "id_mutation": "2024-2", "valeur_fonciere": "80000", "surface_reelle_bati": None, "code_type_local": None, "surface_terrain": "4000"},
    {**SALE, "id_mutation": "2024-3", "code_type_local": "2", "surface_reelle_bati": "60"},
    {**SALE, "id_mutation": "2024-4", "nature_mutation": "Echange"},
    {**SALE, "id_mutation": "2024-5", "valeur_fonciere": "900000", "surface_reelle_bati": "10"},
]


def by_id(df):
    return {r["id_mutation"]: r.asDict() for r in df.collect()}


def test_collapse_and_flags(spark):
    sales = by_id(sales_from_lines(sale_lines(spark, LINES)))
    assert set(sales) == {"2024-1", "2024-2", "2024-3", "2024-5"}
    first = sales["2024-1"]
    assert (first["valeur_fonciere"], first["surface_bati"], first["nb_parcelles"], first["nb_lignes"]) == (300000, 150, 2, 2)
    assert sales["2024-2"]["qualite_prix_m2"] == "sans_surface" and sales["2024-2"]["prix_m2"] is None
    assert sales["2024-3"]["qualite_prix_m2"] == "ok" and sales["2024-3"]["prix_m2"] == 4100.0
    assert sales["2024-5"]["qualite_prix_m2"] == "prix_m2_haut" and sales["2024-5"]["prix_m2"] == 90000


def test_output_schema(spark):
    types = dict(sales_from_lines(sale_lines(spark, LINES), largest=1).dtypes)
    assert list(types)[-3:] == ["cle_vente", "prix_m2", "qualite_prix_m2"] and len(types) == 24
    assert (types["annee"], types["code_type_local"], types["nb_pieces"], types["nb_lignes"]) == ("smallint", "tinyint", "int", "bigint")


def test_report(spark):
    lines = sale_lines(spark, LINES)
    row = sales_report(sales_from_lines(lines), lines, by=[]).first()
    assert (row["lignes_source"], row["lignes_retenues"], row["lignes_ecartees"], row["mutations"]) == (6, 5, 1, 4)
    assert row["part_geolocalisee"] == 100.0


def test_report_of_no_sale(spark):
    lines = sale_lines(spark, [LINES[4]])
    row = sales_report(sales_from_lines(lines), lines, by=[]).first()
    assert (row["mutations"], row["lignes_ecartees"], row["part_exploitable"]) == (0, 1, None)
    row = sales_report(sales_from_lines(lines), lines).first()
    assert (row["code_departement"], row["mutations"], row["lignes_ecartees"]) == ("15", 0, 1)


def test_codes_stay_text(spark):
    sale = by_id(sales_from_lines(sale_lines(spark, [{**SALE, "id_mutation": "1", "code_commune": "2A004", "code_departement": "2A"}])))["1"]
    assert (sale["code_commune"], sale["code_departement"]) == ("2A004", "2A")


def test_quoted_comma_after_plain_file(spark, tmp_path):
    plain = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [{**SALE, "id_mutation": "1"}])
    quoted = write_csv(
        tmp_path / "b.csv",
        LINE_COLUMNS,
        [{**SALE, "id_mutation": "2", "adresse_nom_voie": 'CHEMIN "DU BAS", LE PRE', "valeur_fonciere": "10000", "surface_reelle_bati": "66", "nom_commune": "Coteaux"}],
    )
    prepare_sales(spark, [[plain, quoted]], str(tmp_path / "out"))
    sale = next(r for r in read_table(spark, str(tmp_path / "out")).collect() if r["nom_commune"] == "Coteaux")
    assert (sale["valeur_fonciere"], sale["surface_bati"]) == (10000, 66)


def test_two_communes_one_sale(spark):
    rows = [
        {**SALE, "id_mutation": "9", "valeur_fonciere": "27000", "code_commune": "15040", "nom_commune": "Amont", "surface_reelle_bati": "80"},
        {**SALE, "id_mutation": "9", "valeur_fonciere": "27000", "code_commune": "15082", "nom_commune": "Aval", "surface_reelle_bati": "20"},
    ]
    sales = by_id(sales_from_lines(sale_lines(spark, rows)))
    assert len(sales) == 1
    assert (sales["9"]["valeur_fonciere"], sales["9"]["surface_bati"], sales["9"]["nb_communes"], sales["9"]["nom_commune"]) == (27000, 100, 2, "Amont")


def test_null_attribute_on_most_built_line(spark):
    rows = [
        {**SALE, "id_mutation": "1", "surface_reelle_bati": "80", "code_postal": None},
        {**SALE, "id_mutation": "1", "surface_reelle_bati": "20", "code_postal": "48000"},
        {**SALE, "id_mutation": "2", "surface_reelle_bati": None, "code_postal": "48200"},
        {**SALE, "id_mutation": "2", "surface_reelle_bati": None, "code_postal": "48100"},
    ]
    sales = by_id(sales_from_lines(sale_lines(spark, rows)))
    assert (sales["1"]["code_postal"], sales["2"]["code_postal"]) == ("48000", "48100")


def test_null_type_with_area_is_not_a_non_dwelling(spark):
    sale = by_id(sales_from_lines(sale_lines(spark, [{**SALE, "id_mutation": "1", "code_type_local": None}])))["1"]
    assert sale["qualite_prix_m2"] == "ok"


def test_key_ignores_the_identifier(spark):
    keys = {
        sales_from_lines(sale_lines(spark, [{**SALE, "id_mutation": i}])).first()["cle_vente"] for i in ("2019-100", "2019-200")
    }
    assert len(keys) == 1


def test_key_text_of_large_prices(spark):
    import hashlib

    row = sales_from_lines(sale_lines(spark, [{**SALE, "id_mutation": "1", "valeur_fonciere": "12500000"}])).first()
    expected = hashlib.md5(b"2019-10-21|12500000.0|15101000ZD0207").hexdigest()
    assert row["cle_vente"] == f"{expected}-01"


def test_twins_are_ranked_by_content(spark):
    rows = [{**SALE, "id_mutation": i, "surface_reelle_bati": a} for i, a in (("b", "80"), ("a", "102"))]
    keys = {r["surface_bati"]: r["cle_vente"] for r in sales_from_lines(sale_lines(spark, rows)).collect()}
    assert keys[80.0].endswith("-01") and keys[102.0].endswith("-02")


def test_rank_beyond_ninety_nine(spark):
    suffixes = [r[0] for r in spark.range(99, 102).select(key_suffix(F.col("id"))).collect()]
    assert suffixes == ["99", "100", "101"]


def sources(spark, archive, official):
    return [delimited.complete_sale_lines(sale_lines(spark, rows)) for rows in (archive, official)]


def test_official_source_wins(spark):
    both = sources(
        spark,
        [{**SALE, "id_mutation": "2020-1", "surface_reelle_bati": "82", "valeur_fonciere": "246000.0"}],
        [{**SALE, "id_mutation": "2020-999", "surface_reelle_bati": "95"}],
    )
    sales = by_id(sales_from_lines(effective_lines(both)))
    assert list(sales) == ["2020-999"] and sales["2020-999"]["surface_bati"] == 95


def test_archive_only_sale_survives(spark):
    both = sources(
        spark,
        [{**SALE, "id_mutation": "2018-5", "date_mutation": "2018-06-01"}],
        [{**SALE, "id_mutation": "2021-7", "date_mutation": "2021-06-01"}],
    )
    assert sorted(r["annee"] for r in sales_from_lines(effective_lines(both)).collect()) == [2018, 2021]


def test_partial_overlap_and_null_keys(spark):
    none = {**SALE, "code_commune": None, "valeur_fonciere": None}
    both = sources(
        spark,
        [{**none, "id_mutation": "a"}, {**SALE, "id_mutation": "x", "code_commune": "15001"}, {**SALE, "id_mutation": "x"}],
        [{**none, "id_mutation": "b"}, {**SALE, "id_mutation": "y"}, {**SALE, "id_mutation": "y", "id_parcelle": "Z"}],
    )
    kept = prefer_later_sources(both, sale_match_key(), tag="p").groupBy("p", "id_mutation").count().collect()
    assert sorted((r["p"], r["id_mutation"], r["count"]) for r in kept) == [(0, "x", 1), (1, "b", 1), (1, "y", 2)]


def test_same_identifier_in_two_sources_is_two_sales(spark):
    both = sources(spark, [{**SALE, "id_mutation": "7", "date_mutation": "2018-01-01"}], [{**SALE, "id_mutation": "7"}])
    assert sales_from_lines(effective_lines(both)).count() == 2


def test_scan_aligns_by_name_and_guards(spark, tmp_path):
    wide = write_csv(tmp_path / "historique" / "48.csv", ["annee", *reversed(LINE_COLUMNS)], [{**SALE, "id_mutation": "1", "annee": "2020"}])
    plain = write_csv(tmp_path / "2021" / "48.csv", LINE_COLUMNS, [{**SALE, "id_mutation": "2"}])
    rows = {r["id_mutation"]: r for r in delimited.scan_by_name(spark, [wide, plain]).collect()}
    assert rows["1"]["annee"] == "2020" and rows["2"]["annee"] is None
    assert rows["1"]["nom_commune"] == rows["2"]["nom_commune"] == "Vallonet"
    with pytest.raises(ValueError, match="not split"):
        delimited.check_sale_lines(spark.createDataFrame([("a",)], "x string"))
    with pytest.raises(ValueError, match="missing"):
        delimited.check_sale_lines(spark.createDataFrame([("a", "b", "c")], "x string, y string, z string"))
    with pytest.raises(ValueError, match="no source"):
        delimited.scan_sale_lines(spark, [])


def test_ragged_line_is_refused(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c\n1,2,3\n1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_text_table(spark, str(path)).select("a").collect()


def test_refusal_names_all_ragged_lines(spark, tmp_path):
    good = write_csv(tmp_path / "in" / "a.csv", LINE_COLUMNS, [{**SALE, "id_mutation": str(i)} for i in range(5)])
    whole = Path(good).read_text()
    (tmp_path / "in" / "b b.csv").write_text(whole + "short,line\n" + whole.split("\n")[1] + "\n" + whole.split("\n")[2] + ",more\n")
    (tmp_path / "in" / "c.csv.gz").write_bytes(gzip.compress((whole.split("\n")[0] + "\n\"x,y\",z\n").encode()))
    got = sorted((r["file"].replace("%20", " ").rsplit("/", 1)[1], r["line"], r["text"][:10]) for r in delimited.ragged_lines(spark, [str(tmp_path / "in")]).collect())
    assert got == [("b b.csv", 7, "short,line"), ("b b.csv", 9, "1,2019-10-"), ("c.csv.gz", 2, '"x,y",z')]
    with pytest.raises(ValueError, match=r"malformed: 3 line\(s\).*b%20b.csv, line 7: 'short,line'|malformed: 3 line\(s\).*b b.csv, line 7: 'short,line'"):
        prepare_sales(spark, [[str(tmp_path / "in")]], str(tmp_path / "out"))
    assert delimited.ragged_lines(spark, [good]).count() == 0


def test_malformed_number_fails_the_job(spark):
    lines = sale_lines(spark, [{**SALE, "id_mutation": "1", "surface_reelle_bati": "douze"}])
    with pytest.raises(Exception, match="douze"):
        sales_from_lines(lines, largest=1).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="douze"):
            sales_from_lines(lines, largest=1).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ranks_are_the_same_in_pieces(spark):
    """One group holds most rows: ranked piecewise, it gets the ranks of a plain window."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 7919 % 101).alias("a"),
        "id",
    )
    order = [F.col("a").asc_nulls_last(), F.col("id").asc()]
    plain = rank_in_group(rows, ["g"], order, "r").orderBy("id").collect()
    pieces = rank_in_group(rows.repartition(7), ["g"], order, "r", largest=2000, max_group_rows=100)
    assert pieces.orderBy("id").collect() == plain
    assert {r["r"] for r in plain if r["g"] == "hot"} == set(range(1, 2001))


def test_median_matches_sorting(spark):
    data = [("a", float(v)) for v in (5, 1, 1, 9)] + [("b", 2.5)] + [("c", float(v % 17)) for v in range(101)]
    df = spark.createDataFrame([*data, ("b", None)], "g string, v double")
    got = {r["g"]: (r["median"], r["n"]) for r in exact_median(df, ["g"], "v").collect()}
    assert got == {"a": (3.0, 4), "b": (2.5, 1), "c": (8.0, 101)}


def test_median_price_needs_enough_sales(spark):
    rows = [{**SALE, "id_mutation": str(i), "date_mutation": "2023-05-01", "valeur_fonciere": str(82000 + 8200 * i)} for i in range(21)]
    rows += [{**SALE, "id_mutation": f"r{i}", "date_mutation": "2023-05-01", "nom_commune": "Rare"} for i in range(3)]
    got = median_price(sales_from_lines(sale_lines(spark, rows))).collect()
    assert [tuple(r) for r in got] == [("Vallonet", 2000, 21)]


def test_line_counts_add_up(spark):
    """Invariants on whole driver tables."""
    from terrier.operators.sales import market_sales
    from terrier.registry import analogues as an
    from terrier.registry.queries import full_sales

    sf = "/root/testdata/sf0.001"
    sales = full_sales(spark, sf).select("nb_lignes", "cle_vente").collect()
    assert sum(r["nb_lignes"] for r in sales) == market_sales(an.sale_lines(spark, sf)).count()
    assert len({r["cle_vente"] for r in sales}) == len(sales)


SPANNING = [
    {**SALE, "id_mutation": "1", "code_departement": "03", "id_parcelle": "a"},
    {**SALE, "id_mutation": "1", "code_departement": "63", "id_parcelle": "b"},
    {**SALE, "id_mutation": "1", "code_departement": "63", "nature_mutation": "Echange"},
    {**SALE, "id_mutation": "2", "code_departement": "63"},
    {**SALE, "id_mutation": "3", "code_departement": "63", "nature_mutation": "Echange"},
    {**SALE, "id_mutation": "4", "code_departement": None},
]


def test_lines_count_where_their_sale_is(spark):
    lines = sale_lines(spark, SPANNING)
    got = {r["code_departement"]: (r["mutations"], r["lignes_source"], r["lignes_ecartees"]) for r in sales_report(sales_from_lines(lines), lines).collect()}
    assert got == {"03": (1, 3, 1), "63": (1, 2, 1), None: (1, 1, 0)}


def test_line_report_of_whole_tables(spark):
    from terrier.registry import analogues as an
    from terrier.registry.queries import sales_report as registered

    sf = "/root/testdata/sf0.001"
    rows = registered(spark, sf).collect()
    assert all(r["lignes_ecartees"] >= 0 for r in rows)
    assert sum(r["lignes_source"] for r in rows) == an.sale_lines(spark, sf).count()


def test_departments_are_prepared_one_after_the_other(spark, tmp_path):
    rows = [{k: v for k, v in r.items() if v is not None} for r in SPANNING]
    path, out = write_csv(tmp_path / "a.csv", LINE_COLUMNS, rows), str(tmp_path / "out")
    report = prepare_sales(spark, [[path]], out, departments="63")
    assert [(r["code_departement"], r["mutations"]) for r in report.collect()] == [("63", 1)]
    prepare_sales(spark, [[path]], out, departments="3,03")
    got = {r["id_mutation"]: (r["dept"], r["nb_lignes"]) for r in read_table(spark, out).collect()}
    assert got == {"1": ("03", 2), "2": ("63", 1)}
    with pytest.raises(ValueError, match="names no department"):
        prepare_sales(spark, [[path]], out, departments=",")


def test_scratch_tables_go_with_the_job(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [{**SALE, "id_mutation": "1"}])
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    prepare_sales(spark, [[path]], str(tmp_path / "out"))
    assert set(shared.iterdir()) == before


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from terrier.session import scratch_path

    for master, allowed in (("yarn", False), ("local-cluster[2,1,1024]", False), ("local[8]", True), ("local", True)):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
        if allowed:
            assert "/x-" in scratch_path(fake, "x")
        else:
            with pytest.raises(ValueError, match="shared folder"):
                scratch_path(fake, "x")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_only_full_dates_are_dates(spark, ansi):
    from terrier.functions.casts import lenient_date, strict_date

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for text in ("2020-03  ", "+2020-03", "   2020 ", "2020-03-04 garbage"):
            df = spark.createDataFrame([(text,)], "t string")
            with pytest.raises(Exception, match="(?i)date"):
                df.select(strict_date(F.col("t"))).collect()
            assert df.select(lenient_date(F.col("t"))).first()[0] is None
        good = spark.createDataFrame([(" 2020-3-04 ",), (None,)], "t string").select(strict_date(F.col("t"))).collect()
        assert [str(r[0]) for r in good] == ["2020-03-04", "None"]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_departments_that_exist_are_skipped_unless_forced(spark, tmp_path):
    path, out = write_csv(tmp_path / "a.csv", LINE_COLUMNS, [{**SALE, "id_mutation": "1"}]), str(tmp_path / "out")
    prepare_sales(spark, [[path]], out, departments="15")
    other = write_csv(tmp_path / "b.csv", LINE_COLUMNS, [{**SALE, "id_mutation": "2"}, {**SALE, "id_mutation": "3", "code_departement": "63"}])
    prepare_sales(spark, [[other]], out, departments="15", force=False)
    prepare_sales(spark, [[other]], out, departments="15,63", force=False)
    assert {r["id_mutation"]: r["dept"] for r in read_table(spark, out).collect()} == {"1": "15", "3": "63"}


def test_unreadable_price_is_not_a_missing_price(spark):
    odd = {**SALE, "valeur_fonciere": "n.c."}
    both = sources(spark, [{**odd, "id_mutation": "a"}], [{**SALE, "id_mutation": "b", "valeur_fonciere": None}])
    assert {r["id_mutation"] for r in prefer_later_sources(both, sale_match_key()).collect()} == {"a", "b"}
