"""Housing-shaped tables derived from the driver's tables.

Each function reads whole tables and renames or computes columns, so the registered queries run
the very operators of the package at any scale. Raw shapes are all text, as landed files are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_START = "1997-01-01"  # the official source covers sales from this day on


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def code(value: Column, width: int) -> Column:
    """Zeros in front up to ``width``; a longer number stays whole."""
    digits = value.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def prefixed(prefix: str, value: Column, width: int = 8) -> Column:
    return F.concat(F.lit(prefix), code(value, width))


def nothing_if(absent: Column, value: Column) -> Column:
    return F.when(~absent, value)


def sale_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with its order: the order's price repeats on each line, as a sale's does."""
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    # What an order says of its sale is written once per order, not once per line.
    order = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.col("o_orderkey").cast("string")).alias("id_mutation"),
        F.col("o_orderdate").cast("date").cast("string").alias("date_mutation"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Echange").otherwise("Vente").alias("nature_mutation"),
        nothing_if(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice").cast("string")).alias("valeur_fonciere"),
    )
    kind = F.col("l_partkey") % 50 + 1
    commune = F.col("l_suppkey") % 36000
    # Orders grow with the lines, so this is a shuffled join at any size worth planning for.
    return line.join(order.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "id_mutation",
        "date_mutation",
        "nature_mutation",
        "valeur_fonciere",
        code(commune, 5).alias("code_commune"),
        prefixed("Commune ", commune, 5).alias("nom_commune"),
        code(commune * 10 % 100000, 5).alias("code_postal"),
        code(F.col("l_suppkey") % 19 + 1, 2).alias("code_departement"),
        code(F.col("l_partkey"), 14).alias("id_parcelle"),
        nothing_if(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string")).alias("surface_reelle_bati"),
        (F.col("l_quantity") * 10).cast("string").alias("surface_terrain"),
        F.col("l_linenumber").cast("string").alias("nombre_pieces_principales"),
        F.when(kind % 5 == 0, None).when(kind <= 30, "1").when(kind <= 46, "2").when(kind <= 48, "3").otherwise("4").alias("code_type_local"),
        F.when(kind % 5 == 0, None).when(kind <= 30, "Maison").when(kind <= 46, "Appartement").when(kind <= 48, "Dependance").otherwise("Local").alias("type_local"),
        nothing_if(F.col("l_partkey") % 37 == 0, (F.col("l_suppkey") % 150 / 10 - 5).cast("string")).alias("longitude"),
        nothing_if(F.col("l_partkey") % 37 == 0, (F.col("l_partkey") % 105 / 10 + 41).cast("string")).alias("latitude"),
    )


def archive_lines(lines: DataFrame) -> DataFrame:
    """An older vintage of the same lines: all years, other identifiers, areas not yet corrected."""
    area = F.col("surface_reelle_bati").cast("double") + 1
    return lines.withColumns(
        {"surface_reelle_bati": area.cast("string"), "id_mutation": F.concat(F.lit("A"), F.col("id_mutation"))}
    )


def official_lines(lines: DataFrame) -> DataFrame:
    """The official source only publishes a sliding window of years."""
    return lines.filter(F.col("date_mutation") >= WINDOW_START)


def diagnostics_raw(spark: SparkSession, sf: str) -> DataFrame:
    """events as the 21 text columns of raw diagnostics."""
    return diagnostics_from_events(table(spark, sf, "events"))


def diagnostics_from_events(events: DataFrame) -> DataFrame:
    """Works on a stream of events as well."""
    n = F.col("event_id")

    def pick(number: Column, *values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))

    # Territory, and an origin inside it from which points are spread.
    zones = ["33", "75", "2A", "971", "974", "988"]
    dept = pick(F.col("user_id"), *zones)
    east = pick(F.col("user_id"), 415022, 652000, 1180000, 653431, 337000, 400000)
    north = pick(F.col("user_id"), 6422103, 6862000, 6100000, 1774592, 7650000, 300000)
    signed = F.date_add(F.lit("1995-01-01").cast("date"), (n * 37 % 2400).cast("int"))
    lost = n % 11 == 0
    return events.select(
        prefixed("D", n).alias("numero_dpe"),
        F.when((n % 7 == 0) & (n >= 3), prefixed("D", n - 3)).alias("numero_dpe_remplace"),
        signed.cast("string").alias("date_etablissement_dpe"),
        F.date_add(signed, 3652).cast("string").alias("date_fin_validite_dpe"),
        nothing_if(F.col("event_type") == "error", pick(n, *"abcdefg")).alias("etiquette_dpe"),
        pick(n, *"gfedcba").alias("etiquette_ges"),
        (n % 400 + 0.5).cast("string").alias("conso_5_usages_par_m2_ep"),
        (n % 90).cast("string").alias("emission_ges_5_usages_par_m2"),
        (n % 150 + 20).cast("string").alias("surface_habitable_logement"),
        pick(n, "maison", "appartement", "immeuble").alias("type_batiment"),
        (n % 120 + 1900).cast("string").alias("annee_construction"),
        F.when(n % 120 < 48, "avant 1948").otherwise("1948 et apres").alias("periode_construction"),
        F.concat(F.lit("rue "), F.col("user_id").cast("string")).alias("adresse_ban"),
        pick(F.col("user_id"), *[f"{z}000" for z in zones]).alias("code_postal_ban"),
        pick(F.col("user_id"), *[f"{z}001" for z in zones]).alias("code_insee_ban"),
        dept.alias("code_departement_ban"),
        prefixed("ban", F.col("user_id")).alias("identifiant_ban"),
        nothing_if(lost, (east + n % 1000 * 10).cast("string")).alias("coordonnee_cartographique_x_ban"),
        nothing_if(lost, (north + n % 900 * 10).cast("string")).alias("coordonnee_cartographique_y_ban"),
        nothing_if(n % 13 == 0, (n % 100 / 100).cast("string")).alias("score_ban"),
        F.lit("adresse geocodee").alias("statut_geocodage"),
    )


# A place inside each territory, in its own system.
ORIGINS = {
    "33": (415022, 6422103),
    "2A": (1180000, 6100000),
    "971": (653431, 1774592),
    "972": (712000, 1612000),
    "973": (352000, 540000),
    "974": (337000, 7650000),
    "975": (557000, 5180000),
    "976": (514000, 8581000),
    "977": (516000, 1977000),
    "978": (491000, 1996000),
    "988": (400000, 300000),
}


def points_everywhere(spark: SparkSession, sf: str) -> DataFrame:
    """events as points spread from the origins of all territories."""
    n = F.col("event_id")
    origin = F.get(F.array(*[F.struct(F.lit(d).alias("dept"), F.lit(x).alias("x"), F.lit(y).alias("y")) for d, (x, y) in ORIGINS.items()]), (n % 11).cast("int"))
    x, y = (origin["x"] + n % 1000 * 10).cast("double"), (origin["y"] + n % 900 * 10).cast("double")
    return table(spark, sf, "events").select("event_id", origin["dept"].alias("dept"), x.alias("x"), y.alias("y"))


def building_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """supplier as buildings, lineitem as their links to parcels."""
    s = table(spark, sf, "supplier")
    n = F.col("s_suppkey")
    ident = prefixed("B", n).alias("batiment_groupe_id")
    dept = code(n % 19 + 1, 2)
    x, y = n % 4000 * 25 + 400000, n % 5000 * 30 + 6300000

    def corner(dx: int, dy: int) -> Column:
        return F.concat((x + dx).cast("string"), F.lit(" "), (y + dy).cast("string"))

    outline = F.concat(
        F.lit("MULTIPOLYGON(((" ),
        F.concat_ws(",", corner(0, 0), corner(10, 0), corner(10, 8), corner(0, 8), corner(0, 0)),
        F.lit(")))"),
    )
    # A line each: a link that several lines name is listed as often, and is principal if one of them says so.
    links = table(spark, sf, "lineitem")
    return {
        "groupe": s.select(
            ident,
            code(n, 5).alias("code_commune_insee"),
            dept.alias("code_departement_insee"),
            F.col("s_acctbal").cast("string").alias("s_geom_groupe"),
            nothing_if(n % 19 == 0, outline).alias("geom_groupe"),
        ),
        "ffo": s.filter(n % 9 != 0).select(
            ident,
            F.when(n % 13 == 0, "n.c.").otherwise((n % 120 + 1900).cast("string")).alias("annee_construction"),
            F.when(n % 2 == 0, "pierre").otherwise("beton").alias("mat_mur_txt"),
            F.when(n % 3 == 0, "tuile").otherwise("ardoise").alias("mat_toit_txt"),
            (n % 7 + 0.5).cast("string").alias("nb_niveau"),
            nothing_if(n % 10 == 0, (n % 17).cast("string")).alias("nb_log"),
            (n % 3).cast("string").alias("nb_log_vac"),
            (n % 11).cast("string").alias("nb_log_residence_principale"),
            (n % 5).cast("string").alias("nb_log_residence_secondaire"),
            (n % 4).cast("string").alias("nb_log_soc"),
            F.col("s_acctbal").cast("string").alias("s_log"),
            F.when(n % 6 == 0, "annexe").otherwise("residentiel").alias("usage_principal"),
        ),
        "topo": s.filter(n % 2 == 0).select(ident, (n % 300 / 10).cast("string").alias("hauteur_mean")),
        "dpe": s.filter(n % 3 != 0).select(
            ident,
            prefixed("D", n * 97).alias("identifiant_dpe"),
            F.substring(F.lit("abcdefg"), (n % 7 + 1).cast("int"), F.lit(1)).alias("classe_bilan_dpe"),
            F.substring(F.lit("gfedcba"), (n % 7 + 1).cast("int"), F.lit(1)).alias("classe_emission_ges"),
            (n % 350).cast("string").alias("conso_5_usages_ep_m2"),
        ),
        "parcelle": links.select(
            prefixed("B", F.col("l_suppkey")).alias("batiment_groupe_id"),
            code(F.col("l_partkey"), 14).alias("parcelle_id"),
            code(F.col("l_suppkey") % 19 + 1, 2).alias("code_departement_insee"),
            F.when(F.col("l_linestatus") == "F", "T").otherwise("f").alias("parcelle_principale"),
        ),
    }
