"""Counts that go with each prepared table, per department or in total (``by=[]``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions.casts import share
from terrier.operators.sales import is_market_sale
from terrier.sources.delimited import PRIORITY

DEPT = ["code_departement"]

def _rows():
    return F.count(F.lit(1))


def _lines_by_sale(lines: DataFrame, by: list[str]) -> DataFrame:
    """Lines read, each filed where its sale is: by the smallest value among the lines kept for it,
    or among all its lines if none was kept. One grouping on the sale, then a handful of rows."""
    if not by:
        return lines.agg(_rows().alias("lignes_source"))
    sale = [c for c in (PRIORITY, "id_mutation") if c in lines.columns]
    filed = lines.groupBy(*sale).agg(
        *[F.coalesce(F.min(F.when(is_market_sale(), F.col(c))), F.min(c)).alias(c) for c in by if c not in sale],
        _rows().alias("_n"),
    )
    return filed.groupBy(*by).agg(F.sum("_n").alias("lignes_source"))


def sales_report(sales: DataFrame, source_lines: DataFrame | None = None, by: list[str] = DEPT) -> DataFrame:
    """Sales, lines behind them, usable and located shares, period.

    ``source_lines`` (lines after source precedence, before any filter) adds how many lines were
    read and dropped; a department with lines but no sale still gets its row. A line counts in the
    department of its sale, so that what is dropped is what was read less what was kept; lines
    without a department, and sales without one, share a row.
    """
    counted = sales.groupBy(*by).agg(
        _rows().alias("mutations"),
        F.sum("nb_lignes").alias("lignes_retenues"),
        F.count_if(F.col("qualite_prix_m2") == "ok").alias("exploitables"),
        F.count_if(F.col("longitude").isNotNull()).alias("geolocalisees"),
        F.min("date_mutation").alias("debut"),
        F.max("date_mutation").alias("fin"),
    )
    out = [*by, "mutations", "lignes_retenues", "exploitables"]
    if source_lines is not None:
        lines = _lines_by_sale(source_lines, by)
        if by:
            read = lines.withColumnsRenamed({c: f"_read_{c}" for c in by})
            same = [F.col(c).eqNullSafe(F.col(f"_read_{c}")) for c in by]
            counted = counted.join(read, same, "full_outer").withColumns({c: F.coalesce(c, f"_read_{c}") for c in by})
        else:
            counted = counted.withColumn("lignes_source", lines.scalar())
        kept = F.coalesce(F.col("lignes_retenues"), F.lit(0))
        counted = counted.withColumns(
            {
                "mutations": F.coalesce("mutations", F.lit(0)),
                "exploitables": F.coalesce("exploitables", F.lit(0)),
                "lignes_retenues": kept,
                "lignes_source": F.coalesce("lignes_source", F.lit(0)),
                "lignes_ecartees": F.coalesce("lignes_source", F.lit(0)) - kept,
            }
        )
        out += ["lignes_source", "lignes_ecartees"]
    return counted.select(
        *out,
        share(F.col("exploitables"), F.col("mutations")).alias("part_exploitable"),
        share(F.col("geolocalisees"), F.col("mutations")).alias("part_geolocalisee"),
        "debut",
        "fin",
    )


def diagnostics_report(diagnostics: DataFrame, by: list[str] = DEPT) -> DataFrame:
    counted = diagnostics.groupBy(*by).agg(
        _rows().alias("diagnostics"),
        F.count_if(~F.col("est_remplace")).alias("courants"),
        F.count_if(F.col("qualite_position") == "ok").alias("_placed"),
        F.min("date_dpe").alias("debut"),
        F.max("date_dpe").alias("fin"),
        F.min("latitude").alias("lat_min"),
        F.max("latitude").alias("lat_max"),
    )
    return counted.select(
        *by,
        "diagnostics",
        "courants",
        (F.col("diagnostics") - F.col("courants")).alias("remplaces"),
        share(F.col("_placed"), F.col("diagnostics")).alias("part_bien_positionnee"),
        "debut",
        "fin",
        "lat_min",
        "lat_max",
    )


def buildings_report(buildings: DataFrame, by: list[str] = DEPT) -> DataFrame:
    """Rows and dwellings as published (a building that won two parcels is two rows), plus the
    number of distinct buildings."""
    counted = buildings.groupBy(*by).agg(
        _rows().alias("batiments"),
        F.countDistinct("batiment_groupe_id").alias("batiments_distincts"),
        F.sum(F.coalesce("nb_logements", F.lit(0))).alias("logements"),
        F.count("parcelle_id").alias("_parcel"),
        F.count("classe_dpe").alias("_class"),
        F.count("annee_construction").alias("_year"),
        F.count("geom").alias("_geom"),
    )
    rows = F.col("batiments")
    return counted.select(
        *by,
        "batiments",
        "batiments_distincts",
        F.coalesce("logements", F.lit(0)).alias("logements"),
        share(F.col("_parcel"), rows).alias("part_rattachee_parcelle"),
        share(F.col("_class"), rows).alias("part_avec_dpe"),
        share(F.col("_year"), rows).alias("part_avec_annee"),
        share(F.col("_geom"), rows).alias("part_avec_geometrie"),
    )


def joint_report(joint: DataFrame, by: list[str] = DEPT) -> DataFrame:
    counted = joint.groupBy(*by).agg(
        _rows().alias("ventes"),
        F.count("batiment_groupe_id").alias("_building"),
        F.count("annee_construction").alias("_year"),
        F.count("classe_dpe").alias("_class"),
        F.count_if(F.col("source_dpe") == "ademe").alias("_own"),
    )
    sales = F.col("ventes")
    return counted.select(
        *by,
        "ventes",
        share(F.col("_building"), sales).alias("part_avec_batiment"),
        share(F.col("_year"), sales).alias("part_avec_annee_construction"),
        share(F.col("_class"), sales).alias("part_avec_classe_energie"),
        share(F.col("_own"), sales).alias("part_energie_depuis_ademe"),
    )


def absent_sources(buildings: DataFrame | None, diagnostics: DataFrame | None) -> list[str]:
    """Names of the sources the joint table had to do without."""
    names = []
    if buildings is None:
        names.append("bdnb")
    if buildings is None or diagnostics is None:
        names.append("dpe")
    return names


def joint_warning(buildings: DataFrame | None) -> str | None:
    """What the reader of a joint report without buildings must know."""
    if buildings is None:
        return "no building table: sales reach neither buildings nor diagnostics, and those columns are empty"
    return None


def median_price(sales: DataFrame, since_year: int = 2023, min_sales: int = 20) -> DataFrame:
    """Median price per square metre and sale count per commune, dearest first."""
    from terrier.functions.casts import to_rounded_int
    from terrier.operators.ranking import exact_median

    usable = sales.filter((F.col("annee") >= since_year) & (F.col("qualite_prix_m2") == "ok"))
    medians = exact_median(usable, ["nom_commune"], "prix_m2", out="_median").filter(F.col("n") >= min_sales)
    return medians.select(
        "nom_commune", to_rounded_int(F.col("_median")).alias("prix_m2"), F.col("n").alias("ventes")
    ).orderBy(F.desc("prix_m2"))
