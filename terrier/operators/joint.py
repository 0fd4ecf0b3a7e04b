"""Sales enriched with their building and the diagnostic nearest in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.operators.joins import left_join_spread, nearest_in_time
from terrier.operators.ranking import best_per_group

# Fixed value: printed on every matched sale.
BUILDING_CAVEAT = "groupe de batiments : decrit l'immeuble, pas le logement"

BUILDING_SIDE = T.StructType(
    [
        T.StructField("parcelle_id", T.StringType()),
        T.StructField("batiment_groupe_id", T.StringType()),
        T.StructField("identifiant_dpe", T.StringType()),
        T.StructField("annee_construction", T.ShortType()),
        T.StructField("materiau_mur", T.StringType()),
        T.StructField("materiau_toit", T.StringType()),
        T.StructField("nb_niveaux", T.ShortType()),
        T.StructField("nb_logements", T.IntegerType()),
        T.StructField("nb_logements_vacants", T.IntegerType()),
        T.StructField("nb_logements_sociaux", T.IntegerType()),
        T.StructField("usage_principal", T.StringType()),
        T.StructField("hauteur_moyenne", T.DoubleType()),
        T.StructField("classe_dpe", T.StringType()),
    ]
)
DIAGNOSTIC_SIDE = T.StructType(
    [
        T.StructField("numero_dpe", T.StringType()),
        T.StructField("date_dpe", T.DateType()),
        T.StructField("classe_dpe", T.StringType()),
        T.StructField("classe_ges", T.StringType()),
        T.StructField("conso_kwh_m2", T.DoubleType()),
        T.StructField("est_remplace", T.BooleanType()),
    ]
)
BUILDING_KEPT = [
    "batiment_groupe_id",
    "annee_construction",
    "materiau_mur",
    "materiau_toit",
    "nb_niveaux",
    "nb_logements",
    "nb_logements_vacants",
    "nb_logements_sociaux",
    "usage_principal",
    "hauteur_moyenne",
]


def enrich_sales(
    sales: DataFrame, buildings: DataFrame | None = None, diagnostics: DataFrame | None = None
) -> DataFrame:
    """One row per sale, matched or not, with building and energy columns.

    A sale reaches a building through its parcel and a diagnostic through that building, so
    without buildings diagnostics are out of reach and the columns stay NULL. The building's own
    energy class stands in where no diagnostic qualifies.

    Buildings and diagnostics are joined first, into what is known per parcel; the sales
    themselves, the widest and largest side, are shuffled once, against at most one row per
    parcel and day. ``sales`` must hold each sale once, as the sale table does.
    """
    spark = sales.sparkSession
    bridge = buildings is not None
    known = buildings if bridge else spark.createDataFrame([], BUILDING_SIDE)
    energy = diagnostics if bridge and diagnostics is not None else spark.createDataFrame([], DIAGNOSTIC_SIDE)

    known = known.select(*BUILDING_SIDE.fieldNames()).filter(F.col("parcelle_id").isNotNull())
    known = known.withColumnRenamed("classe_dpe", "_class_of_building")
    current = energy.filter(~F.coalesce(F.col("est_remplace"), F.lit(False))).select(
        "numero_dpe",
        "date_dpe",
        F.col("classe_dpe").alias("_class"),
        F.col("classe_ges").alias("_class_ges"),
        F.col("conso_kwh_m2").alias("_conso"),
    )
    wanted = known.filter(F.col("identifiant_dpe").isNotNull())
    dated = wanted.join(current, F.col("identifiant_dpe") == F.col("numero_dpe"), "inner").drop("identifiant_dpe")
    matches = nearest_in_time(
        sales.select(F.col("id_parcelle").alias("parcelle_id"), "date_mutation"),
        dated,
        "parcelle_id",
        "date_mutation",
        "date_dpe",
        ["numero_dpe", "batiment_groupe_id"],
        out="_match",
    )
    fallback = best_per_group(known, ["parcelle_id"], [F.col("batiment_groupe_id")])
    carried = [*BUILDING_KEPT, "_class_of_building"]
    per_day = matches.join(fallback, "parcelle_id", "inner").select(
        F.col("parcelle_id").alias("_parcel"),
        F.col("date_mutation").alias("_sold"),
        *[
            F.when(F.col("_match").isNotNull(), F.col("_match")[c]).otherwise(F.col(c)).alias(c)
            for c in carried
        ],
        *[F.col("_match")[c].alias(c) for c in ("date_dpe", "_class", "_class_ges", "_conso")],
    )
    joined = left_join_spread(
        sales, per_day, ["id_parcelle", "date_mutation"], ["_parcel", "_sold"], spread_by=["cle_vente", "id_mutation"]
    )
    own, fallback_class = F.col("_class"), F.col("_class_of_building")
    return joined.select(
        *sales.columns,
        *BUILDING_KEPT,
        F.coalesce(own, fallback_class).alias("classe_dpe"),
        F.col("_class_ges").alias("classe_ges"),
        F.col("_conso").alias("conso_kwh_m2"),
        "date_dpe",
        F.when(own.isNotNull(), "ademe").when(fallback_class.isNotNull(), "bdnb").alias("source_dpe"),
        F.when(F.col("batiment_groupe_id").isNotNull(), BUILDING_CAVEAT).alias("precision_bati"),
    )
