"""Energy diagnostics: typing, reprojection, superseded mark, position flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions.casts import strict_date, strict_double, strict_int
from terrier.functions.flags import position_quality
from terrier.functions.projection import add_lon_lat
from terrier.operators.joins import left_join_spread

DIAGNOSTIC_OUTPUT = [
    "numero_dpe",
    "date_dpe",
    "date_fin_validite",
    "classe_dpe",
    "classe_ges",
    "conso_kwh_m2",
    "ges_kg_m2",
    "surface_habitable",
    "type_batiment",
    "annee_construction",
    "periode_construction",
    "adresse",
    "code_postal",
    "code_commune",
    "code_departement",
    "ban_id",
    "score_ban",
    "statut_geocodage",
    "longitude",
    "latitude",
    "est_remplace",
    "qualite_position",
]


def typed_diagnostics(raw: DataFrame) -> DataFrame:
    """The 21 text columns typed and renamed; diagnostics without a class are left out."""
    text = F.col
    return raw.filter(F.col("etiquette_dpe").isNotNull()).select(
        "numero_dpe",
        "numero_dpe_remplace",
        strict_date(text("date_etablissement_dpe")).alias("date_dpe"),
        strict_date(text("date_fin_validite_dpe")).alias("date_fin_validite"),
        F.upper("etiquette_dpe").alias("classe_dpe"),
        F.upper("etiquette_ges").alias("classe_ges"),
        strict_double(text("conso_5_usages_par_m2_ep")).alias("conso_kwh_m2"),
        strict_double(text("emission_ges_5_usages_par_m2")).alias("ges_kg_m2"),
        strict_double(text("surface_habitable_logement")).alias("surface_habitable"),
        "type_batiment",
        strict_int(text("annee_construction"), "smallint").alias("annee_construction"),
        "periode_construction",
        text("adresse_ban").alias("adresse"),
        text("code_postal_ban").alias("code_postal"),
        text("code_insee_ban").alias("code_commune"),
        text("code_departement_ban").alias("code_departement"),
        text("identifiant_ban").alias("ban_id"),
        strict_double(text("score_ban")).alias("score_ban"),
        "statut_geocodage",
        strict_double(text("coordonnee_cartographique_x_ban")).alias("_x"),
        strict_double(text("coordonnee_cartographique_y_ban")).alias("_y"),
    )


def mark_replaced(
    diagnostics: DataFrame,
    number: str = "numero_dpe",
    replaces: str = "numero_dpe_remplace",
    scope: str | None = None,
) -> DataFrame:
    """Adds ``est_remplace``: another diagnostic cites this one as the version it replaces.

    With ``scope`` (a department column) only citations from the same scope count. A diagnostic
    without a number is neither: NULL, or false when nothing was replaced at all in its scope.
    """
    keys = [number] + ([scope] if scope else [])
    cited = (
        diagnostics.filter(F.col(replaces).isNotNull())
        .select(F.col(replaces).alias("_cited"), *([F.col(scope).alias("_scope")] if scope else []))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    right = ["_cited"] + (["_scope"] if scope else [])
    marked = left_join_spread(diagnostics, cited, keys, right, spread_by=["date_dpe", "adresse"])
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    # 'x IN (empty set)' is false even for a NULL x, hence the check for a non-empty set.
    cites = diagnostics.filter(F.col(replaces).isNotNull())
    if scope:
        some = cites.groupBy(F.col(scope).alias("_some_scope")).agg(F.lit(True).alias("_some"))
        # One row per department at most.
        marked = marked.join(F.broadcast(some), F.col(scope).eqNullSafe(F.col("_some_scope")), "left")
        some = F.coalesce(F.col("_some"), F.lit(False))
    else:
        # Each task stops at its first citation.
        some = cites.select(F.lit(1).alias("_one")).limit(1).agg(F.count("_one") > 0).scalar()
    unknown = F.col(number).isNull() & some
    return marked.select(*diagnostics.columns, F.when(~unknown, hit).alias("est_remplace"))


def prepare_diagnostic_rows(raw: DataFrame, scope: str | None = None) -> DataFrame:
    """Raw text rows to the published diagnostic table."""
    placed = add_lon_lat(typed_diagnostics(raw), "code_departement", "_x", "_y")
    marked = mark_replaced(placed, scope=scope)
    flag = position_quality(F.col("longitude"), F.col("score_ban"))
    return marked.withColumn("qualite_position", flag).select(*DIAGNOSTIC_OUTPUT)
