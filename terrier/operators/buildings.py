"""Buildings: star join of the building tables and one building per parcel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.casts import lenient_double, lenient_int
from terrier.functions.footprints import add_footprints
from terrier.operators.joins import left_join_many
from terrier.session import materialize

ID = "batiment_groupe_id"

# Added to the number of a building that is not the parcel's principal one; larger than any number.
MINOR = 1 << 61

BUILDING_OUTPUT = [
    "batiment_groupe_id",
    "code_commune",
    "code_departement",
    "emprise_sol",
    "annee_construction",
    "materiau_mur",
    "materiau_toit",
    "nb_niveaux",
    "nb_logements",
    "nb_logements_vacants",
    "nb_residences_principales",
    "nb_residences_secondaires",
    "nb_logements_sociaux",
    "surface_logements",
    "usage_principal",
    "hauteur_moyenne",
    "identifiant_dpe",
    "classe_dpe",
    "classe_ges",
    "conso_kwh_m2",
    "geom",
    "parcelle_id",
]


def _absent(**types: str) -> list[Column]:
    return [F.lit(None).cast(t).alias(name) for name, t in types.items()]


def star(tables: dict[str, DataFrame], departments: list[str] | None = None) -> DataFrame:
    """Buildings with their tax-file, height and representative-diagnostic columns.

    All joins are left joins on the building id, so one shuffle per table and none in between. A
    table that is absent leaves typed NULL columns and costs nothing.
    """
    groups = tables["groupe"]
    if departments:
        groups = groups.filter(F.col("code_departement_insee").isin(*departments))
    geom = F.col("geom_groupe") if "geom_groupe" in groups.columns else F.lit(None).cast("string")
    out = groups.select(
        ID,
        F.col("code_commune_insee").alias("code_commune"),
        F.col("code_departement_insee").alias("code_departement"),
        lenient_int(F.col("s_geom_groupe")).alias("emprise_sol"),
        geom.alias("_footprint"),
    )
    tax = tables["ffo"].select(
        ID,
        lenient_int(F.col("annee_construction"), "smallint").alias("annee_construction"),
        F.col("mat_mur_txt").alias("materiau_mur"),
        F.col("mat_toit_txt").alias("materiau_toit"),
        lenient_int(F.col("nb_niveau"), "smallint").alias("nb_niveaux"),
        lenient_int(F.col("nb_log")).alias("nb_logements"),
        lenient_int(F.col("nb_log_vac")).alias("nb_logements_vacants"),
        lenient_int(F.col("nb_log_residence_principale")).alias("nb_residences_principales"),
        lenient_int(F.col("nb_log_residence_secondaire")).alias("nb_residences_secondaires"),
        lenient_int(F.col("nb_log_soc")).alias("nb_logements_sociaux"),
        lenient_int(F.col("s_log")).alias("surface_logements"),
        "usage_principal",
    )
    out = out.join(tax, ID, "left")
    if "topo" in tables:
        height = tables["topo"].select(ID, lenient_double(F.col("hauteur_mean")).alias("hauteur_moyenne"))
        out = out.join(height, ID, "left")
    else:
        out = out.select("*", *_absent(hauteur_moyenne="double"))
    if "dpe" in tables:
        energy = tables["dpe"].select(
            ID,
            "identifiant_dpe",
            F.upper("classe_bilan_dpe").alias("classe_dpe"),
            F.upper("classe_emission_ges").alias("classe_ges"),
            lenient_double(F.col("conso_5_usages_ep_m2")).alias("conso_kwh_m2"),
        )
        out = out.join(energy, ID, "left")
    else:
        out = out.select(
            "*",
            *_absent(identifiant_dpe="string", classe_dpe="string", classe_ges="string", conso_kwh_m2="double"),
        )
    return out


def is_principal(flag: Column) -> Column:
    """Whether the text marks the principal parcel: t, true or 1 in any case."""
    return F.coalesce(F.lower(flag.cast("string")).isin("t", "true", "1"), F.lit(False))


def arbitrate_parcels(relation: DataFrame, buildings: DataFrame) -> DataFrame:
    """One building per parcel: principal link first, then most dwellings, then smallest id.

    Buildings are numbered in that order first, so that the links need no sort: the best one of a
    parcel is the smallest number, a combining aggregate. A link listed twice counts once, and as
    principal if it is so in either place. The inner join also restricts parcels to the selected
    buildings; adaptive execution picks and splits it.
    """
    order = [F.col("nb_logements").desc_nulls_last(), F.col(ID).asc()]
    numbered = buildings.select(ID, "nb_logements").orderBy(*order).select(
        ID, F.monotonically_increasing_id().alias("_place")
    )
    # Both joins must see the same numbers.
    numbered = materialize(numbered, "numbered-buildings")
    minor = F.when(is_principal(F.col("parcelle_principale")), F.lit(0)).otherwise(F.lit(MINOR))
    best = (
        relation.select(ID, "parcelle_id", minor.cast("long").alias("_minor"))
        .join(numbered, ID, "inner")
        .groupBy("parcelle_id")
        .agg(F.min(F.col("_minor") + F.col("_place")).alias("_best"))
        .select("parcelle_id", (F.col("_best") % MINOR).alias("_place"))
    )
    return best.join(numbered, "_place", "inner").select("parcelle_id", ID)


def parcels_won(tables: dict[str, DataFrame], departments: list[str] | None = None) -> DataFrame:
    """The arbitration of a set of building tables; of those it needs only the dwelling counts."""
    dwellings = star({k: tables[k] for k in ("groupe", "ffo")}, departments)
    return arbitrate_parcels(tables["parcelle"], dwellings)


def attach_parcels(buildings: DataFrame, won: DataFrame | None) -> DataFrame:
    """Adds the parcels a building won: one row each, or one row with NULL."""
    if won is None:
        return buildings.select("*", *_absent(parcelle_id="string"))
    return left_join_many(buildings, won, ID)


def prepare_building_rows(
    tables: dict[str, DataFrame], departments: list[str] | None = None, srid: int | None = None
) -> DataFrame:
    """The building tables to the published building table."""
    placed = add_footprints(star(tables, departments), "_footprint", "code_departement", srid=srid)
    # Read by both sides of the attachment: arbitrated once.
    won = materialize(parcels_won(tables, departments), "parcels-won") if "parcelle" in tables else None
    return attach_parcels(placed, won).select(*BUILDING_OUTPUT)
