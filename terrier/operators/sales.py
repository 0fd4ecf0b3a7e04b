"""Sale lines to sales: filter, collapse, stable key, price flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.casts import number_text, strict_date, strict_double, strict_int
from terrier.functions.flags import price_per_m2, price_quality
from terrier.operators.ranking import rank_in_group

MARKET_SALE = "Vente"  # fixed value

SALE_COLUMNS = [
    "id_mutation",
    "date_mutation",
    "annee",
    "nature_mutation",
    "valeur_fonciere",
    "code_commune",
    "nom_commune",
    "code_postal",
    "code_departement",
    "nb_communes",
    "id_parcelle",
    "nb_parcelles",
    "surface_bati",
    "surface_terrain",
    "nb_pieces",
    "nb_lignes",
    "nb_types",
    "code_type_local",
    "type_local",
    "longitude",
    "latitude",
]


def is_market_sale() -> Column:
    return (F.col("nature_mutation") == MARKET_SALE) & F.col("valeur_fonciere").isNotNull()


def market_sales(lines: DataFrame) -> DataFrame:
    """Lines with a negotiated price: exchanges, expropriations and auctions have none."""
    return lines.filter(is_market_sale())


def typed_lines(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns the collapse reads, typed; text that does not parse fails the job."""
    number = {
        "valeur_fonciere": strict_double,
        "surface_reelle_bati": strict_double,
        "surface_terrain": strict_double,
        "longitude": strict_double,
        "latitude": strict_double,
        "nombre_pieces_principales": lambda c: strict_int(c, "int"),
    }
    text = [
        "id_mutation",
        "date_mutation",
        "nature_mutation",
        "code_commune",
        "nom_commune",
        "code_postal",
        "code_departement",
        "id_parcelle",
        "code_type_local",
        "type_local",
    ]
    return lines.select(
        *[F.col(c) for c in [*text, *(keep or [])]], *[cast(F.col(c)).alias(c) for c, cast in number.items()]
    )


def of_most_built(value: str, area: str = "surface_reelle_bati", parcel: str = "id_parcelle") -> Column:
    """Aggregate: ``value`` on the line with the largest built area, else the smallest value.

    Lines where either is NULL do not compete. Equal areas are settled by the parcel, so that
    the columns picked this way come from the same place.
    """
    contender = F.when(
        F.col(value).isNotNull() & F.col(area).isNotNull(), F.struct(F.col(area), F.col(parcel), F.col(value))
    )
    return F.coalesce(F.max(contender)[value], F.min(value))


def collapse(lines: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per sale from typed market lines, with its content fingerprint.

    The price repeats on every line of a sale, so it is taken once while areas add up. Grouping
    is on the sale alone: a sale may span communes, and splitting it would repeat its price.

    Everything is one combining aggregate, hence one shuffle, and copies of a line melt away
    before it. The sets hold the distinct communes, types and parcels of one sale; the
    fingerprint hashes the full parcel list as one text, so that list is the size of a result
    cell whatever the plan.
    """
    by = by or ["id_mutation"]
    # Identifiers begin alike. Behind a digest they are sorted by eight bytes instead of as whole texts.
    grouped = lines.groupBy(F.xxhash64(*by).alias("_digest"), *by).agg(
        F.min("date_mutation").alias("_date"),
        F.min("nature_mutation").alias("nature_mutation"),
        F.max("valeur_fonciere").alias("valeur_fonciere"),
        of_most_built("code_commune").alias("code_commune"),
        of_most_built("nom_commune").alias("nom_commune"),
        of_most_built("code_postal").alias("code_postal"),
        F.min("code_departement").alias("code_departement"),
        F.size(F.collect_set("code_commune")).cast("long").alias("nb_communes"),
        F.min("id_parcelle").alias("id_parcelle"),
        F.array_sort(F.collect_set("id_parcelle")).alias("_parcels"),
        F.sum("surface_reelle_bati").alias("surface_bati"),
        F.sum("surface_terrain").alias("surface_terrain"),
        F.max("nombre_pieces_principales").alias("nb_pieces"),
        F.count(F.lit(1)).alias("nb_lignes"),
        F.size(F.collect_set("code_type_local")).cast("long").alias("nb_types"),
        F.min(strict_int(F.col("code_type_local"), "tinyint")).alias("code_type_local"),
        F.min("type_local").alias("type_local"),
        F.avg("longitude").alias("longitude"),
        F.avg("latitude").alias("latitude"),
    )
    fingerprint = F.md5(
        F.concat(
            F.col("_date"),
            F.lit("|"),
            number_text(F.col("valeur_fonciere")),
            F.lit("|"),
            F.array_join("_parcels", ","),
        )
    )
    return grouped.withColumns(
        {
            "nb_parcelles": F.size("_parcels").cast("long"),
            "_fingerprint": fingerprint,
            "date_mutation": strict_date(F.col("_date")),
            "annee": F.year(strict_date(F.col("_date"))).cast("smallint"),
        }
    ).select(*SALE_COLUMNS, "_fingerprint")


def key_suffix(rank: Column) -> Column:
    """Two digits, or more once they are needed: cutting '100' to '10' would repeat a key."""
    return F.when(rank < 100, F.lpad(rank.cast("string"), 2, "0")).otherwise(rank.cast("string"))


# Twins are told apart by content only. Identifiers are reassigned at every publication, so
# they come last, to order rows that are alike in everything that counts.
TWIN_ORDER = ["surface_bati", "surface_terrain", "nb_pieces", "code_type_local", "nb_lignes", "nb_parcelles"]
TWIN_TIES = ["type_local", "code_commune", "longitude", "latitude", "id_mutation"]


def add_sale_key(
    sales: DataFrame,
    fingerprint: str = "_fingerprint",
    order: list[str] | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Adds ``cle_vente``: fingerprint and rank among the sales that share it.

    Every sale gets a rank, not only colliding ones, so a twin that appears later leaves the key
    of the first one as it was. ``largest`` bounds the number of sales with one fingerprint.
    """
    columns = order or [*TWIN_ORDER, *TWIN_TIES]
    ranked = rank_in_group(
        sales, [fingerprint], [F.col(c).asc_nulls_last() for c in columns], "_twin", largest=largest
    )
    key = F.concat(F.col(fingerprint), F.lit("-"), key_suffix(F.col("_twin")))
    kept = [c for c in sales.columns if c != fingerprint]
    return ranked.select(*kept, key.alias("cle_vente"))


def add_price_flag(sales: DataFrame) -> DataFrame:
    price, area = F.col("valeur_fonciere"), F.col("surface_bati")
    return sales.withColumns(
        {
            "prix_m2": price_per_m2(price, area),
            "qualite_prix_m2": price_quality(price, area, F.col("code_type_local"), F.col("nb_types")),
        }
    )
