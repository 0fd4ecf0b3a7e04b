"""Quality flags. Rows are marked, never dropped: the reader decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels are part of the published tables.
MIN_PRICE_M2 = 500
MAX_PRICE_M2 = 30000
DWELLING_TYPES = (1, 2)
MIN_POSITION_SCORE = 0.5


def price_per_m2(price: Column, area: Column) -> Column:
    """To the cent. Whole cents are rounded, not the decimal text of the ratio: the two differ
    where a ratio lies half way between cents, and published prices follow the former."""
    return F.when(area > 0, F.round(price / area * 100) / 100)


def price_quality(price: Column, area: Column, dwelling_type: Column, n_types: Column) -> Column:
    """Why a price per square metre is unusable, or ``ok``.

    The order of the tests matters. An unknown dwelling type is neither in nor out of the
    list, so it falls through to the next test. Bounds apply to the unrounded ratio.
    """
    ratio = price / area
    return (
        F.when(area.isNull() | (area <= 0), "sans_surface")
        .when(~dwelling_type.isin(*DWELLING_TYPES), "type_non_logement")
        .when(n_types > 1, "mutation_composite")
        .when(ratio < MIN_PRICE_M2, "prix_m2_bas")
        .when(ratio > MAX_PRICE_M2, "prix_m2_haut")
        .otherwise("ok")
    )


def position_quality(longitude: Column, score: Column) -> Column:
    return (
        F.when(longitude.isNull(), "sans_position")
        .when(score.isNull(), "score_inconnu")
        .when(score < MIN_POSITION_SCORE, "position_incertaine")
        .otherwise("ok")
    )
