"""Local metric coordinates to longitude and latitude, as plain column arithmetic.

Two families cover every territory: Lambert conformal conic (Snyder 1987) and transverse
Mercator (Krüger series, Karney 2011). Both inverses are closed forms, so the whole thing stays
inside generated code. The datum shift between the local frames and WGS 84 is taken as null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.functions.territories import METROPOLE, METROPOLE_SRID, OVERSEAS_SRID

# GRS 80 ellipsoid and the published parameters of each system.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101

# srid: (latitude of origin, central meridian, parallel 1, parallel 2, false east, false north)
CONIC = {
    2154: (46.5, 3.0, 49.0, 44.0, 700000.0, 6600000.0),
    3163: (-21.5, 166.0, -(20 + 40 / 60), -(22 + 20 / 60), 400000.0, 300000.0),
}
# srid: (central meridian, false north); scale 0.9996 and false east 500 000 throughout
MERCATOR = {
    5490: (-63.0, 0.0),
    2972: (-51.0, 0.0),
    2975: (57.0, 10000000.0),
    4467: (-57.0, 0.0),
    4471: (45.0, 10000000.0),
}
SCALE = 0.9996
FALSE_EAST = 500000.0

N3 = FLATTENING / (2 - FLATTENING)  # third flattening
ECC = math.sqrt(FLATTENING * (2 - FLATTENING))

# Series in the third flattening: conformal to geodetic latitude, and inverse Krüger (whose
# fourth term is a few micrometres).
TO_GEODETIC = (
    2 * N3 - 2 * N3**2 / 3 - 2 * N3**3 + 116 * N3**4 / 45,
    7 * N3**2 / 3 - 8 * N3**3 / 5 - 227 * N3**4 / 45,
    56 * N3**3 / 15 - 136 * N3**4 / 35,
    4279 * N3**4 / 630,
)
INVERSE_KRUGER = (
    N3 / 2 - 2 * N3**2 / 3 + 37 * N3**3 / 96 - N3**4 / 360,
    N3**2 / 48 + N3**3 / 15 - 437 * N3**4 / 1440,
    17 * N3**3 / 480 - 37 * N3**4 / 840,
)
RECTIFYING = SEMI_MAJOR / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)


@dataclass(frozen=True)
class Cone:
    """Derived constants of a conformal conic system."""

    n: float
    scale: float
    rho0: float
    lon0: float
    east: float
    north: float


def cone(srid: int) -> Cone:
    lat0, lon0, lat1, lat2, east, north = CONIC[srid]

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (ECC * math.sin(phi)) ** 2)

    def t(phi: float) -> float:
        es = ECC * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (ECC / 2)

    p0, p1, p2 = (math.radians(v) for v in (lat0, lat1, lat2))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    scale = SEMI_MAJOR * m(p1) / (n * t(p1) ** n)
    return Cone(n, scale, scale * t(p0) ** n, lon0, east, north)


PARAMETERS = T.StructType(
    [T.StructField("_territory", T.StringType(), False), T.StructField("srid", T.IntegerType())]
    + [T.StructField("_conic", T.BooleanType(), False)]
    + [T.StructField(f"_{c}", T.DoubleType(), False) for c in ("east", "north", "lon0", "side", "unit", "rho0", "power", "turn")]
)
NOWHERE = ""


def parameters(spark: SparkSession) -> DataFrame:
    """One row per territory, and one for all the others: its system and derived constants.

    Divisors are kept as their inverses. ``unit`` scales metres to the working unit (the radius
    of the cone's scale, or of the sphere), ``side`` is the hemisphere of a cone, ``power`` and
    ``turn`` its inverse constant.
    """
    nan = float("nan")
    rows = [(NOWHERE, None, True, nan, nan, nan, nan, nan, nan, nan, nan)]
    for dept in METROPOLE + list(OVERSEAS_SRID):
        srid = OVERSEAS_SRID.get(dept, METROPOLE_SRID)
        if srid in CONIC:
            c = cone(srid)
            side = math.copysign(1.0, c.n)
            rows.append((dept, srid, True, c.east, c.north, c.lon0, side, 1.0, c.rho0, 1 / c.n, 1 / c.scale))
        else:
            lon0, north = MERCATOR[srid]
            unit = 1 / (SCALE * RECTIFYING)
            rows.append((dept, srid, False, FALSE_EAST, north, lon0, 1.0, unit, 0.0, 1.0, 1.0))
    return spark.createDataFrame(rows, PARAMETERS)


def _series(angle: Column, coefficients: tuple[float, ...], wave) -> Column:
    terms = [F.lit(c) * wave(2.0 * k) for k, c in enumerate(coefficients, start=1)]
    return reduce(lambda a, b: a + b, terms, angle)


def add_lon_lat(df: DataFrame, dept: str, x: str, y: str) -> DataFrame:
    """Adds ``longitude`` and ``latitude`` (degrees), NULL where x or y is.

    The system follows from the territory of each row, so one job serves the whole country. The
    parameter table has a hundred rows by definition and is broadcast. A located row of an
    unknown territory fails the job: assuming the metropolitan system would put it on another
    continent.

    The arithmetic in between works on NaN instead of NULL and on inverses instead of divisors:
    nothing in it can be NULL, which keeps the generated code small enough to be compiled.
    """
    columns = df.columns
    known = F.col(dept).isin(METROPOLE + list(OVERSEAS_SRID))
    located = F.col(x).isNotNull() & F.col(y).isNotNull()
    params = F.broadcast(parameters(df.sparkSession))
    nan = F.lit(float("nan"))
    refusal = F.raise_error(
        F.concat(F.lit("unknown territory, no coordinate system on record: "), F.coalesce(F.col(dept), F.lit("NULL")))
    )
    placed = (
        df.withColumn("_key", F.when(known, F.coalesce(F.col(dept), F.lit(NOWHERE))).otherwise(F.lit(NOWHERE)))
        .join(params, F.col("_key") == F.col("_territory"))
        .withColumns(
            {
                "_u": F.coalesce(
                    F.when(located & (F.col("_key") == NOWHERE), refusal.cast("double")),
                    (F.coalesce(F.col(x), nan) - F.col("_east")) * F.col("_side") * F.col("_unit"),
                ),
                "_v": F.coalesce(F.col(y), nan) - F.col("_north"),
            }
        )
        .withColumn(
            "_v",
            F.when(F.col("_conic"), (F.col("_rho0") - F.col("_v")) * F.col("_side")).otherwise(
                F.col("_v") * F.col("_unit")
            ),
        )
    )
    u, v = F.col("_u"), F.col("_v")
    # Mercator: subtract the series to get the spherical coordinates.
    negative = tuple(-b for b in INVERSE_KRUGER)
    placed = placed.withColumns(
        {
            "_xi": F.when(F.col("_conic"), v).otherwise(
                _series(v, negative, lambda m: F.sin(v * m) * F.cosh(u * m))
            ),
            "_eta": F.when(F.col("_conic"), u).otherwise(
                _series(u, negative, lambda m: F.cos(v * m) * F.sinh(u * m))
            ),
        }
    )
    # Conic: xi and eta are still the plane coordinates.
    xi, eta = F.col("_xi"), F.col("_eta")
    rho = F.sqrt(xi * xi + eta * eta) * F.col("_side")
    across, along = F.sinh(eta), F.cos(xi)
    placed = placed.withColumns(
        {
            "_chi": F.when(
                F.col("_conic"), F.lit(math.pi / 2) - F.atan(F.pow(rho * F.col("_turn"), F.col("_power"))) * 2.0
            ).otherwise(F.atan2(F.sin(xi), F.sqrt(across * across + along * along))),
            "_lambda": F.when(F.col("_conic"), F.atan2(eta, xi) * F.col("_power")).otherwise(F.atan2(across, along)),
        }
    )
    chi = F.col("_chi")
    latitude = F.degrees(_series(chi, TO_GEODETIC, lambda m: F.sin(chi * m)))
    return placed.select(
        *columns,
        F.when(located, F.col("_lon0") + F.degrees("_lambda")).alias("longitude"),
        F.when(located, latitude).alias("latitude"),
    )
