"""Territory dimension: department codes, coordinate systems and expected extents.

A hundred rows by definition, so joins against it are broadcast. Codes are text: ``2A``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
METROPOLE = [f"{n:02d}" for n in range(1, 96) if n != 20] + ["2A", "2B"]
DEPARTMENTS = METROPOLE + ["971", "972", "973", "974", "976"]

METROPOLE_SRID = 2154
OVERSEAS_SRID = {
    "971": 5490,
    "972": 5490,
    "973": 2972,
    "974": 2975,
    "975": 4467,
    "976": 4471,
    "977": 5490,
    "978": 5490,
    "988": 3163,
}

# Extents as latitude min, latitude max, longitude min, longitude max. The box of 971 takes in
# the northern islands, which sales registers still file under it.
METROPOLE_BOX = (41.0, 51.5, -5.5, 9.8)
OVERSEAS_BOX = {
    "971": (15.7, 18.2, -63.2, -60.9),
    "972": (14.3, 15.0, -61.3, -60.7),
    "973": (2.0, 6.0, -55.0, -51.5),
    "974": (-21.5, -20.8, 55.1, 55.9),
    "975": (46.7, 47.2, -56.5, -56.1),
    "976": (-13.1, -12.6, 45.0, 45.3),
    "977": (17.8, 18.0, -63.0, -62.7),
    "978": (18.0, 18.2, -63.2, -62.9),
    "988": (-22.8, -19.5, 163.5, 168.2),
}

# Land registers of these departments are not part of the sales data: no rows is normal there.
SALES_UNCOVERED = ["57", "67", "68", "976"]

#: So many unknown codes are named in a refusal, those with the most rows; it tells how many there are.
NAMED_UNKNOWN = 20
BOX_COLUMNS = ("lat_min", "lat_max", "lon_min", "lon_max")


def territories(spark: SparkSession) -> DataFrame:
    """One row per known territory."""
    rows = [
        (
            code,
            code in DEPARTMENTS,
            OVERSEAS_SRID.get(code, METROPOLE_SRID),
            *map(float, OVERSEAS_BOX.get(code, METROPOLE_BOX)),
            code in SALES_UNCOVERED,
        )
        for code in sorted({*DEPARTMENTS, *OVERSEAS_SRID})
    ]
    schema = T.StructType(
        [
            T.StructField("dept", T.StringType(), False),
            T.StructField("is_department", T.BooleanType(), False),
            T.StructField("srid", T.IntegerType(), False),
            *[T.StructField(name, T.DoubleType(), False) for name in BOX_COLUMNS],
            T.StructField("sales_uncovered", T.BooleanType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


def unknown_territories(df: DataFrame, dept: str = "code_departement") -> DataFrame:
    """Distinct department codes for which no coordinate system is known, with their rows."""
    known = territories(df.sparkSession).select(F.col("dept").alias(dept))
    counts = df.groupBy(dept).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(F.broadcast(known), dept, "left_anti")


def require_known_territories(df: DataFrame, dept: str = "code_departement") -> None:
    """Refuse before any work is done rather than assume the metropolitan system."""
    unknown = unknown_territories(df, dept)
    n = unknown.count()
    if n:
        sample = [r[dept] for r in unknown.orderBy(F.desc("rows"), dept).limit(NAMED_UNKNOWN).collect()]
        raise ValueError(
            f"{n} unknown territory code(s), among them {sample}: its coordinate system is not on record; add it after "
            "checking that a real coordinate falls inside it"
        )


def parse_selector(requested: str | None) -> list[str] | None:
    """``"33,40,2a"`` to codes; None (no filter) for ``all``, ``tous`` or nothing."""
    if not requested or requested.strip().lower() in ("all", "tous"):
        return None
    codes = [code.strip().upper() for code in requested.split(",") if code.strip()]
    if not codes:
        raise ValueError(f"the selector {requested!r} names no department")
    return codes


def select_departments(df: DataFrame, requested: str | list[str] | None, dept: str = "dept") -> DataFrame:
    """Restrict to the requested departments; on a partitioned table this prunes partitions."""
    codes = parse_selector(requested) if isinstance(requested, str) or requested is None else requested
    if codes is not None and not codes:
        raise ValueError("an empty list of departments selects nothing")
    return df if codes is None else df.filter(F.col(dept).isin(*codes))
