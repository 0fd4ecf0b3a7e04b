"""Reading prepared tables, manifests and what is already there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources import ledger
from terrier.sources.delimited import path_exists

PARTITION = "dept"

FILE_ENTRY = T.StructType(
    [
        T.StructField("fichier", T.StringType()),
        T.StructField("octets", T.LongType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("lignes", T.LongType()),
    ]
)
SOURCE_ENTRY = T.StructType(
    [
        T.StructField("fichiers", T.ArrayType(FILE_ENTRY)),
        T.StructField("ddl", T.StringType()),
        T.StructField("lignes_totales", T.LongType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("millesime", T.StringType()),
        T.StructField("publie_le", T.StringType()),
        T.StructField("licence", T.StringType()),
        T.StructField("sources", T.MapType(T.StringType(), SOURCE_ENTRY)),
    ]
)


def read_table(spark: SparkSession, path: str, partition: str = PARTITION) -> DataFrame:
    """A prepared table with its department as text: inference would read ``01`` as 1."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == partition else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_table_or_none(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The table, or None where there is none or it holds no department's rows."""
    if not path or not path_exists(spark, path) or not any(f.startswith(f"{PARTITION}=") for f in ledger.folders(spark, path)):
        return None
    return read_table(spark, path)


def datasets(spark: SparkSession, root: str) -> list[str]:
    """Names of the prepared tables below ``root``: the folders that hold departments, or a record of runs."""
    found = {name: ledger.folders(spark, f"{root}/{name}") for name in ledger.folders(spark, root)}
    return [n for n, below in found.items() if any(f.startswith(f"{PARTITION}=") or f == "_coverage" for f in below) and n != "csv"]


def produced(tables: dict[str, DataFrame], partition: str = PARTITION) -> DataFrame:
    """Distinct (source, dept) of the tables; reads partition values, no data column."""
    from functools import reduce

    parts = [t.select(F.lit(name).alias("source"), F.col(partition).alias("dept")).distinct() for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def missing_partitions(requested: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """Requested (source, dept) pairs still to be produced; all of them when forced."""
    if force:
        return requested
    return requested.join(existing.select("source", "dept").distinct(), ["source", "dept"], "left_anti")


def manifest_baseline(manifests: DataFrame, column: str = "value") -> DataFrame:
    """Rows per (source, dept) recorded in manifest texts, one manifest per row.

    Counts Parquet files only. The department comes from ``dept-33.parquet`` or from the
    ``dept=33`` folder a part file lies in; several files of a department add up.
    """
    parsed = manifests.select(F.from_json(F.col(column), MANIFEST)["sources"].alias("sources"))
    entries = (
        parsed.select(F.explode("sources").alias("source", "entry"))
        .select("source", F.explode("entry.fichiers").alias("file"))
        .filter(F.endswith(F.col("file.fichier"), F.lit(".parquet")))
    )
    name = F.col("file.fichier")
    folder = F.regexp_extract(name, r"(?:^|/)dept=([^/]+)/", 1)
    plain = F.regexp_replace(F.regexp_replace(name, r"^dept-", ""), r"\.parquet$", "")
    dept = F.when(folder != "", folder).otherwise(plain)
    return entries.groupBy("source", dept.alias("dept")).agg(F.sum("file.lignes").alias("lignes"))
