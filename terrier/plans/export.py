"""Writing prepared tables, and what travels with them: CSV, DDL, fingerprints, manifest."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources import coverage, landing, ledger
from terrier.sources.tables import PARTITION, read_table

# Type names of the target database, columns worth an index, licence text.
SQL_TYPES = {
    "boolean": "boolean",
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "integer",
    "bigint": "bigint",
    "float": "real",
    "double": "double precision",
    "decimal": "numeric",
    "string": "text",
    "date": "date",
    "timestamp": "timestamptz",
    "timestamp_ntz": "timestamp",
    "binary": "bytea",
}
INDEXED = [
    "code_commune",
    "code_departement",
    "date_mutation",
    "date_dpe",
    "annee",
    "classe_dpe",
    "id_parcelle",
    "parcelle_id",
    "batiment_groupe_id",
    "qualite_prix_m2",
]
STABLE_KEYS = ["cle_vente", "numero_dpe"]
LICENCE = "Licence Ouverte 2.0 (Etalab)"

# Rows are laid out by these columns inside each file, for row-group skipping.
SORT_ORDER = [["date_mutation", "cle_vente"], ["date_dpe", "numero_dpe"], ["batiment_groupe_id"]]
MAX_ROWS_PER_FILE = 20_000_000
#: Keys by which single rows are looked up; each row group gets a Bloom filter on them.
LOOK_UP = ["cle_vente", "numero_dpe"]
#: Distinct keys a row group's filter is made for, at most: a row group holds fewer of these wide rows.
LOOK_UP_KEYS = 1_000_000
#: Bits of a place in each direction of the curve.
CURVE_BITS = 13


def layout_columns(df: DataFrame) -> list[str]:
    return next((cols for cols in SORT_ORDER if set(cols) <= set(df.columns)), [])


def curve(first: Column, second: Column, bits: int = CURVE_BITS) -> Column:
    """Place on a space-filling curve: the bits of two whole numbers in turn, so neighbours in either are near."""
    place = F.lit(0).cast("long")
    for i in range(bits):
        for at, number in ((2 * i + 1, first), (2 * i, second)):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(number.cast("long"), i).bitwiseAND(1), at))
    return place


def layout(df: DataFrame) -> list[Column]:
    """What a department's rows are sorted by: weeks and communes along a curve where a table has both, then its order.

    A look-up by date as well as one by commune then meets few row groups. Communes count by the last three
    digits of their code, which their department's communes differ in; rows without a date or a commune come first.
    """
    columns = layout_columns(df)
    if not columns or not columns[0].startswith("date") or "code_commune" not in df.columns:
        return [F.col(c) for c in columns]
    week = F.greatest(F.lit(0), F.floor(F.datediff(F.col(columns[0]), F.lit("1970-01-01").cast("date")) / 7) + 1)
    commune = F.regexp_extract("code_commune", "([0-9]{3})$", 1).try_cast("int") + 1
    # Twelve years of weeks and a department's communes take up about as many steps each.
    return [curve(F.coalesce(week, F.lit(0)) % 2**CURVE_BITS, F.coalesce(commune, F.lit(0))), *[F.col(c) for c in columns]]


def write_table(df: DataFrame, path: str, dept: str = "code_departement", mode: str = "replace") -> None:
    """One zstd Parquet dataset, partitioned by department.

    Rows are rebalanced on the department: small ones share a task, a huge one is split over
    several. Each task sorts its own rows; a global sort would add a pass and order nothing the
    partitions do not. ``mode="replace"`` rewrites only the departments present in ``df``; :func:`write_run` also
    removes those that ran empty.
    """
    keyed = df.withColumn(PARTITION, F.col(dept)) if dept != PARTITION else df
    # Computed once a row, not once a comparison.
    order = {f"_order_{i}": c for i, c in enumerate(layout(df))}
    writer = (
        keyed.hint("rebalance", PARTITION)
        .withColumns(order)
        .sortWithinPartitions(PARTITION, *order)
        .drop(*order)
        .write.partitionBy(PARTITION)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    )
    for key in LOOK_UP:
        if key in df.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", LOOK_UP_KEYS)
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def write_run(df: DataFrame, path: str, within: coverage.Scope, found: set[str | None], dept: str = "code_departement", mode: str = "replace") -> DataFrame:
    """Writes the rows of a run, removes departments it covered that have none any more, and records it all.

    A department was written if the file that was first in it is there no more, and its rows are in the files' footers.
    Returns the table as it is now, with the columns of ``df`` even if it holds no row at all.
    """
    spark = df.sparkSession
    before = {name: ledger.first_file(spark, f"{path}/{name}") for name in coverage.department_folders(spark, path)}
    write_table(df, path, dept, mode)
    new = [n for n in coverage.department_folders(spark, path) if not (before.get(n) and ledger.exists(spark, f"{path}/{n}/{before[n]}"))]
    written = {coverage.department_of(name) for name in new}
    schema = df.schema if dept == PARTITION else T.StructType([*df.schema, T.StructField(PARTITION, T.StringType())])
    now = spark.read.schema(schema).parquet(path)
    rows = {}
    if written:
        here = F.coalesce(F.col(PARTITION).isin(*[d for d in written if d is not None]), F.lit(None in written))
        rows = {r[PARTITION]: r["count"] for r in now.filter(here).groupBy(PARTITION).count().collect()}
    coverage.close_run(spark, path, within, rows, found)
    return spark.read.schema(schema).parquet(path)


def csv_columns(df: DataFrame) -> list[Column]:
    """Columns as the CSV prints them: binary in the hexadecimal form databases load."""
    return [
        F.when(F.col(f.name).isNotNull(), F.concat(F.lit("\\x"), F.lower(F.hex(f.name)))).alias(f.name)
        if isinstance(f.dataType, T.BinaryType)
        else F.col(f.name)
        for f in df.schema
    ]


def write_csv(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite") -> None:
    """Compressed CSV with a header, standard quoting, rows unchanged."""
    writer = (
        df.select(*csv_columns(df))
        .write.mode(mode)
        .option("header", "true")
        .option("escape", '"')
        .option("compression", "gzip")
    )
    if partition:
        writer = writer.partitionBy(partition)
    writer.csv(path)


def sql_type(data_type: T.DataType) -> str:
    """Decimals of up to 38 digits and whole numbers alike map by family name."""
    return SQL_TYPES.get(data_type.simpleString().split("(")[0], "text")


def schema_ddl(schema: T.StructType, table: str) -> str:
    """SQL that creates a table for the CSV files, loads them and adds the indexes."""
    columns = schema.fieldNames()
    key = next(iter([k for k in STABLE_KEYS if k in columns]), None)
    fields = [f"{f.name} {sql_type(f.dataType)}" + (" PRIMARY KEY" if f.name == key else "") for f in schema]
    parts = [f"-- Table {table}: {len(columns)} columns", "", f"CREATE TABLE IF NOT EXISTS {table} (\n  " + ",\n  ".join(fields) + "\n);"]
    # Every file has a header of its own, so files are loaded one by one.
    load = f"COPY {table} FROM STDIN WITH (FORMAT csv, HEADER true)"
    parts += ["", "-- To load, run in the folder of the CSV files:", f"--   for f in $(find . -name '*.csv.gz'); do gunzip -c \"$f\" | psql -c '{load}'; done"]
    indexed = [c for c in columns if c in INDEXED]
    if indexed:
        parts += ["", "-- After loading:", *(f"CREATE INDEX IF NOT EXISTS {c}_of_{table} ON {table} ({c});" for c in indexed)]
    if key:
        changed = ",\n--     ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
        parts += ["", f"-- A later vintage, loaded into {table}_next, updates by {key}:"]
        parts += [f"--   INSERT INTO {table} SELECT * FROM {table}_next ON CONFLICT ({key})", f"--   DO UPDATE SET\n--     {changed};"]
    return "\n".join(parts) + "\n"


def schema_types(df: DataFrame) -> DataFrame:
    """The column list of the DDL as rows: position, name, target type, key and index marks."""
    names = df.columns
    key = next((k for k in STABLE_KEYS if k in names), None)
    rows = [(i, f.name, sql_type(f.dataType), f.name == key, f.name in INDEXED) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, sql_type string, is_key boolean, is_indexed boolean"
    )


def rows_per_file(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each Parquet file; no data column is read."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("lignes"))
    )


def describe_files(spark: SparkSession, root: str, source: str) -> DataFrame:
    """One manifest line per file below ``root``: name, bytes, sha256, and rows for Parquet."""
    parquet = landing.fingerprints(spark, root, "*.parquet").join(rows_per_file(spark, root), "path", "left")
    return parquet.select(
        F.lit(source).alias("source"),
        F.substring_index(F.col("path"), root.rstrip("/") + "/", -1).alias("fichier"),
        F.col("length").alias("octets"),
        "sha256",
        "lignes",
    )


def describe_csv(spark: SparkSession, root: str, source: str) -> DataFrame:
    return landing.fingerprints(spark, root, "*.csv.gz").select(
        F.lit(source).alias("source"),
        F.substring_index(F.col("path"), root.rstrip("/") + "/", -1).alias("fichier"),
        F.col("length").alias("octets"),
        "sha256",
        F.lit(None).cast("long").alias("lignes"),
    )


def manifest_entries(files: DataFrame) -> DataFrame:
    """Files gathered per source with the Parquet row total. One entry per file, not per row."""
    return files.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("fichier", "octets", "sha256", "lignes"))).alias("fichiers"),
        F.concat(F.lit("schema/"), "source").alias("ddl"),
        F.coalesce(F.sum("lignes"), F.lit(0)).alias("lignes_totales"),
    )


def manifest(files: DataFrame, vintage: str, published: str | None = None) -> DataFrame:
    """The manifest as one JSON text (column ``value``)."""
    published = published or datetime.now(UTC).isoformat(timespec="seconds")
    per_source = F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("source", F.struct("fichiers", "ddl", "lignes_totales"))))
    )
    return (
        manifest_entries(files)
        .agg(per_source.alias("sources"))
        .select(
            F.to_json(
                F.struct(
                    F.lit(vintage).alias("millesime"),
                    F.lit(published).alias("publie_le"),
                    F.lit(LICENCE).alias("licence"),
                    "sources",
                )
            ).alias("value")
        )
    )


def manifest_totals(files: DataFrame) -> DataFrame:
    """Rows and files per source."""
    return files.groupBy("source").agg(
        F.coalesce(F.sum("lignes"), F.lit(0)).alias("lignes_totales"), F.count(F.lit(1)).alias("fichiers")
    )


def publish(spark: SparkSession, out: str, sources: list[str], vintage: str) -> DataFrame:
    """Adds CSV and DDL to the prepared tables below ``out`` and returns the manifest.

    The manifest and each DDL are single short texts and go through Spark's text sink, so they
    land on the same file system as the tables.
    """
    from functools import reduce

    described = []
    for source in sources:
        table_path, csv_path = f"{out}/{source}", f"{out}/csv/{source}"
        table = read_table(spark, table_path)
        write_csv(table, csv_path, PARTITION)
        ddl = schema_ddl(T.StructType([f for f in table.schema if f.name != PARTITION]), source)
        spark.createDataFrame([(ddl,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{out}/schema/{source}"
        )
        described += [describe_files(spark, table_path, source), describe_csv(spark, csv_path, source)]
    result = manifest(reduce(DataFrame.unionByName, described), vintage)
    result.coalesce(1).write.mode("overwrite").text(f"{out}/manifest")
    return spark.read.text(f"{out}/manifest")
