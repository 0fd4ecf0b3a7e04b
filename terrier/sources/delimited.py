"""Separated-text scans: every column text, dialect imposed, columns aligned by name."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrier.sources import landing

# Columns of the contracts below are named as the raw sources name them.
SALE_LINE_COLUMNS = [
    "id_mutation",
    "date_mutation",
    "nature_mutation",
    "valeur_fonciere",
    "code_commune",
    "id_parcelle",
    "surface_reelle_bati",
    "code_type_local",
    "longitude",
    "latitude",
]
# Read where present, NULL otherwise.
SALE_LINE_OPTIONAL = [
    "nom_commune",
    "code_postal",
    "code_departement",
    "surface_terrain",
    "nombre_pieces_principales",
    "type_local",
]
DIAGNOSTIC_COLUMNS = [
    "numero_dpe",
    "numero_dpe_remplace",
    "date_etablissement_dpe",
    "date_fin_validite_dpe",
    "etiquette_dpe",
    "etiquette_ges",
    "conso_5_usages_par_m2_ep",
    "emission_ges_5_usages_par_m2",
    "surface_habitable_logement",
    "type_batiment",
    "annee_construction",
    "periode_construction",
    "adresse_ban",
    "code_postal_ban",
    "code_insee_ban",
    "code_departement_ban",
    "identifiant_ban",
    "coordonnee_cartographique_x_ban",
    "coordonnee_cartographique_y_ban",
    "score_ban",
    "statut_geocodage",
]
BUILDING_TABLES = {
    "groupe": "batiment_groupe",
    "ffo": "batiment_groupe_ffo_bat",
    "topo": "batiment_groupe_bdtopo_bat",
    "dpe": "batiment_groupe_dpe_representatif_logement",
    "parcelle": "rel_batiment_groupe_parcelle",
}
MANDATORY_TABLES = ["groupe", "ffo"]

PRIORITY = "_source_priority"


def read_text_table(
    spark: SparkSession, paths: str | list[str], sep: str = ",", multiline: bool = False
) -> DataFrame:
    """One layout: all columns text, doubled quotes, ragged lines refused.

    Spark takes the header of one file for all of them, hence ``enforceSchema=false``: a file
    with another header fails the job instead of being misread by position. Column pruning in
    the parser is off because it hides ragged lines. ``multiline`` stops files from being split,
    so it is only for sources whose quoted fields hold line breaks.
    """
    return (
        spark.read.option("header", "true")
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
        .option("columnPruning", "false")
        .option("multiLine", str(multiline).lower())
        .csv(paths)
    )


def ragged_lines(spark: SparkSession, paths: list[str], sep: str = ",", pattern: str | None = None) -> DataFrame:
    """``file, line, text`` of the lines with more or fewer fields than their file's header; line 1 is the header.

    Each layout is read once in the permissive mode, which keeps a line it can't fit as it is. Only files that have
    such lines are read again, to number their lines. Lines that are alike are all listed.
    """
    found = []
    for header, files in layouts(spark, paths, pattern):
        names = [f"_{i}" for i in range(len(spark.read.option("header", "true").option("sep", sep).csv(files[0]).columns))]
        schema = ", ".join(f"{n} string" for n in [*names, "_ragged"])
        rows = (
            spark.read.schema(schema)
            .option("header", "true")
            .option("sep", sep)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_ragged")
            .option("columnPruning", "false")
            .csv(files)
        )
        # A scan must not ask for the kept line alone, so the first field has a part in the condition.
        kept = F.length(F.concat(F.col("_ragged"), F.coalesce("_0", F.lit("")))) >= 0
        found.append(rows.filter(kept).select(F.col("_metadata.file_path").alias("file"), F.col("_ragged").alias("text")))
    if not found:
        return spark.createDataFrame([], "file string, line long, text string")
    ragged = reduce(DataFrame.unionByName, found).distinct()
    files = [r["file"] for r in ragged.select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], "file string, line long, text string")
    lines = spark.read.text([unquote(f) for f in files]).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
    )
    numbered = lines.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("block", "place")).cast("long"))
    return numbered.join(ragged, ["file", "text"], "left_semi").select("file", "line", "text")


#: So many ragged lines are listed in a refusal; it tells how many there are.
LISTED_LINES = 20


@contextmanager
def refusal_with_evidence(spark: SparkSession, paths: list[str], sep: str = ",", pattern: str | None = None) -> Iterator[None]:
    """Where the work inside the block fails on a ragged line, all of them are found and listed before it is refused."""
    try:
        yield
    except Exception as error:
        if "MALFORMED_RECORD" not in str(error):
            raise
        ragged = ragged_lines(spark, paths, sep, pattern)
        listed = ragged.orderBy("file", "line").limit(LISTED_LINES).collect()
        if not listed:
            raise
        named = "; ".join(f"{r['file']}, line {r['line']}: {r['text'][:120]!r}" for r in listed)
        raise ValueError(f"malformed: {ragged.count()} line(s) don't have the fields of their header, the first {len(listed)}: {named}") from error


def layouts(spark: SparkSession, paths: list[str], pattern: str | None = None) -> list[tuple[str, list[str]]]:
    """Files grouped by header line. Holds file names only, as Spark's own file index does."""
    heads = landing.file_headers(landing.list_files(spark, paths, pattern))
    grouped = (
        heads.groupBy("header")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy("header")
    )
    return [(row["header"], row["paths"]) for row in grouped.collect()]


def scan_by_name(spark: SparkSession, paths: list[str], sep: str = ",", pattern: str | None = None) -> DataFrame:
    """Files with different headers as one table, columns aligned by name and missing ones NULL."""
    groups = [read_text_table(spark, files, sep) for _, files in layouts(spark, paths, pattern)]
    if not groups:
        raise ValueError("no source file to prepare")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def tag_priority(df: DataFrame, path_marker: str = "historique", column: str = PRIORITY) -> DataFrame:
    """0 for rows of files whose path holds the marker of the archive, 1 for the official ones."""
    archived = F.contains(F.col("_metadata.file_path"), F.lit(path_marker))
    return df.withColumn(column, F.when(archived, 0).otherwise(1))


def scan_sale_lines(spark: SparkSession, sources: list[list[str]]) -> list[DataFrame]:
    """One scan per source, from the lowest priority to the highest.

    Each source is a list of paths; priority is stated by the caller's order. Years that are
    missing for a department are simply not in the list.
    """
    scans = [check_sale_lines(scan_by_name(spark, paths)) for paths in sources if paths]
    if not scans:
        raise ValueError("no source file to prepare")
    return [complete_sale_lines(scan) for scan in scans]


def check_sale_lines(df: DataFrame) -> DataFrame:
    """Refuses an input that was not split into columns, or lacks a required one."""
    missing = [c for c in SALE_LINE_COLUMNS if c not in df.columns]
    if missing and len(df.columns) <= 2:
        raise ValueError(
            f"the source was not split into columns ({len(df.columns)} read): check that every "
            "line has as many fields as the header"
        )
    if missing:
        raise ValueError(f"columns missing from the source: {', '.join(missing)}; the format may have changed")
    return df


def complete_sale_lines(df: DataFrame) -> DataFrame:
    """Keeps the columns of the contract, the optional ones as NULL text where absent."""
    optional = [
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SALE_LINE_OPTIONAL
    ]
    return df.select(*SALE_LINE_COLUMNS, *optional)


def align_labels(df: DataFrame, expected: list[str] = DIAGNOSTIC_COLUMNS) -> DataFrame:
    """The expected columns as text, found by the letters and digits of their labels.

    Labels and keys of one export differ in case and in what stands between the words. What is not
    there becomes NULL text; a table with less than half of the columns is another kind of table.
    """
    by_letters = {re.sub(r"[\s_-]", "", name).casefold(): name for name in df.columns}
    source = {name: by_letters.get(name.replace("_", "").casefold()) for name in expected}
    found = [name for name in expected if source[name] is not None]
    if 2 * len(found) < len(expected):
        raise ValueError(f"only {len(found)} of {len(expected)} diagnostic columns recognised ({', '.join(found) or 'none'})")
    columns = [F.col(f"`{source[name]}`") if source[name] else F.lit(None) for name in expected]
    return df.select(*[column.cast("string").alias(name) for column, name in zip(columns, expected)])


def scan_diagnostics(spark: SparkSession, paths: list[str], pattern: str | None = None) -> DataFrame:
    """Landed diagnostic pages, each layout aligned to the 21 expected columns."""
    if not paths:
        raise ValueError("no diagnostic page to prepare")
    parts = [align_labels(read_text_table(spark, files)) for _, files in layouts(spark, paths, pattern)]
    if not parts:
        raise ValueError("no diagnostic page to prepare")
    return reduce(DataFrame.unionByName, parts)


def separator_of(line: Column) -> Column:
    """Of the known separators the one that cuts a header line into most fields, NULL if none cuts it.

    Column names hold no separator, so the header tells what the data, with their quoted fields,
    might not. Between equals the one listed first wins.
    """
    order = len(landing.SEPARATORS)
    ranked = [F.struct((F.length(line) - F.length(F.replace(line, F.lit(s)))).alias("cuts"), F.lit(order - i).alias("turn"), F.lit(s).alias("sep")) for i, s in enumerate(landing.SEPARATORS)]
    best = F.greatest(*ranked)
    return F.when(best["cuts"] > 0, best["sep"])


def scan_with_dialect(spark: SparkSession, path: str) -> DataFrame:
    """A table read by the separator that its own header line shows."""
    top = spark.read.text(path).limit(1).select(separator_of(F.col("value")).alias("sep"), "value").first()
    if top is None:
        raise ValueError(f"{path} has no header line")
    if top["sep"] is None:
        raise ValueError(f"the header of {path} holds no known separator of {landing.SEPARATORS}: {top['value'][:80]!r}")
    return read_text_table(spark, path, top["sep"])


def scan_building_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables present below ``root``, by short name; absent optional ones are left out."""
    found = {}
    for alias, table in BUILDING_TABLES.items():
        path = f"{root.rstrip('/')}/{table}.csv"
        if path_exists(spark, path):
            found[alias] = scan_with_dialect(spark, path)
    require_building_tables(found)
    return found


def require_building_tables(tables: dict[str, DataFrame]) -> None:
    missing = [BUILDING_TABLES[a] for a in MANDATORY_TABLES if a not in tables]
    if missing:
        raise FileNotFoundError(f"mandatory building tables absent: {', '.join(missing)}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
