"""End-to-end jobs: raw files in, partitioned tables and their reports out.

Each job handles every department at once; Spark's partitions take the place of a loop over
departments.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.functions.territories import require_known_territories, select_departments
from terrier.operators import reports
from terrier.operators.buildings import prepare_building_rows
from terrier.operators.changes import changed_sources, remember
from terrier.operators.diagnostics import prepare_diagnostic_rows
from terrier.operators.joint import enrich_sales
from terrier.operators.quality import check, require_publishable
from terrier.operators.ranking import largest_group
from terrier.operators.sales import add_price_flag, add_sale_key, collapse, market_sales, typed_lines
from terrier.operators.sources import prefer_later_sources, sale_match_key
from terrier.plans import export
from terrier.session import in_pieces, materialize, materialize_pieces, scratch_scope
from terrier.sources import coverage, delimited, ledger
from terrier.sources.coverage import Scope
from terrier.sources.tables import PARTITION, datasets, manifest_baseline, read_table, read_table_or_none


# Lines that are shuffled at a time, and how often staged lines may be read for that. The bound keeps
# the reading linear in the lines; beyond it pieces grow.
PIECE_LINES = 12_000_000
MOST_PIECES = 4


def pieces_of(lines: DataFrame) -> int:
    """Into how many pieces a staged table of lines is cut."""
    return max(1, min(MOST_PIECES, -(-lines.count() // PIECE_LINES)))


def effective_lines(sources: list[DataFrame], only: Column | None = None, pieces: int | None = None) -> DataFrame:
    """Lines left once later sources have taken precedence, tagged with their source."""
    return prefer_later_sources(sources, sale_match_key(), tag=delimited.PRIORITY, only=only, pieces=pieces)


def sales_from_lines(lines: DataFrame, largest: int | None = None, pieces: int | None = None) -> DataFrame:
    """Raw text lines to the published sale table.

    Identifiers of different sources are different sequences, so lines of two sources never
    merge into one sale. ``largest`` bounds the number of sales that share a fingerprint and
    picks the way they are ranked. Where the caller knows no bound, the collapsed sales (a
    quarter of the lines) are written down once and counted on that one column. With ``pieces`` they are
    written in any case, as many pieces one after the other, and the lines are not read any more after that.
    """
    keep = [delimited.PRIORITY] if delimited.PRIORITY in lines.columns else []
    by = [*keep, "id_mutation"]
    typed = typed_lines(market_sales(lines), keep)
    if pieces is not None:
        cut = in_pieces(typed, F.xxhash64(*by), pieces)
        sales = materialize_pieces([collapse(piece, by) for piece in cut], "collapsed-sales")
    else:
        sales = collapse(typed, by)
    if largest is None:
        sales = sales if pieces is not None else materialize(sales, "collapsed-sales")
        largest = largest_group(sales, ["_fingerprint"])
    return add_price_flag(add_sale_key(sales, largest=largest))


def selected(table: DataFrame, departments: str | list[str] | None) -> DataFrame:
    """Rows of a finished table that lie in the requested departments.

    Applied after a collapse, a ranking or a mark, never before: those look at all departments, so
    a row is the same whichever departments a run asks for.
    """
    return select_departments(table, departments, "code_departement")


def fetched(report: DataFrame) -> DataFrame:
    """A report (a row per department at most) that no longer depends on scratch tables."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def nothing_new(within: Scope, found: set[str | None]) -> bool:
    """Whether an unforced run has no department left: none the input names, and none it was asked for."""
    return not any(d in within for d in found | set(within.only or ()))


def prepare_sales(
    spark: SparkSession,
    sources: list[list[str]],
    out: str,
    departments: str | list[str] | None = None,
    mode: str = "replace",
    force: bool = True,
) -> DataFrame:
    """Landed sale files (one list of paths per source, archive first) to the sale table.

    Text is parsed once: each source is staged as Parquet, and collapse and report read that. Only
    the departments of the run are rewritten, and those of them that have no sale any more are emptied;
    ``mode="overwrite"`` starts the table afresh. Without ``force`` departments that a run has covered stay as
    they are, whichever departments the lines name; if there is no other, only their names are read.
    """
    within = coverage.scope(spark, out, departments, force)
    scans = delimited.scan_sale_lines(spark, sources)
    if within.done:
        with delimited.refusal_with_evidence(spark, [path for paths in sources for path in paths]):
            named = {d for scan in scans for d in coverage.departments_of(scan, "code_departement")}
        if within.empty or nothing_new(within, named):
            return reports.sales_report(read_table(spark, out))
    with scratch_scope(spark):
        with delimited.refusal_with_evidence(spark, [path for paths in sources for path in paths]):
            staged = [materialize(s, "landed-lines") for s in scans]
        lines = materialize(effective_lines(staged), "sale-lines")
        found = coverage.departments_of(lines, "code_departement")
        sales = sales_from_lines(lines).filter(within.holds(F.col("code_departement")))
        table = export.write_run(sales, out, within, found, mode=mode)
        report = reports.sales_report(table, lines)
        return fetched(report.filter(within.holds(F.col("code_departement"))))


def prepare_diagnostics(
    spark: SparkSession,
    pages: list[str] | DataFrame,
    out: str,
    departments: str | list[str] | None = None,
    scope: str | None = None,
    mode: str = "replace",
    force: bool = True,
) -> DataFrame:
    """Landed diagnostic pages (paths, or a table of the 21 text columns) to the diagnostic table.

    Pages in text form are staged as Parquet first; the guards then read one column of it, and
    nothing is computed before they pass. A diagnostic may be cited from any department, so all
    pages count for the mark even if the run asks for some departments. ``force`` as for sales.
    """
    within = coverage.scope(spark, out, departments, force)
    key = "code_departement_ban"
    with scratch_scope(spark):
        if isinstance(pages, DataFrame):
            raw = delimited.align_labels(pages)
        else:
            with delimited.refusal_with_evidence(spark, pages):
                raw = materialize(delimited.scan_diagnostics(spark, pages), "diagnostic-pages")
        found = coverage.departments_of(raw, key)
        if within.done and (within.empty or nothing_new(within, found)):
            return reports.diagnostics_report(read_table(spark, out))
        wanted = raw.filter(within.holds(F.col(key)))
        if not any(d in within for d in found):
            raise ValueError("no diagnostic to prepare")
        require_known_territories(wanted.filter(F.col(key).isNotNull()), key)
        rows = prepare_diagnostic_rows(raw, scope).filter(within.holds(F.col("code_departement")))
        table = export.write_run(rows, out, within, found, mode=mode)
        read = wanted.groupBy(F.col(key).alias("code_departement")).agg(F.count(F.lit(1)).alias("lignes_source"))
        report = reports.diagnostics_report(table.filter(within.holds(F.col("code_departement"))))
        same = F.col("code_departement").eqNullSafe(F.col("_read"))
        report = report.join(read.withColumnRenamed("code_departement", "_read"), same, "left").drop("_read")
        return fetched(report)


def prepare_buildings(
    spark: SparkSession,
    root: str,
    out: str,
    departments: str | list[str] | None = None,
    srid: int | None = None,
    mode: str = "replace",
    force: bool = True,
) -> tuple[DataFrame, list[str]]:
    """Building tables below ``root`` to the building table; also names the absent tables. ``force`` as for sales."""
    within = coverage.scope(spark, out, departments, force)
    with scratch_scope(spark):
        tables = delimited.scan_building_tables(spark, root)
        absent = sorted(t for a, t in delimited.BUILDING_TABLES.items() if a not in tables)
        found = coverage.departments_of(tables["groupe"], "code_departement_insee")
        if within.done and (within.empty or nothing_new(within, found)):
            return reports.buildings_report(read_table(spark, out)), absent
        tables["groupe"] = tables["groupe"].filter(within.holds(F.col("code_departement_insee")))
        table = export.write_run(prepare_building_rows(tables, srid=srid), out, within, found, mode=mode)
        report = reports.buildings_report(table.filter(within.holds(F.col("code_departement"))))
        return fetched(report), absent


def prepare_joint(
    spark: SparkSession,
    sales: str,
    out: str,
    buildings: str | None = None,
    diagnostics: str | None = None,
    departments: str | list[str] | None = None,
    mode: str = "replace",
    force: bool = True,
) -> tuple[DataFrame, list[str]]:
    """Prepared tables to the joint table; also names the sources it had to do without.

    Departments are those the sales cover, and of the sales only those of the run are read. Without
    buildings it warns: :func:`reports.joint_warning`. ``force`` as for sales.
    """
    known = read_table_or_none(spark, buildings)
    energy = read_table_or_none(spark, diagnostics)
    absent = reports.absent_sources(known, energy)
    within = coverage.scope(spark, out, departments, force)
    sold = read_table(spark, sales)
    found = coverage.departments_of(sold, PARTITION) | set(coverage.covered_departments(spark, sales))
    if within.done and (within.empty or nothing_new(within, found)):
        return reports.joint_report(read_table(spark, out)), absent
    if warning := reports.joint_warning(known):
        warnings.warn(warning, stacklevel=2)
    with scratch_scope(spark):
        joint = enrich_sales(sold.filter(within.holds(F.col(PARTITION))).drop(PARTITION), known, energy)
        table = export.write_run(joint, out, within, found, mode=mode)
        return fetched(reports.joint_report(table.filter(within.holds(F.col("code_departement"))))), absent


def refresh_marks(spark: SparkSession, seen: DataFrame, path: str) -> DataFrame:
    """Compares version marks with those kept at ``path``, keeps the newer ones there, and returns the changes.

    The marks kept are the newest checkpoint of a log: they are written beside the former ones, which go when
    the new ones are there.
    """
    last, _ = ledger.state(spark, path)
    known = ledger.read(spark, path, seen.schema, last, [])
    changed = materialize(changed_sources(seen, known), "changed-sources")
    ledger.write(remember(seen, known), path, 1 if last is None else last + 1, ledger.CHECKPOINT)
    ledger.trim(spark, path)
    return changed


def covered_pairs(spark: SparkSession, out: str, sources: list[str]) -> DataFrame:
    """``source, dept`` of what runs have covered, rows or not."""
    pairs = [(s, d) for s in sources for d in coverage.covered_departments(spark, f"{out}/{s}") if d is not None]
    return spark.createDataFrame(pairs, "source string, dept string")


def verify(
    spark: SparkSession,
    out: str,
    sources: list[str] | None = None,
    expected: DataFrame | None = None,
    manifest_path: str | None = None,
) -> DataFrame:
    """Findings on the tables below ``out``; raises when one of them blocks.

    Without ``sources`` the tables are those that are there; those named must be there.
    """
    named = sources if sources is not None else datasets(spark, out)
    found = {s: read_table_or_none(spark, f"{out}/{s}") for s in named}
    tables = {s: t for s, t in found.items() if t is not None}
    pairs = covered_pairs(spark, out, named)
    if not tables and pairs.isEmpty():
        raise ValueError("no dataset to verify")
    if expected is None:
        expected = spark.createDataFrame([(s, None) for s in named], "source string, dept string")
    baseline = manifest_baseline(spark.read.text(manifest_path, wholetext=True)) if manifest_path else None
    with scratch_scope(spark):
        findings = fetched(check(tables, expected, baseline, covered=pairs))
    require_publishable(findings)
    return findings


def publish(
    spark: SparkSession,
    out: str,
    sources: list[str] | None = None,
    vintage: str = "",
    expected: DataFrame | None = None,
    manifest_path: str | None = None,
    unchecked: bool = False,
) -> DataFrame:
    """Exports what is below ``out`` (all of it, or ``sources``) once it has passed :func:`verify`, and returns the manifest.

    ``unchecked`` is the explicit way round a refusal. A source that was not prepared fails the
    check; where that is overridden it is passed over.
    """
    if not vintage:
        raise ValueError("a publication needs the name of its vintage")
    if not unchecked:
        verify(spark, out, sources, expected, manifest_path)
    named = sources if sources is not None else datasets(spark, out)
    there = [s for s in named if read_table_or_none(spark, f"{out}/{s}") is not None]
    if not there:
        raise ValueError("no dataset to publish")
    return export.publish(spark, out, there, vintage)
