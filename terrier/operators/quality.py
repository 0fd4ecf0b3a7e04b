"""Blocking checks before export. One pass over each table, all departments at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.territories import BOX_COLUMNS, METROPOLE_BOX, territories
from terrier.session import materialize

# Levels, verdicts and thresholds of the published checks.
OK, WARN, FAIL = "ok", "avertissement", "echec"
PASSED, BLOCKED = "publiable", "bloque"
SALES_SOURCE = "dvf"
MAX_VOLUME_DROP = 0.20
MAX_OUT_OF_BOUNDS = 0.01

#: So many failures are listed in a refusal; it tells how many there are.
LISTED_FAILURES = 50
FINDING = ["niveau", "controle", "source", "dept", "message", "detail"]


def _label() -> Column:
    return F.concat_ws("/", "source", "dept")


def _detail(**values: Column) -> Column:
    pairs = [item for k, v in values.items() for item in (F.lit(k), v.cast("string"))]
    return F.create_map(*pairs)


def _no_detail() -> Column:
    return F.lit(None).cast("map<string,string>")


def measure(table: DataFrame, source: str, dept: str = "dept") -> DataFrame:
    """Rows, located rows, rows outside the territory and observed extent per department.

    A table without coordinates yields NULL for everything but the rows. A point whose longitude
    is missing counts as inside when its latitude fits, as three-valued logic has it.
    """
    rows = F.count(F.lit(1)).alias("rows")
    key = F.col(dept).alias("dept")
    if not {"latitude", "longitude"} <= set(table.columns):
        stats = table.groupBy(key).agg(rows)
        nothing = {"located": "long", "outside": "long"} | {f"{a}_{m}": "double" for a in ("lat", "lon") for m in ("low", "high")}
        stats = stats.select("*", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    else:
        boxes = F.broadcast(territories(table.sparkSession).select(F.col("dept").alias("_box_dept"), *BOX_COLUMNS))
        bounded = table.join(boxes, F.col(dept) == F.col("_box_dept"), "left")
        box = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in zip(BOX_COLUMNS, METROPOLE_BOX)}
        lat, lon = F.col("latitude"), F.col("longitude")
        out = ~lat.between(box["lat_min"], box["lat_max"]) | ~lon.between(box["lon_min"], box["lon_max"])
        stats = bounded.groupBy(key).agg(
            rows,
            F.count("latitude").alias("located"),
            F.count_if(lat.isNotNull() & out).alias("outside"),
            F.min("latitude").alias("lat_low"),
            F.max("latitude").alias("lat_high"),
            F.min("longitude").alias("lon_low"),
            F.max("longitude").alias("lon_high"),
        )
    return stats.withColumn("source", F.lit(source))


def with_expected(stats: DataFrame, expected: DataFrame | None) -> DataFrame:
    """Adds a zero-row entry for each expected (source, dept) that produced nothing."""
    if expected is None:
        return stats
    return expected.select("source", "dept").join(stats, ["source", "dept"], "full_outer").fillna(0, ["rows"])


def volume_findings(stats: DataFrame) -> DataFrame:
    """No row is a failure, except for sales where the register does not exist."""
    known = territories(stats.sparkSession).filter("sales_uncovered").select("dept", "sales_uncovered")
    flagged = stats.join(F.broadcast(known), "dept", "left")
    excused = (F.col("source") == SALES_SOURCE) & F.coalesce("sales_uncovered", F.lit(False))
    level = F.when((F.col("rows") > 0) | excused, OK).otherwise(FAIL)
    message = (
        F.when(F.col("rows") > 0, F.concat(_label(), F.lit(" : "), F.col("rows"), F.lit(" lignes")))
        .when(excused, F.concat(_label(), F.lit(" : vide, hors couverture")))
        .otherwise(F.concat(_label(), F.lit(" : aucune ligne")))
    )
    return flagged.select(
        level.alias("niveau"), F.lit("volume").alias("controle"), "source", "dept", message.alias("message"), _no_detail().alias("detail")
    )


def bounds_findings(stats: DataFrame) -> DataFrame:
    """A few stray points are typing errors of the source; many are a failed reprojection."""
    boxes = F.broadcast(territories(stats.sparkSession).select("dept", *BOX_COLUMNS))
    checked = stats.filter((F.col("rows") > 0) & F.col("located").isNotNull()).join(boxes, "dept", "left")
    checked = checked.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in zip(BOX_COLUMNS, METROPOLE_BOX)})
    part = F.col("outside") / F.when(F.col("located") > 0, F.col("located"))
    level = (
        F.when(F.col("located") == 0, WARN)
        .when(F.col("outside") == 0, OK)
        .when(part < MAX_OUT_OF_BOUNDS, WARN)
        .otherwise(FAIL)
    )
    message = F.when(F.col("located") == 0, F.concat(_label(), F.lit(" : aucun point localise"))).otherwise(
        F.concat(_label(), F.lit(" : "), F.col("outside"), F.lit(" point(s) hors emprise sur "), F.col("located"))
    )
    detail = _detail(
        hors_emprise=F.col("outside"),
        localises=F.col("located"),
        lat_min=F.col("lat_low"),
        lat_max=F.col("lat_high"),
        lon_min=F.col("lon_low"),
        lon_max=F.col("lon_high"),
        part_hors_emprise=F.round(part, 6),
        emprise_attendue=F.concat_ws(", ", *[F.col(c).cast("string") for c in BOX_COLUMNS]),
    )
    return checked.select(
        level.alias("niveau"), F.lit("emprise").alias("controle"), "source", "dept", message.alias("message"), detail.alias("detail")
    )


def regression_findings(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """Compares with the rows of the previous vintage (source, dept, lignes)."""
    # Only departments the baseline knows are compared; it knows one with no or zero rows too.
    known = baseline.select("source", "dept", F.col("lignes").alias("_previous"))
    compared = stats.filter(F.col("rows") > 0).join(known, ["source", "dept"], "inner")
    previous = F.when(F.col("_previous") != 0, F.col("_previous"))
    change = (F.col("rows") - previous) / previous
    level = F.when(previous.isNull(), OK).when(change < -MAX_VOLUME_DROP, FAIL).when(change < 0, WARN).otherwise(OK)
    message = F.when(previous.isNull(), F.concat(_label(), F.lit(" : rien a comparer"))).otherwise(
        F.concat(_label(), F.lit(" : "), F.format_string("%+.1f", change * 100), F.lit(" %"))
    )
    detail = _detail(precedent=F.col("_previous"), actuel=F.col("rows"), variation=F.round(change * 100, 1))
    return compared.select(
        level.alias("niveau"), F.lit("regression").alias("controle"), "source", "dept", message.alias("message"), detail.alias("detail")
    )


def missing(expected: DataFrame, produced: DataFrame, on: list[str]) -> DataFrame:
    """Expected entries that were not produced."""
    return expected.join(produced.select(*on).distinct(), on, "left_anti")


def presence_findings(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """A source, or a department of one, that was asked for and is not there at all.

    Even where a register covers nothing an empty department must have been produced; only its
    having no rows is excused, by the volume check.
    """
    whole = missing(expected.filter("dept IS NULL").select("source").distinct(), produced, ["source"])
    parts = missing(expected.filter("dept IS NOT NULL").select("source", "dept").distinct(), produced, ["source", "dept"])
    absent = parts.unionByName(whole.withColumn("dept", F.lit(None).cast("string")))
    message = F.concat(_label(), F.lit(" : aucune donnee produite, alors que la source etait demandee"))
    return absent.select(
        F.lit(FAIL).alias("niveau"),
        F.lit("presence").alias("controle"),
        "source",
        "dept",
        message.alias("message"),
        _no_detail().alias("detail"),
    )


def check(
    tables: dict[str, DataFrame],
    expected: DataFrame | None = None,
    baseline: DataFrame | None = None,
    dept: str = "dept",
    covered: DataFrame | None = None,
) -> DataFrame:
    """All findings on the prepared tables (source name to table).

    ``expected`` holds the (source, dept) pairs that must be there; a NULL dept only requires
    the source to have produced something. ``covered`` holds the pairs that runs have covered, with or
    without rows: such a pair is there, and whether it may be empty is for the volume check to say.
    """
    if not tables and covered is None:
        raise ValueError("no dataset to verify")
    # A row per source and department, read by up to four checks: computed once.
    measured = [measure(t, name, dept) for name, t in tables.items()] or [measure(covered.limit(0), "", "dept")]
    stats = materialize(reduce(DataFrame.unionByName, measured), "quality-statistics")
    asked = [x.filter("dept IS NOT NULL").select("source", "dept") for x in (expected, covered) if x is not None]
    filled = with_expected(stats, reduce(DataFrame.union, asked).distinct() if asked else None)
    findings = [volume_findings(filled), bounds_findings(stats)]
    if baseline is not None:
        findings.append(regression_findings(stats, baseline))
    if expected is not None:
        there = stats.select("source", "dept")
        findings.append(presence_findings(expected, there if covered is None else there.union(covered.select("source", "dept"))))
    return reduce(DataFrame.unionByName, findings)


def verdict(findings: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts per level and whether the export may go ahead."""
    return (
        findings.groupBy(*(by or []))
        .agg(
            F.count_if(F.col("niveau") == OK).alias("n_ok"),
            F.count_if(F.col("niveau") == WARN).alias("n_avertissements"),
            F.count_if(F.col("niveau") == FAIL).alias("n_echecs"),
        )
        .withColumn("verdict", F.when(F.col("n_echecs") > 0, BLOCKED).otherwise(PASSED))
    )


def require_publishable(findings: DataFrame) -> None:
    """Raises with the first failures; findings number a few per department, not per row."""
    n, failed = findings.agg(F.count(F.lit(1)), F.count_if(F.col("niveau") == FAIL)).first()
    if failed:
        failures = findings.filter(F.col("niveau") == FAIL).select("controle", "message").orderBy("controle", "message")
        listing = "; ".join(f"{f['controle']}: {f['message']}" for f in failures.limit(LISTED_FAILURES).collect())
        raise ValueError(f"export refused, {failed} blocking check(s), the first {min(failed, LISTED_FAILURES)}: {listing}")
    if not n:
        raise ValueError("no dataset to verify")
