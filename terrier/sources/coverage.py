"""Which departments a prepared table covers: a record of every run, departments without a row included.

A folder per department can't say that a department was prepared and found empty, nor that it was never asked for. So
each run adds to the table's record what it covered and how many rows it wrote. Resuming, the presence check and
the removal of departments that ran empty read the record; the table itself is the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.functions.territories import parse_selector
from terrier.sources import ledger
from terrier.sources.tables import PARTITION

#: Below the table, hidden from its readers.
RECORD = "_coverage"
#: Runs after which the record is summed up.
RUNS_KEPT = 16
#: The folder of the rows without a department.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

SCHEMA = T.StructType(
    [
        T.StructField("dept", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("run", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Scope:
    """The departments of a run: those of ``only`` (all if None) without those of ``done``; None stands for no department."""

    only: tuple[str, ...] | None = None
    done: tuple[str | None, ...] = field(default=())

    def holds(self, dept: Column) -> Column:
        """Whether a department is in the scope, never NULL."""
        inside = F.lit(True) if self.only is None else F.coalesce(dept.isin(*self.only), F.lit(False))
        named = [d for d in self.done if d is not None]
        if named:
            inside = inside & ~F.coalesce(dept.isin(*named), F.lit(False))
        return inside & dept.isNotNull() if None in self.done else inside

    def __contains__(self, dept: str | None) -> bool:
        return (self.only is None or dept in self.only) and dept not in self.done

    @property
    def empty(self) -> bool:
        return self.only is not None and not any(d in self for d in self.only)


def covered(spark: SparkSession, table: str) -> DataFrame:
    """``dept, rows, run`` of the last run over each department; a row per department, empty if nothing is on record."""
    root = f"{table}/{RECORD}"
    entries = ledger.read(spark, root, SCHEMA, *ledger.state(spark, root))
    last = entries.groupBy("dept").agg(F.max_by(F.struct("rows", "run"), "run").alias("last"))
    return last.select("dept", "last.rows", "last.run")


def covered_departments(spark: SparkSession, table: str) -> dict[str | None, int]:
    return {r["dept"]: r["rows"] for r in covered(spark, table).collect()}


def add_run(spark: SparkSession, table: str, rows: dict[str | None, int]) -> None:
    """Adds a run with its departments and their rows, and sums the record up from time to time."""
    root = f"{table}/{RECORD}"
    checkpoint, entries = ledger.state(spark, root)
    run = max([checkpoint or 0, *entries]) + 1
    ledger.write(spark.createDataFrame([(d, n, run) for d, n in rows.items()], SCHEMA), root, run)
    if len(entries) + 1 >= RUNS_KEPT:
        # Fetched first: a plan can't read what it replaces.
        summed = spark.createDataFrame(covered(spark, table).collect(), SCHEMA)
        ledger.write(summed, root, run, ledger.CHECKPOINT)
        ledger.trim(spark, root)


def scope(spark: SparkSession, table: str, departments: str | list[str] | None, force: bool) -> Scope:
    """What a run is to prepare: all it was asked for, or, unforced, what no run has covered yet."""
    codes = parse_selector(departments) if not isinstance(departments, list) else departments
    if codes is not None and not codes:
        raise ValueError("an empty list of departments selects nothing")
    done = () if force else tuple(covered_departments(spark, table))
    return Scope(None if codes is None else tuple(codes), done)


def departments_of(df: DataFrame, dept: str) -> set[str | None]:
    """The departments a table names; a handful by definition."""
    return {r[0] for r in df.select(dept).distinct().collect()}


def folder(dept: str | None) -> str:
    return f"{PARTITION}={NULL_FOLDER if dept is None else dept}"


def department_of(name: str) -> str | None:
    """The department whose rows a folder holds."""
    return None if name == folder(None) else name.partition("=")[2]


def department_folders(spark: SparkSession, table: str) -> list[str]:
    return [name for name in ledger.folders(spark, table) if name.startswith(f"{PARTITION}=")]


def close_run(spark: SparkSession, table: str, within: Scope, written: dict[str | None, int], found: set[str | None]) -> dict[str | None, int]:
    """Removes the departments of the scope that ran empty, and records the run; returns what it covered.

    ``written`` are the departments written and their rows, ``found`` those the input named. Departments asked for by name,
    named by the input or on record from before are covered too, with no row. Rows of such a department are
    removed before the record is added to; a run that dies in between is run again.
    """
    before = {d for d in covered_departments(spark, table) if d in within}
    there = {department_of(name) for name in department_folders(spark, table)}
    asked = {d for d in (within.only or ()) if d in within}
    covers = {d for d in {*before, *found, *there} if d in within} | asked | set(written)
    for dept in covers & there - set(written):
        ledger.remove(spark, f"{table}/{folder(dept)}")
    rows = {d: written.get(d, 0) for d in covers}
    add_run(spark, table, rows)
    return rows
