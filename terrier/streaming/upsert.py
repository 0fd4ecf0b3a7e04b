"""Incremental upsert of prepared rows by their stable key.

A batch is written as it comes, ``version=N/dept=XX``, and costs what it holds, whatever the size of the table. An entry
of the log, written last, makes it visible. The rows of the table are those of its base, ``base=N/dept=XX``,
whose key no later version holds, and of every key's last version; rows without a key all stay.

Every few batches the versions are merged into the base. Only departments that versions touched, or that hold a
former row of a key they changed, are rewritten; for the others the new checkpoint of the log names the folder they have.
The checkpoint is the moment of the change: what dies before leaves the table as it was, and may run again.

What neither the table nor an open snapshot names is removed. A snapshot is a lease, a small file that lists the
folders it reads; it is written first and then checked against the log, so that removal sees it in time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.operators.ranking import best_per_group
from terrier.session import materialize, scratch_scope
from terrier.sources import ledger
from terrier.sources.coverage import NULL_FOLDER

VERSION, BASE, DEPT = "version", "base", "dept"
#: Versions after which they are merged into the base.
COMPACT_EVERY = 8
#: Seconds after which a snapshot counts as abandoned.
LEASE_SECONDS = 24 * 3600

#: What a checkpoint holds: the base folder of each department that has rows.
_MAPPING = T.StructType([T.StructField(DEPT, T.StringType()), T.StructField(BASE, T.LongType())])


def _log(root: str) -> str:
    return f"{root}/_log"


def _leases(root: str) -> str:
    return f"{root}/_leases"


def _folder(dept: str | None) -> str:
    return f"{DEPT}={NULL_FOLDER if dept is None else dept}"


@dataclass(frozen=True)
class State:
    """What makes up the table at one moment: base folders by department, and the versions on top of them."""

    checkpoint: int | None
    bases: dict[str | None, int]
    versions: tuple[int, ...]

    def paths(self) -> tuple[list[str], list[str]]:
        """Folders below the root: of the base, and of the versions."""
        return [f"{BASE}={n}/{_folder(d)}" for d, n in self.bases.items()], [f"{VERSION}={n}" for n in self.versions]


def state(spark: SparkSession, root: str, before: int | None = None) -> State:
    """The table as its log tells it now, or without the versions from ``before`` on."""
    checkpoint, versions = ledger.state(spark, _log(root))
    bases = {}
    if checkpoint is not None:
        bases = {r[DEPT]: r[BASE] for r in ledger.read(spark, _log(root), _MAPPING, checkpoint, []).collect()}
    return State(checkpoint, bases, tuple(n for n in versions if before is None or n < before))


def _full(schema: T.StructType, kind: str) -> T.StructType:
    fields = [f for f in schema if f.name not in (kind, DEPT)]
    return T.StructType([*fields, T.StructField(kind, T.LongType()), T.StructField(DEPT, T.StringType())])


def rows_of(spark: SparkSession, root: str, now: State, schema: T.StructType, key: str) -> DataFrame:
    """The rows of the table in a state. Only the versions' rows are ranked; the base is anti-joined with their keys."""
    bases, versions = now.paths()
    names = schema.fieldNames()

    def read(paths: list[str], kind: str) -> DataFrame:
        full = _full(schema, kind)
        if not paths:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])

    base = read(bases, BASE).select(*names)
    # A version whose batch held no row has a folder without files, which reads as nothing.
    later = read(versions, VERSION)
    if not versions:
        return base
    last = best_per_group(later.filter(F.col(key).isNotNull()), [key], [F.col(VERSION).desc()]).select(*names)
    loose = later.filter(F.col(key).isNull()).select(*names)
    changed = later.filter(F.col(key).isNotNull()).select(key).distinct()
    return base.join(changed, key, "left_anti").select(*names).unionByName(last).unionByName(loose)


def current_rows(spark: SparkSession, root: str, schema: T.StructType, key: str = "cle_vente", before: int | None = None) -> DataFrame:
    """The rows of the table as of its last version (or of the last one below ``before``)."""
    return rows_of(spark, root, state(spark, root, before), schema, key)


@contextmanager
def snapshot(spark: SparkSession, root: str, schema: T.StructType, key: str = "cle_vente") -> Iterator[DataFrame]:
    """The table's rows at this moment, which stay readable inside the block whatever batches do meanwhile."""
    while True:
        now = state(spark, root)
        lease = f"{_leases(root)}/{uuid.uuid4().hex}"
        held = json.dumps({"until": time.time() + LEASE_SECONDS, "folders": [p for paths in now.paths() for p in paths]})
        spark.createDataFrame([(held,)], "value string").coalesce(1).write.text(lease)
        if ledger.state(spark, _log(root))[0] == now.checkpoint:
            break
        ledger.remove(spark, lease)  # the table moved on before the lease was there
    try:
        yield rows_of(spark, root, now, schema, key)
    finally:
        ledger.remove(spark, lease)


def leased(spark: SparkSession, root: str) -> set[str]:
    """Folders that open snapshots read."""
    names = [n for n in ledger.folders(spark, _leases(root)) if ledger.exists(spark, f"{_leases(root)}/{n}/_SUCCESS")]
    if not names:
        return set()
    leases = [json.loads(r["value"]) for r in spark.read.text([f"{_leases(root)}/{n}" for n in names]).collect()]
    return {folder for lease in leases if lease["until"] > time.time() for folder in lease["folders"]}


def apply_batch(batch: DataFrame, version: int, root: str, key: str, newest: list[Column], compact_every: int = COMPACT_EVERY) -> None:
    """Adds one batch to the table as ``version``; what it holds for a key replaces what the table held.

    Rows without a key replace nothing and are replaced by nothing: all of them are added. Rows
    without a department are a partition of their own. A version that is part of the table already changes nothing if it
    has been merged into the base, and is written again if it hasn't.
    """
    spark = batch.sparkSession
    now = state(spark, root)
    if now.checkpoint is None or version > now.checkpoint:
        with scratch_scope(spark):
            keyed = best_per_group(batch.filter(F.col(key).isNotNull()), [key], newest)
            # The input of a micro-batch is read twice below; write it down once.
            changes = materialize(keyed.unionByName(batch.filter(F.col(key).isNull())), "upsert-batch")
            _write(changes, f"{root}/{VERSION}={version}")
            ledger.write(spark.createDataFrame([(version,)], f"{VERSION} long"), _log(root), version)
    if len(state(spark, root).versions) >= compact_every:
        compact(spark, root, batch.schema, key)
        vacuum(spark, root)


def _write(rows: DataFrame, path: str) -> None:
    writer = rows.hint("rebalance", DEPT).write.mode("overwrite").partitionBy(DEPT)
    writer.option("compression", "zstd").parquet(path)


def compact(spark: SparkSession, root: str, schema: T.StructType, key: str = "cle_vente") -> None:
    """Merges all versions into the base and makes that the table by a checkpoint of the log."""
    now = state(spark, root)
    if not now.versions:
        return
    last = max(now.versions)
    bases, versions = now.paths()
    with scratch_scope(spark):
        later = spark.read.schema(_full(schema, VERSION)).option("basePath", root).parquet(*[f"{root}/{p}" for p in versions])
        touched = {r[0] for r in later.select(DEPT).distinct().collect()}
        if bases:
            # Departments that hold a former row of a key; two columns of the base are read for it.
            base = spark.read.schema(_full(schema, BASE)).option("basePath", root).parquet(*[f"{root}/{p}" for p in bases])
            former = base.select(key, DEPT).join(later.select(key).distinct(), key, "left_semi")
            touched |= {r[0] for r in former.select(DEPT).distinct().collect()}
        # The others are left out before anything of theirs is read.
        affected = State(now.checkpoint, {d: n for d, n in now.bases.items() if d in touched}, now.versions)
        merged = rows_of(spark, root, affected, schema, key)
        _write(merged, f"{root}/{BASE}={last}")
        written = [n for n in ledger.folders(spark, f"{root}/{BASE}={last}") if n.startswith(f"{DEPT}=")]
        departments = [None if n == _folder(None) else n.partition("=")[2] for n in written]
        mapping = {d: n for d, n in now.bases.items() if d not in touched} | dict.fromkeys(departments, last)
        checkpoint = spark.createDataFrame(list(mapping.items()), _MAPPING)
        ledger.write(checkpoint, _log(root), last, ledger.CHECKPOINT)


def vacuum(spark: SparkSession, root: str) -> None:
    """Removes what neither the table nor an open snapshot reads: log first, then rows.

    A version above the log's last one may be being written, and stays.
    """
    now = state(spark, root)
    if now.checkpoint is None:
        return
    ledger.trim(spark, _log(root))
    # Whoever found the log at a former checkpoint had a lease by then, before this checkpoint was written.
    needed = {p for paths in now.paths() for p in paths} | leased(spark, root)
    for name in ledger.folders(spark, root):
        kind, _, n = name.partition("=")
        if kind == VERSION and int(n) <= now.checkpoint and name not in needed:
            ledger.remove(spark, f"{root}/{name}")
        if kind == BASE and int(n) <= now.checkpoint:
            inside = [f"{name}/{d}" for d in ledger.folders(spark, f"{root}/{name}")]
            for folder in [f for f in inside if f not in needed]:
                ledger.remove(spark, f"{root}/{folder}")
            if not needed & set(inside):
                ledger.remove(spark, f"{root}/{name}")
    for name in ledger.folders(spark, _leases(root)):
        path = f"{_leases(root)}/{name}"
        if ledger.exists(spark, f"{path}/_SUCCESS") and json.loads(spark.read.text(path).first()["value"])["until"] <= time.time():
            ledger.remove(spark, path)


def stream_upsert(
    changes: DataFrame, root: str, checkpoint: str, key: str, newest: list[Column], compact_every: int = COMPACT_EVERY
) -> DataFrame:
    """Runs every landed change through the table and returns its current rows.

    ``newest`` orders the rows of one key within a batch, the one to keep first.
    """
    query = (
        changes.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, root, key, newest, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return current_rows(changes.sparkSession, root, changes.schema, key)
