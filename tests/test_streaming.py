import json
import random

import pytest
from pyspark.sql import functions as F

from terrier.sources import ledger
from terrier.sources.delimited import DIAGNOSTIC_COLUMNS
from terrier.streaming import upsert
from terrier.streaming.pages import ingest_pages, read_pages
from terrier.streaming.upsert import apply_batch, current_rows, stream_upsert


def page(root, n, rows):
    root.mkdir(exist_ok=True)
    (root / f"page{n}.json").write_text("\n".join(json.dumps(r) for r in rows))


def test_pages_are_taken_once(spark, tmp_path):
    landing, staging, marks = tmp_path / "pages", str(tmp_path / "staging"), str(tmp_path / "marks")
    for n in range(4):
        page(landing, n, [{"numero_dpe": f"D{n}", "score_ban": 0.5, "annee_construction": 1975, "ignored": 1}])
    assert ingest_pages(read_pages(spark, str(landing)), staging, marks).count() == 4
    page(landing, 4, [{"numero_dpe": "D4"}])
    rows = ingest_pages(read_pages(spark, str(landing)), staging, marks)
    assert rows.columns == DIAGNOSTIC_COLUMNS and set(dict(rows.dtypes).values()) == {"string"}
    got = {r["numero_dpe"]: r["score_ban"] for r in rows.collect()}
    assert got == {"D0": "0.5", "D1": "0.5", "D2": "0.5", "D3": "0.5", "D4": None}


def test_records_landed_again_are_added_once(spark, tmp_path):
    landing, staging, marks = tmp_path / "pages", str(tmp_path / "staging"), str(tmp_path / "marks")
    first = [{"numero_dpe": f"D{i}", "score_ban": 0.5} for i in range(20)] + [{"numero_dpe": ""}, {"score_ban": 1}]
    page(landing, 0, first + first[:3])

    def run():
        rows = ingest_pages(read_pages(spark, str(landing)), staging, marks, once=True).collect()
        return sorted(((r["numero_dpe"], r["score_ban"]) for r in rows), key=repr)

    want = [(f"D{i}", "0.5") for i in range(20)] + [("", None), (None, "1")]
    assert run() == sorted(want, key=repr)
    page(landing, 1, first[5:])  # the same records under another name, in a later run
    page(landing, 2, [{"numero_dpe": "D0", "score_ban": 0.25}, {"numero_dpe": None}, {"numero_dpe": None}])
    want += [("D0", "0.25"), (None, None)]
    assert run() == sorted(want, key=repr)
    assert run() == sorted(want, key=repr)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "none").endswith(("none", "HDFSBackedStateStoreProvider"))


SCHEMA = "cle_vente string, dept string, v int"


def state(spark, root, schema):
    return {r["cle_vente"]: (r["dept"], r["v"]) for r in current_rows(spark, root, schema).collect()}


def test_batches_merge_by_key(spark, tmp_path):
    root = str(tmp_path / "table")
    newest = [F.col("v").desc()]
    first = spark.createDataFrame([("a", "33", 1), ("a", "33", 2), ("b", "33", 1), ("c", "48", 1), ("d", "75", 1)], SCHEMA)
    apply_batch(first, 0, root, "cle_vente", newest)
    assert state(spark, root, first.schema) == {"a": ("33", 2), "b": ("33", 1), "c": ("48", 1), "d": ("75", 1)}
    second = spark.createDataFrame([("b", "33", 5), ("e", "2A", 1), ("c", "33", 7)], SCHEMA)
    for _ in range(2):  # a batch that runs twice changes nothing the second time
        apply_batch(second, 1, root, "cle_vente", newest)
        # c moved to another department, which emptied its former one
        assert state(spark, root, first.schema) == {"a": ("33", 2), "b": ("33", 5), "c": ("33", 7), "d": ("75", 1), "e": ("2A", 1)}
    touched = {p.name for p in (tmp_path / "table" / "version=1").glob("dept=*")}
    assert touched == {"dept=33", "dept=2A"}
    # A version without a log entry (its batch died) is not seen.
    first.filter("dept = '75'").withColumn("v", F.lit(99)).write.partitionBy("dept").parquet(f"{root}/version=2")
    assert state(spark, root, first.schema)["d"] == ("75", 1)


def test_stream_resumes(spark, tmp_path):
    landing, root, marks = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "marks")
    landing.mkdir()

    def run():
        changes = spark.readStream.schema(SCHEMA).json(str(landing))
        return {r["cle_vente"]: r["v"] for r in stream_upsert(changes, root, marks, "cle_vente", [F.col("v").desc()]).collect()}

    page(landing, 0, [{"cle_vente": "a", "dept": "33", "v": 1}, {"cle_vente": "b", "dept": "48", "v": 1}])
    assert run() == {"a": 1, "b": 1}
    page(landing, 1, [{"cle_vente": "a", "dept": "33", "v": 2}])
    assert run() == {"a": 2, "b": 1}
    assert run() == {"a": 2, "b": 1}


def test_rows_without_key_or_department_stay(spark, tmp_path):
    root, newest = str(tmp_path / "table"), [F.col("v").desc()]
    first = spark.createDataFrame([(None, "33", 1), (None, "33", 2), ("a", None, 1), ("b", "33", 1)], SCHEMA)
    apply_batch(first, 0, root, "cle_vente", newest)
    second = spark.createDataFrame([("a", None, 2), (None, None, 3)], SCHEMA)
    apply_batch(second, 1, root, "cle_vente", newest)
    got = sorted(((r["cle_vente"], r["dept"], r["v"]) for r in current_rows(spark, root, first.schema).collect()), key=repr)
    assert got == sorted([(None, "33", 1), (None, "33", 2), ("a", None, 2), ("b", "33", 1), (None, None, 3)], key=repr)


def plain_upsert(batches):
    """The table after the batches: the last row of each key, and all rows without one."""
    keyed, loose = {}, []
    for rows in batches:
        best = {}
        for k, d, v in rows:
            if k is None:
                loose.append((k, d, v))
            elif k not in best or v > best[k][2]:
                best[k] = (k, d, v)
        keyed |= best
    return sorted([*keyed.values(), *loose], key=repr)


def random_batches(n, seed):
    rng = random.Random(seed)
    depts = ["01", "2A", "33", "974", None]
    for i in range(n):
        rows = [(rng.choice([f"k{rng.randrange(40)}", f"n{i}", None]), rng.choice(depts), 100 * i + j) for j in range(rng.randrange(0, 6))]
        yield [(k, d, v) for k, d, v in rows if not (k is None and v % 7)]


def contents(df):
    return sorted((tuple(r) for r in df.select("cle_vente", "dept", "v").collect()), key=repr)


def size_of(root):
    files = [p for p in root.rglob("*.parquet")]
    return len(files), len(list((root / "_log").iterdir()))


def test_many_batches_leave_few_files(spark, tmp_path):
    root, batches = tmp_path / "table", list(random_batches(50, 4))
    sizes = []
    for n, rows in enumerate(batches):
        apply_batch(spark.createDataFrame(rows, SCHEMA), n, str(root), "cle_vente", [F.col("v").desc()], compact_every=5)
        sizes.append(size_of(root))
        if n % 12 == 3:
            assert contents(current_rows(spark, str(root), spark.createDataFrame([], SCHEMA).schema)) == plain_upsert(batches[: n + 1])
    now = current_rows(spark, str(root), spark.createDataFrame([], SCHEMA).schema)
    assert contents(now) == plain_upsert(batches)
    # Five departments, a checkpoint, and at most four versions on top of it.
    assert max(files for files, _ in sizes) <= 5 * 5 + 5 * 5 and max(entries for _, entries in sizes) <= 6
    assert sizes[-1][0] <= sizes[9][0] + 15


def test_departments_without_changes_keep_their_folder(spark, tmp_path):
    root = str(tmp_path / "table")
    first = spark.createDataFrame([("a", "33", 1), ("b", "48", 1), ("c", "75", 1)], SCHEMA)
    apply_batch(first, 0, root, "cle_vente", [F.col("v").desc()], compact_every=1)
    # b moves to 33, so 48 is rewritten (to nothing), and 75 stays as it is.
    apply_batch(spark.createDataFrame([("b", "33", 2)], SCHEMA), 1, root, "cle_vente", [F.col("v").desc()], compact_every=1)
    assert upsert.state(spark, root).bases == {"33": 1, "75": 0}
    assert state(spark, root, first.schema) == {"a": ("33", 1), "b": ("33", 2), "c": ("75", 1)}
    assert {p.name for p in (tmp_path / "table").glob("base=0/*")} >= {"dept=75"}
    assert not (tmp_path / "table" / "base=0" / "dept=48").exists() and not (tmp_path / "table" / "version=0").exists()


@pytest.mark.parametrize("step", ["write base", "write checkpoint", "trim log", "remove rows"])
def test_a_kill_between_the_steps_loses_nothing(spark, tmp_path, monkeypatch, step):
    root, batches = str(tmp_path / "table"), list(random_batches(7, 9))
    schema = spark.createDataFrame([], SCHEMA).schema

    class Killed(Exception):
        pass

    def die(*_):
        raise Killed

    def apply(n, every):
        apply_batch(spark.createDataFrame(batches[n], SCHEMA), n, root, "cle_vente", [F.col("v").desc()], compact_every=every)

    for n in range(4):
        apply(n, 3)
    written = ledger.write

    def write(df, where, n, kind=ledger.ENTRY):
        return die() if kind == ledger.CHECKPOINT else written(df, where, n, kind)

    with monkeypatch.context() as patch:
        if step == "write base":
            patch.setattr(upsert, "rows_of", die)
        elif step == "write checkpoint":
            patch.setattr(ledger, "write", write)
        elif step == "trim log":
            patch.setattr(ledger, "trim", die)
        else:
            patch.setattr(upsert, "leased", die)
        with pytest.raises(Killed):
            apply(4, 2)
    assert contents(current_rows(spark, root, schema)) == plain_upsert(batches[:5])
    apply(4, 2)  # the stream runs the batch again
    assert contents(current_rows(spark, root, schema)) == plain_upsert(batches[:5])
    for n in (5, 6):
        apply(n, 2)
    assert contents(current_rows(spark, root, schema)) == plain_upsert(batches)


def test_snapshot_outlives_batches(spark, tmp_path):
    root, batches = str(tmp_path / "table"), list(random_batches(12, 2))
    schema = spark.createDataFrame([], SCHEMA).schema

    def apply(n):
        apply_batch(spark.createDataFrame(batches[n], SCHEMA), n, root, "cle_vente", [F.col("v").desc()], compact_every=2)

    for n in range(5):
        apply(n)
    with upsert.snapshot(spark, root, schema) as rows:
        for n in range(5, 12):
            apply(n)
        assert contents(rows) == plain_upsert(batches[:5])
        assert contents(current_rows(spark, root, schema)) == plain_upsert(batches)
    before = size_of(tmp_path / "table")
    upsert.vacuum(spark, root)
    assert size_of(tmp_path / "table") < before and not upsert.leased(spark, root)
    assert contents(current_rows(spark, root, schema)) == plain_upsert(batches)


def test_abandoned_leases_end(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", "33", 1)], SCHEMA)
    apply_batch(rows, 0, root, "cle_vente", [F.col("v").desc()])
    monkeypatch.setattr(upsert, "LEASE_SECONDS", -1)
    with upsert.snapshot(spark, root, rows.schema):
        upsert.compact(spark, root, rows.schema)
        upsert.vacuum(spark, root)
    assert not (tmp_path / "table" / "version=0").exists() and not list((tmp_path / "table" / "_leases").glob("*"))
    assert state(spark, root, rows.schema) == {"a": ("33", 1)}
