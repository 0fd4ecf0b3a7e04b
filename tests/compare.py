"""Runs registered queries next to their SQL and reports differences.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


FAMILY = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "varchar": "string", "hugeint": "hugeint"}


def compare(spark, con, name: str, sf: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    wanted = con.execute(sql).fetchall()
    types = {d[0]: d[1].lower() for d in described}
    mine = dict(df.dtypes)
    off = [
        f"{c}: {mine[c]} / {types.get(c)}"
        for c in mine
        if types.get(c) != mine[c] and {types.get(c), mine[c]} not in ({"varchar", "string"}, {"integer", "int"})
    ]
    a, left = rows_of(df.columns, got)
    b, right = rows_of([d[0] for d in described], wanted)
    if a != b:
        return False, f"columns {a} / {b}"
    if left != right:
        mismatch = [(x, y) for x, y in zip(left, right) if x != y][:3]
        return False, f"{len(left)} / {len(right)} rows; {mismatch}"
    return not off, f"{len(left)} rows" + (f"; types {off}" if off else "")


def main() -> None:
    from __spark_entry__ import queries
    from terrier.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = []
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += [] if ok else [name]
        print(f"{'ok  ' if ok else 'FAIL'} {name:28} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
