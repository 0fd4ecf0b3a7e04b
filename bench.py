"""Times the headline queries (median of three runs each; the first one, which compiles, is never the median) and prints one JSON line.

BENCH_SF_DIR   tables to run on (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from statistics import median

from terrier.registry.queries import REGISTERED
from terrier.session import build_session

HEADLINE = [
    "collapse_sales",
    "consolidated_sales",
    "stable_sale_key",
    "median_price_by_commune",
    "prepare_diagnostics",
    "reproject_points",
    "replaced_mark",
    "prepare_buildings",
    "parcel_arbitration",
    "sale_building_join",
    "nearest_diagnostic",
    "sale_enrichment",
    "sales_report",
    "source_precedence",
    "upsert_by_key",
    "quality_bounds",
    "write_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTERED) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="terrier-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        timings[name] = round(median(run(name) for _ in range(3)), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
