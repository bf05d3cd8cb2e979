"""Headline-query bench.

Runs the registered headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced with the ``noop`` sink (full execution, nothing
collected) and timed wall-clock, including the scalar jobs it needs
(quantiles, week range). The first query also pays JVM warm-up; a tiny
warm-up query runs first so that the numbers compare between revisions.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sales_detail",
    "clean_sales",
    "daily_dataset",
    "warm_plan",
    "curve_smooth",
    "product_mix",
    "blend",
    "route_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import SparkSession

    from cratecast.registry import QUERIES
    from cratecast.session import tune

    scratch = tempfile.mkdtemp(prefix="cratecast-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cratecast-bench")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)

    # warm-up: JVM, codegen caches, Parquet footers
    QUERIES["unit_litres"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float | None] = {}
    for k in HEADLINE:
        t0 = time.time()
        try:
            df = QUERIES[k](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times[k] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - keep the JSON line; report the failure on stderr
            print(f"bench: {k} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            times[k] = None
    spark.stop()
    total = round(sum(v for v in times.values() if v is not None), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
