"""Summarise the final (AQE) physical plans of the headline queries.

usage: python tools/plan_review.py [sf_dir] > PLAN_REVIEW.md
Runs each query once, then counts the operators of its final adaptive plan
(shuffles, broadcasts, join kinds, windows, sorts) and lists the filters
pushed into each Parquet scan. The stages the plan materialises are tables
read back, so each plan starts at the last materialised stage.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = [
    "ShuffleQueryStage", "BroadcastQueryStage", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
    "ShuffledHashJoin", "Window", "Sort", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "FileScan",
]


def final_plan(plan: str) -> list[str]:
    """Operator names of the final adaptive plan, one per plan line."""
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    ops = []
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-|]*(?:\*\(\d+\)\s*)?([A-Za-z]+)", line)
        if m:
            ops.append(m.group(1))
    return ops


def main() -> None:
    from pyspark.sql import SparkSession

    from bench import HEADLINE
    from cratecast.registry import QUERIES
    from cratecast.session import tune

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cratecast-review-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    print(f"# Plan review ({sf_dir}, local[8], AQE final plans)\n")
    print("| query | " + " | ".join(NODES) + " | skew-split reads |")
    print("| --- |" + " --- |" * (len(NODES) + 1))
    pushed = {}
    for k in HEADLINE:
        df = QUERIES[k](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops = final_plan(plan)
        counts = [sum(1 for o in ops if o == n) for n in NODES]
        skew = len(re.findall(r"skewed", plan, flags=re.I))
        print(f"| {k} | " + " | ".join(str(c) for c in counts) + f" | {skew} |")
        pushed[k] = sorted(set(re.findall(r"PushedFilters: \[([^\n]*?)(?:\]|\.\.\.)", plan)))
    print("\n## Filters pushed into Parquet scans\n")
    for k, fs in pushed.items():
        fs = [f for f in fs if f]
        print(f"* `{k}`: " + ("; ".join(f"[{f}]" for f in fs) if fs else "none (reads materialised stages only)"))
    spark.stop()


if __name__ == "__main__":
    main()
