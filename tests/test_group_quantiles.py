"""Quantiles of many groups at once against NumPy; a hot group; boxes per group."""

import math
import random

import numpy as np
import pytest

from cratecast.operators.quantile import group_quantiles
from cratecast.plans.report import group_box

PROBS, NAMES = [0.0, 0.25, 0.5, 0.95, 1.0], ["a", "b", "c", "d", "e"]


def groups(seed=1):
    rng = random.Random(seed)
    g = {"hot": [rng.lognormvariate(3, 2) for _ in range(4000)], "ties": [1.0, 1.0, 1.0, 5.0, 5.0] * 40, "one": [7.5], "two": [-3.0, 1e-9], None: [float(i) for i in range(17)]}
    g["near"] = [1.0 + i * 2**-52 for i in range(9)]
    g["wide"] = [-1.7e308, -1.0, 0.0, 1.0, 2.0, 1.7e308]
    g["zero"] = [0.0, -0.0, 0.0]
    for i in range(60):
        g[f"s{i}"] = [rng.uniform(-50, 50) for _ in range(rng.randrange(1, 30))]
    return g


@pytest.mark.parametrize("bins", [4, 256])
def test_group_quantiles_equal_numpy(spark, bins):
    g = groups()
    rows = [(k, v) for k, x in g.items() for v in x] + [("hot", None), ("hot", math.nan), ("none", None)]
    got = {r["k"]: [r[n] for n in NAMES] for r in group_quantiles(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", PROBS, NAMES, bins=bins).collect()}
    assert got.keys() == g.keys()
    for k, x in g.items():
        s = sorted(x)
        for p, v in zip(PROBS, got[k]):
            at = p * (len(s) - 1)
            lo = math.floor(at)
            assert v == pytest.approx(s[lo] + (s[min(lo + 1, len(s) - 1)] - s[lo]) * (at - lo), rel=1e-15, abs=0), (k, p)


def test_weights_count_as_repeats(spark):
    rows = [("a", float(i % 13), i % 5) for i in range(200)] + [("b", 2.0, 3), ("b", 9.0, 1), ("b", 100.0, 0)]
    got = {r["k"]: (r["q"], r["m"]) for r in group_quantiles(spark.createDataFrame(rows, "k string, x double, n int"), ["k"], "x", [0.5, 0.9], ["q", "m"], weight="n").collect()}
    for k in "ab":
        x = [v for g, v, n in rows if g == k for _ in range(n)]
        assert got[k] == pytest.approx((np.quantile(x, 0.5), np.quantile(x, 0.9)))


def test_two_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (1, None, 3.0), (None, None, 4.0)], "i int, k string, x double")
    assert sorted(map(str, group_quantiles(df, ["i", "k"], "x", [0.5], ["q"]).collect())) == sorted(["Row(i=1, k='x', q=1.5)", "Row(i=1, k=None, q=3.0)", "Row(i=None, k=None, q=4.0)"])
    assert group_quantiles(df.limit(0), ["k"], "x", [0.5], ["q"]).count() == 0


def test_a_hot_group_is_split(spark):
    """A group with most of the rows: the join of its values with the brackets is dealt to several tasks."""
    rng = random.Random(2)
    rows = [("hot", rng.random()) for _ in range(6000)] + [(f"g{i % 200}", rng.random()) for i in range(4000)]
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        box = group_box(spark.createDataFrame(rows, "k string, x double").repartition(16), ["k"], "x")
        got = {r["k"]: r for r in box.collect()}
        assert "skew=true" in box._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for k in ("hot", "g7"):
        x = np.array([v for g, v in rows if g == k])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[k]
        assert (r["n"], r["n_outliers"]) == (len(x), ((x < lo) | (x > hi)).sum())
        assert [r[c] for c in ("min", "q1", "median", "q3", "max", "fence_lo", "fence_hi")] == pytest.approx([x.min(), q1, q2, q3, x.max(), lo, hi])
