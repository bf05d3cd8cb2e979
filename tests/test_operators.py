"""Hand cases for the reusable operators (FIXTURES.md section 4)."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cratecast.functions.scalar import half_even, threshold_round
from cratecast.operators.quantile import exact_quantile, exact_quantiles
from cratecast.operators.stats import (
    distinct_size,
    first_by,
    group_mode,
    interpolate,
    running_share,
    zscore,
)


def test_zscore_hand_cases(spark):
    rows = [("a", 7.0), ("b", 5.0), ("b", 5.0), ("b", 5.0), ("c", 1.0), ("c", 2.0), ("c", 3.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    out = {(r.k, r.x): r.z for r in zscore(df, "x", ["k"], "z").collect()}
    assert out[("a", 7.0)] == 10.0
    assert out[("b", 5.0)] == 0.0
    assert out[("c", 1.0)] == pytest.approx(-1.0)
    assert out[("c", 2.0)] == pytest.approx(0.0)
    assert out[("c", 3.0)] == pytest.approx(1.0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=2, max_size=30))
def test_zscore_matches_pandas(spark, xs):
    pdf = pd.DataFrame({"k": ["g"] * len(xs), "x": [float(v) for v in xs]})
    s = pdf["x"]
    want = 0.0 if s.std() == 0 else None
    got = sorted(r.z for r in zscore(spark.createDataFrame(pdf), "x", ["k"], "z").collect())
    if want is not None:
        assert all(g == 0.0 for g in got)
    else:
        exp = sorted(((s - s.mean()) / s.std()).tolist())
        assert got == pytest.approx(exp, rel=1e-9, abs=1e-12)


def test_quantile_hand_case(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 4, 10, 7.5, 3.3]], "x double")
    assert exact_quantile(df, "x", 0.95) == pytest.approx(9.375)


@settings(max_examples=20, deadline=None)
@given(
    st.lists(st.integers(min_value=-1000, max_value=1000), min_size=1, max_size=200),
    st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]),
)
def test_quantile_histogram_path_equals_numpy(spark, xs, p):
    df = spark.createDataFrame([(float(v),) for v in xs], "x double")
    got = exact_quantiles(df, "x", [p], bins=4)[0]
    assert got == pytest.approx(float(np.quantile(np.array(xs, dtype=float), p)), rel=1e-12, abs=1e-9)


def test_weighted_quantile_equals_expanded(spark):
    vals = [(1.0, 3), (2.0, 1), (5.0, 4), (9.0, 2)]
    df = spark.createDataFrame(vals, "x double, w long")
    expanded = [v for v, w in vals for _ in range(w)]
    for p in (0.1, 0.5, 0.95):
        assert exact_quantile(df, "x", p, weight="w") == pytest.approx(float(np.quantile(expanded, p)))


def test_mode_tie_takes_smallest_label(spark):
    rows = [("c", 0, v) for v in ["Medio Alto", "Medio Alto", "Alto", "Alto", "Bajo"]]
    df = spark.createDataFrame(rows, "k string, d int, cat string")
    assert group_mode(df, ["k", "d"], "cat").first().cat == "Alto"


def test_distinct_size_null_code(spark):
    df = spark.createDataFrame([("c", "a"), ("c", None), ("c", "a")], "k string, code string")
    assert distinct_size(df, ["k"], "code", True, "n").first().n == 2
    assert distinct_size(df, ["k"], "code", False, "n").first().n == 1


def _interp(spark, values):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(values)], "k string, pos int, v double")
    return [r.out for r in interpolate(df, "v", ["k"], "pos", "out").orderBy("pos").collect()]


def test_interpolation_cases(spark):
    assert _interp(spark, [None, 1.0, None, None, 4.0, None]) == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]
    assert _interp(spark, [None, None]) == [None, None]


def test_half_even_and_threshold_round(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r.y for r in df.select(half_even("x", 0).alias("y")).collect()] == [0.0, 2.0, 2.0]
    df = spark.createDataFrame([(2.25,), (2.5,)], "x double")
    assert [r.y for r in df.select(threshold_round("x", 0.3).alias("y")).collect()] == [2.0, 3.0]
    assert df.select(threshold_round(F.lit(2.25), 0.25).alias("y")).first().y == 3.0


def test_first_by_total_order(spark):
    rows = [("a", 2, "x2"), ("a", 1, "x1"), ("b", 5, "y")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {r.k: r.v for r in first_by(df, ["k"], ["o"], ["v"]).collect()}
    assert got == {"a": "x1", "b": "y"}


def test_running_share_order(spark):
    rows = [("c", "p1", 30.0), ("c", "p2", 60.0), ("c", "p3", 10.0)]
    df = spark.createDataFrame(rows, "k string, prod string, s double")
    got = {r.prod: r.agg for r in running_share(df, "k", "s", "prod", "agg").collect()}
    assert got == {"p2": 60.0, "p1": 90.0, "p3": 100.0}


def test_nan_never_enters(spark):
    from cratecast.functions.scalar import safe_div

    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "a double, b double")
    got = [r.q for r in df.select(safe_div("a", "b").alias("q")).collect()]
    assert got == [None, None]
    assert not any(isinstance(v, float) and math.isnan(v) for v in got)


def test_quantile_with_hot_value(spark):
    # a third of all rows hold one value: the bracket collapses onto it
    xs = [5.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    for p in (0.1, 0.3, 0.5, 0.95):
        got = exact_quantiles(df, "x", [p], bins=8)[0]
        assert got == pytest.approx(float(np.quantile(np.array(xs), p)))


def test_quantile_cut(spark):
    from cratecast.operators.quantile import quantile_cut

    df = spark.createDataFrame([(float(v),) for v in range(1, 1001)], "x double")
    kept, q = quantile_cut(df, "x", 0.95, strict=True)
    assert q == pytest.approx(950.05)
    assert kept.count() == 950
    assert quantile_cut(df.limit(0), "x", 0.95, strict=False)[1] is None


@pytest.mark.parametrize("xs,most", [
    ([1.0 + i * 1e-9 for i in range(400)] + [1e9 + i * 1e-3 for i in range(400)], 6),   # two tight groups, rank k at the gap
    ([float(i) for i in range(500)] + [1e300], 5),                                       # one huge outlier
    ([-1e308, -1e308, 0.0, 1.0, 1e308], 4),                                              # a range beyond the largest double
    ([7.0] * 1000 + [8.0], 2),                                                           # a hot value
])
def test_quantile_search_ends(spark, xs, most):
    from cratecast.operators.quantile import _values, order_statistics

    df = spark.createDataFrame([(v,) for v in xs], "x double")
    s = sorted(xs)
    ranks = sorted({0, len(s) // 2 - 1, len(s) // 2, len(s) - 1})
    found, passes = order_statistics(_values(df, "x", None), ranks, s[0], s[-1], bins=16)
    assert {k: v for k, (v, _) in found.items()} == {k: s[k] for k in ranks}
    assert all(n == sum(v <= s[k] for v in s) for k, (_, n) in found.items())
    assert passes <= 3 * most
    for p in (0.25, 0.5, 0.95):
        assert exact_quantiles(df, "x", [p])[0] == pytest.approx(float(np.quantile(np.array(xs), p)), rel=1e-12)


def test_box_stats_of_nothing(spark):
    from cratecast.plans.report import box_stats

    r = box_stats(spark.createDataFrame([], "x double"), "x", "none").first()
    assert r.n == 0 and r.q1 is None and r.fence_hi is None and r.n_outliers == 0
