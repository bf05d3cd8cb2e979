"""Merged group statistics against one full pass."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.operators.merged import LandedState, merged, merged_zscore, state_of, zscore_from
from cratecast.operators.stats import zscore

SCHEMA = "k string, w int, x double"


def rows(seed=1):
    rng = random.Random(seed)
    out = [("hot", rng.randrange(6), 1e6 + rng.random()) for _ in range(3000)]  # a mean far from 0: sums of squares would cancel
    out += [(f"c{i % 40}", rng.randrange(6), rng.lognormvariate(2, 2)) for i in range(1500)]
    out += [("one", 3, 5.0), ("same", 0, 2.5), ("same", 4, 2.5), ("same", 5, 2.5), (None, 1, 1.0), (None, 2, 4.0), ("null", 0, None), ("c1", 2, None), ("late", 5, 1.0), ("late", 5, 3.0)]
    return out


def brute(data):
    by = {}
    for k, _, x in data:
        by.setdefault(k, []).extend([] if x is None else [x])
    return {k: (len(v), float(np.mean(v)) if v else 0.0, float(((np.array(v) - np.mean(v)) ** 2).sum()) if v else 0.0) for k, v in by.items()}


def as_dict(state):
    return {r["k"]: (r["n"], r["mean"], r["m2"]) for r in state.collect()}


def agree(got, want):
    assert got.keys() == want.keys()
    for k, (n, mean, m2) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(mean, rel=1e-9) and got[k][2] == pytest.approx(m2, rel=1e-9, abs=1e-12), k


def test_weekly_merges_equal_a_full_pass(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    s = LandedState(spark, str(tmp_path / "state"), ["k"], "x")
    assert s.read() is None and s.version() == 0
    for w in range(6):
        last = s.update(df.filter(F.col("w") == w))
        agree(as_dict(last), brute([r for r in data if r[1] <= w]))
    assert s.version() == 6
    agree(as_dict(s.update(df.limit(0))), brute(data))


def test_a_refresh_that_fails_leaves_the_state(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    s = LandedState(spark, str(tmp_path / "state"), ["k"], "x")
    s.update(df.filter("w < 3"))
    before = as_dict(s.read())
    bad = df.filter("w >= 3").withColumn("x", F.when(F.col("k") == "late", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        s.update(bad)
    assert s.version() == 1 and as_dict(s.read()) == before
    agree(as_dict(s.update(df.filter("w >= 3"))), brute(rows()))


def test_scores_equal_those_of_the_rows_own_statistics(spark):
    df = spark.createDataFrame([r for r in rows() if r[0] is not None and r[2] is not None], SCHEMA).withColumn("id", F.monotonically_increasing_id()).cache()
    got = {r["id"]: r["z"] for r in merged_zscore(df, [F.col("w") == w for w in range(6)], "x", ["k"], "z").collect()}
    want = {r["id"]: r["z"] for r in zscore(df, "x", ["k"], "z").collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-7
    df.unpersist()


def test_keys_without_a_state(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 3.0), ("new", 1, 7.0), (None, 1, 2.0)], SCHEMA)
    state = state_of(df.filter("k = 'a'"), ["k"], "x")
    out = {(r["k"], r["x"]): r["z"] for r in zscore_from(df, state, "x", ["k"], "z").collect()}
    assert out[("new", 7.0)] == out[(None, 2.0)] == 10.0 and out[("a", 3.0)] == pytest.approx(1 / math.sqrt(2))
    assert merged([state.limit(0), state.limit(0)], ["k"]).count() == 0
