"""What the driver runs and holds for the pipeline: few jobs a landing, no round beyond the stars, narrow products."""

import tracemalloc

import numpy as np

from cratecast.llm import classify, components
from cratecast.session import materialize


def test_landing_is_one_job(spark):
    df = spark.range(100).selectExpr("id", "cast(id as string) as text", "array(id) as many")
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        out = materialize(df, "one_job")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("landing")) == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert out.dtypes == df.dtypes and out.agg({"id": "sum"}).first()[0] == 4950
    empty = materialize(df.where("id < 0"), "one_job")
    assert empty.dtypes == df.dtypes and empty.count() == 0


def test_rounds_end_with_stars(frame, monkeypatch):
    names, land = [], components.land
    monkeypatch.setattr(components, "land", lambda df, name: names.append(name) or land(df, name))
    stars = [(1, i) for i in range(2, 40)] + [(100, 101), (101, 100), (100, 100), (None, 5)]
    got = {r["node"]: r["comp"] for r in components.components(frame(stars, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 40)} | {100: 100, 101: 100}
    assert names == ["cc_edges"]
    chain = [(i, i + 1) for i in range(200, 230)] + [(300, 301), (302, 301), (303, 300)]
    got = {r["node"]: r["comp"] for r in components.components(frame(chain, "a long, b long")).collect()}
    assert got == {i: 200 for i in range(200, 231)} | {i: 300 for i in range(300, 304)}


def test_products_hold_some_columns_at_a_time():
    rnd = np.random.default_rng(0)
    at = np.sort(rnd.integers(0, 150_001, 500))
    at = np.concatenate(([0], at, [150_000]))
    b = classify.Bags(at, rnd.integers(0, 1000, 150_000).astype(np.int32), np.ones(150_000, np.float32), np.ones(501, np.int64))
    x, right = rnd.standard_normal(150_000).astype(np.float32), rnd.standard_normal((1000, 56)).astype(np.float32)
    tracemalloc.start()
    got = classify._times(b, x, right, wide=classify.NARROW)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    assert (got == classify._times(b, x, right)).all()
    whole = np.zeros((501, 56))
    np.add.at(whole, b.rows(), right[b.terms].astype(float) * x[:, None])
    assert np.allclose(got, whole, atol=1e-3)
