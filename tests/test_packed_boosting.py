"""Boosting over packed rows: Spark ML's trees, in one task and spread."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.plans import boosting, model

SCHEMA = (
    "ClienteClave string, EsquemaID string, Semana int, Mes int, Dia int, Categoria string, "
    "Visitas_Semanales long, Venta_media_por_dia double, Venta_Total_dia double"
)


def _rows(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ch, sem, mean = rnd.choice(["D02", "D21", "D22"]), rnd.randint(1, 30), round(rnd.uniform(10, 900), 2)
        y = round(mean * (1.5 if ch == "D02" else 0.7) + rnd.uniform(-50, 50))
        out.append((f"c{i // 3}", ch, sem, 1 + sem // 5, i % 6, "Bajo" if mean < 300 else "Alto", 1 + i % 4, mean, float(y)))
    return out + out[:40] + [(None, *out[0][1:])] * 3


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(_rows(900, 4), SCHEMA)


P = fixture_params(gbt_max_iter=5, gbt_max_depth=6, gbt_patience=50, gbt_block=2, gbt_max_bins=32)


@pytest.fixture(scope="module")
def by_spark(daily):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(model, "FEW_ROWS", 10_000)
        return model.fit_gbt(daily, P)


def predictions(f, daily):
    x = f.features.transform(model._prep(daily))
    return sorted((tuple(r)) for r in f.predict(x).select(F.coalesce("ClienteClave", F.lit("")), "Semana", "Dia", "Venta_media_por_dia", "prediction").collect())


def test_trees_are_those_of_spark_ml(daily, by_spark, monkeypatch):
    monkeypatch.setattr(model, "FEW_ROWS", 0)
    f = model.fit_gbt(daily, P)
    assert f.errors == pytest.approx(by_spark.errors, rel=1e-12) and f.n_trees == by_spark.n_trees == f.model.getNumTrees
    assert [t.depth for t in f.model.trees] == [t.depth for t in by_spark.model.trees] and f.model.numFeatures == 50
    assert np.array([r[-1] for r in predictions(f, daily)]) == pytest.approx(np.array([r[-1] for r in predictions(by_spark, daily)]), rel=1e-12)
    assert list(f.metrics.first()) == pytest.approx(list(by_spark.metrics.first()), rel=1e-12)


@pytest.mark.parametrize("merge", [64 << 20, 0])
def test_spread_rows_give_the_trees_of_one_task(spark, daily, by_spark, monkeypatch, merge):
    """Parts, their blocks and sums added up on the driver or by executors change nothing, and checkpoints go."""
    import os

    from cratecast.session import checkpoint_dir

    monkeypatch.setattr(model, "FEW_ROWS", 0)
    for k, v in (("LOCAL_ROWS", 0), ("PART_ROWS", 300), ("BLOCK_ROWS", 100), ("MERGE_BYTES", merge), ("EXACT_ROWS", 0)):
        monkeypatch.setattr(boosting, k, v)
    f = model.fit_gbt(daily, P)
    assert f.errors == pytest.approx(by_spark.errors, rel=0.02) and abs(f.n_trees - by_spark.n_trees) <= 1
    assert len(f.errors) == 5
    left = [r for r, _, files in os.walk(checkpoint_dir(spark)) if "rdd-" in r and files]
    assert not left


def test_the_first_tree_is_the_same_however_rows_are_spread(daily, monkeypatch):
    """A signal without near ties."""
    monkeypatch.setattr(model, "FEW_ROWS", 0)
    p = P.with_(gbt_max_iter=3, gbt_max_depth=2)
    one = model.fit_gbt(daily, p)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    monkeypatch.setattr(boosting, "PART_ROWS", 200)
    assert model.fit_gbt(daily, p).errors == pytest.approx(one.errors, rel=1e-9)


def test_cuts_of_many_values_are_exact_quantiles(spark, monkeypatch):
    x = spark.createDataFrame([(float(i % 500),) for i in range(2000)], "v double")
    assert len(boosting.number_cuts(x, "v", 16)) == 15
    monkeypatch.setattr(boosting, "FEW_VALUES", 100)
    cuts = boosting.number_cuts(x, "v", 16)
    assert len(cuts) == 15 and max(abs(c - 500 * (i + 1) / 16) for i, c in enumerate(cuts)) <= 1.0


def test_early_stop_and_missing_labels(spark, daily, monkeypatch):
    monkeypatch.setattr(model, "FEW_ROWS", 0)
    noise = daily.withColumn("Venta_Total_dia", F.rand(3))
    f = model.fit_gbt(noise, fixture_params(gbt_max_iter=60, gbt_max_depth=4, gbt_patience=3, gbt_block=4))
    assert len(f.errors) < 60 and f.n_trees < len(f.errors) and f.errors[f.n_trees - 1] == min(f.errors)
    with pytest.raises(ValueError, match="no Venta_Total_dia"):
        model.fit_gbt(daily.withColumn("Venta_Total_dia", F.lit(None).cast("double")), P)


def test_the_backtests_models_have_the_plans_own_parameters(monkeypatch):
    """All trees and the short step; the origins are handed over together."""
    from cratecast import registry
    from cratecast.plans import backtest as B

    seen = []

    class Stop(Exception):
        pass

    class PlanOnly:
        p = fixture_params()

    def spy(plan, forecaster):
        seen.append(forecaster)
        raise Stop

    monkeypatch.setattr(registry, "_plan", lambda *a: PlanOnly)
    monkeypatch.setattr(B, "backtest", spy)
    with pytest.raises(Stop):
        registry.q_backtest_model(None, "")
    assert (seen[0].p.gbt_max_iter, seen[0].p.gbt_step, seen[0].p.gbt_patience) == (600, 0.1, 100) and seen[0].p == fixture_params()


def test_models_fitted_at_once_are_those_fitted_one_by_one(spark, daily, monkeypatch):
    monkeypatch.setattr(model, "FEW_ROWS", 300)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    p = P.with_(gbt_max_iter=3)
    pairs = [(daily.filter(f"Dia % 2 = {i}"), daily.filter(f"Dia % 2 = {i}")) for i in (0, 1)] + [(daily.filter("Dia = 3"), daily.filter("Dia = 3 and Semana < 9"))]
    fit = model.gbt_forecaster(p)
    got = [sorted(map(str, x.collect())) for x in fit.each(pairs)]
    assert got == [sorted(map(str, fit(*pair).collect())) for pair in pairs] and all(got)
    assert spark.conf.get("spark.sql.shuffle.partitions") == was
