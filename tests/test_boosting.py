"""Boosting state beside the features: the same trees, no features in a block's table, no exchange where both meet."""

import random

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.plans import model
from cratecast.session import land_table

SCHEMA = (
    "ClienteClave string, EsquemaID string, Semana int, Mes int, Dia int, Categoria string, "
    "Visitas_Semanales long, Venta_media_por_dia double, Venta_Total_dia double"
)


def _rows(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ch, sem, mean = rnd.choice(["D02", "D21"]), rnd.randint(1, 20), float(rnd.randint(10, 200))
        y = mean * (1.5 if ch == "D02" else 0.7) + rnd.uniform(-20, 20)
        out.append((f"c{i}", ch, sem, 1 + sem // 5, i % 6, "Bajo" if mean < 100 else "Alto", 1 + i % 4, mean, y))
    return out


def test_same_errors_as_plain_boosting(spark):
    rows = _rows(300, 11)
    # rows of one key, equal and unequal, and rows without a client, keep their multiplicity
    rows += [rows[0], (*rows[0][:8], 5.0), (None, *rows[1][1:]), (None, *rows[1][1:])]
    d = spark.createDataFrame(rows, SCHEMA)
    p = fixture_params(gbt_max_iter=7, gbt_max_depth=3, gbt_patience=50, gbt_block=3)
    f = model.fit_gbt(d, p)

    x = model.hash_split(model._prep(d), model.ROW_KEY, p)
    x = f.features.transform(x).select("features", model.LABEL, "split").cache()
    now, errors = x.withColumn("_at", F.lit(f.base)), []
    for _ in range(7):
        train = now.filter("split = 'train'").withColumn("r", F.col(model.LABEL) - F.col("_at"))
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="r", predictionCol="t", maxDepth=3, maxBins=p.gbt_max_bins, seed=0).fit(train)
        now = tree.transform(now).withColumn("_at", F.col("_at") + F.lit(p.gbt_step) * F.col("t")).drop("t")
        errors.append(now.filter("split = 'val'").agg(F.avg((F.col(model.LABEL) - F.col("_at")) ** 2)).first()[0])
    x.unpersist()
    assert f.errors == pytest.approx(errors, rel=1e-9)


def test_rows_are_numbered_apart(spark):
    rows = _rows(50, 3)
    d = spark.createDataFrame(rows + rows[:20] + [(None, *rows[0][1:])] * 3, SCHEMA)
    n = model.numbered(d)
    assert n.count() == 73 == n.select(*model.ROW).distinct().count()
    again = model.numbered(d.repartition(5)).select(*d.columns, *model.ROW)
    assert sorted(map(str, again.collect())) == sorted(map(str, n.select(*d.columns, *model.ROW).collect()))


def test_block_lands_predictions_only_and_meets_features_without_exchange(spark, monkeypatch):
    landed = []

    def spy(df, name, by=()):
        landed.append((name, df.columns))
        out = land_table(df, name, by)
        return out

    monkeypatch.setattr(model, "land_table", spy)
    d = spark.createDataFrame(_rows(200, 5), SCHEMA)
    model.fit_gbt(d, fixture_params(gbt_max_iter=6, gbt_max_depth=2, gbt_patience=50, gbt_block=2))
    assert [n for n, _ in landed] == ["gbt_rows", "gbt_block", "gbt_block", "gbt_block"]
    assert landed[-1][1] == [*model.ROW, "_at", "_e5", "_e6"]

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x, _ = land_table(model.numbered(d).select(*model.ROW, model.LABEL), "gbt_x", by=model.ROW)
        s, _ = land_table(x.select(*model.ROW, F.lit(1.0).alias("_at")), "gbt_s", by=model.ROW)
        both = model.with_state(x, s)
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        assert both.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_tree_does_not_replay_the_trees_before_it(spark, monkeypatch):
    inputs = []
    fit = DecisionTreeRegressor._fit

    def spy(self, df):
        inputs.append((df.sparkSession.conf.get("spark.sql.shuffle.partitions"), df._jdf.queryExecution().withCachedData().toString()))
        return fit(self, df)

    monkeypatch.setattr(DecisionTreeRegressor, "_fit", spy)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    model.fit_gbt(spark.createDataFrame(_rows(200, 5), SCHEMA), fixture_params(gbt_max_iter=5, gbt_max_depth=2, gbt_patience=50, gbt_block=5))
    # from the second tree on the input is the kept rows of the tree before; few rows are few buckets
    assert ["InMemoryRelation" in plan for _, plan in inputs] == [False, True, True, True, True]
    assert {n for n, _ in inputs} == {"1"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == was
