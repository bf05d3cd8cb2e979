"""Model contracts: k-means finds separated blobs, boosted trees beat the mean."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.plans.model import _prep, fit_gbt, hash_split, score
from cratecast.plans.segments import fit_segments


def test_kmeans_three_blobs(spark):
    rnd = random.Random(7)
    centres = [(0.0, 0.0, 100.0), (100.0, 0.0, 0.0), (0.0, 100.0, 0.0)]
    rows = []
    for i in range(60):
        c = centres[i % 3]
        rows.append(("D001", f"c{i}", Vectors.dense([x + rnd.uniform(-1, 1) for x in c])))
    v = spark.createDataFrame(rows, ["UNE", "ClienteClave", "features"])
    p = fixture_params(kmeans_seeds=(0, 1), kmeans_max_iter=30, k_max=5)
    seg = fit_segments(v, p, parallelism=4)
    chosen = [r.k for r in seg.scores.filter("chosen").collect()]
    assert chosen == [3]
    a = seg.assignments.groupBy("Cluster").count().collect()
    assert sorted(r["count"] for r in a) == [20, 20, 20]
    # same seeds -> same result
    seg2 = fit_segments(v, p, parallelism=4)
    assert sorted(tuple(r) for r in seg2.assignments.collect()) == sorted(tuple(r) for r in seg.assignments.collect())


def test_gbt_beats_mean_on_noiseless_signal(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        ch = rnd.choice(["D02", "D21"])
        sem, dia = rnd.randint(1, 52), rnd.randint(0, 5)
        vis = rnd.randint(1, 5)
        mean = float(rnd.randint(10, 200))
        y = mean * (1.5 if ch == "D02" else 0.7) + 3.0 * dia
        rows.append((f"c{i}", ch, sem, (sem - 1) // 5 + 1, dia, "Bajo" if mean < 100 else "Alto", vis, mean, y))
    d = spark.createDataFrame(
        rows,
        "ClienteClave string, EsquemaID string, Semana int, Mes int, Dia int, Categoria string, "
        "Visitas_Semanales long, Venta_media_por_dia double, Venta_Total_dia double",
    )
    p = fixture_params(gbt_max_iter=15, gbt_max_depth=4, gbt_patience=5)
    f = fit_gbt(d, p)
    m = f.metrics.first()
    assert m.R2 > 0.8
    assert 1 <= f.n_trees <= 15
    assert len(f.errors) <= 15 and f.errors[f.n_trees - 1] == min(f.errors)


def test_gbt_stops_fitting(spark):
    rnd = random.Random(5)
    # a label that is noise: the validation error soon rises
    rows = [(f"c{i}", "D02", 1 + i % 5, 1, i % 3, "Bajo", 1 + i % 4, float(rnd.randint(1, 9)), rnd.random()) for i in range(300)]
    d = spark.createDataFrame(
        rows,
        "ClienteClave string, EsquemaID string, Semana int, Mes int, Dia int, Categoria string, "
        "Visitas_Semanales long, Venta_media_por_dia double, Venta_Total_dia double",
    )
    f = fit_gbt(d, fixture_params(gbt_max_iter=60, gbt_max_depth=4, gbt_patience=3, gbt_block=4))
    assert len(f.errors) < 60 and f.n_trees < len(f.errors)
    assert f.errors[f.n_trees - 1] == min(f.errors)
    with pytest.raises(ValueError, match="Semana.*99"):
        score(f, d.withColumn("Semana", F.lit(99)))
    x = f.features.transform(_prep(d))
    assert x.count() == f.predict(x).filter("prediction is not null").count()


def test_hash_split_is_repeatable_and_proportional(spark):
    p = fixture_params()
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    a = hash_split(df, ["k"], p).groupBy("split").count().collect()
    b = hash_split(df.repartition(7), ["k"], p).groupBy("split").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    frac = {r.split: r["count"] / 20000 for r in a}
    assert frac["train"] == pytest.approx(0.64, abs=0.02)
    assert frac["val"] == pytest.approx(0.16, abs=0.02)
    assert frac["test"] == pytest.approx(0.20, abs=0.02)
