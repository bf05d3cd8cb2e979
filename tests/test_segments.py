"""All runs of the segments in common passes: few jobs, Spark's own silhouette, the same result however rows are dealt."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.plans.segments import Run, _local, fit_segments


def _vectors(spark, units, n):
    rnd = random.Random(4)
    rows = []
    for u in range(units):
        for i in range(n):
            c = rnd.randrange(4)
            rows.append((f"D00{u}", f"c{u}-{i}", [rnd.gauss(9 if j == c else 0, 2) for j in range(4 + u)]))
    return spark.createDataFrame(rows, "UNE string, ClienteClave string, a array<double>").select("UNE", "ClienteClave", array_to_vector("a").alias("features"))


def test_jobs_do_not_grow_with_the_number_of_runs(spark):
    v = _vectors(spark, 2, 150).localCheckpoint()
    sc = spark.sparkContext
    sc.setJobGroup("segments", "")
    try:
        fit_segments(v, fixture_params(k_max=6, kmeans_seeds=tuple(range(10)), kmeans_max_iter=15))
        jobs = len(sc.statusTracker().getJobIdsForGroup("segments"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # 100 runs: a job a pass (start 6, 15 at most, cost, sizes, silhouette) and those of the tables
    assert jobs < 60


def test_silhouette_is_sparks_and_clusters_do_not_depend_on_partitions(spark):
    v = _vectors(spark, 2, 200)
    p = fixture_params(k_max=5, kmeans_seeds=(0, 1, 2))
    a, b = fit_segments(v, p), fit_segments(v.repartition(5, "ClienteClave"), p)
    assert sorted(map(tuple, a.assignments.collect())) == sorted(map(tuple, b.assignments.collect()))
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="Cluster")
    for r in a.scores.filter("chosen").collect():
        x = v.join(a.assignments, ["UNE", "ClienteClave"]).filter(F.col("UNE") == r.UNE).withColumn("Cluster", F.col("Cluster").cast("double"))
        assert x.select("Cluster").distinct().count() == r.k
        assert ev.evaluate(x) == pytest.approx(r.silhouette, abs=1e-9)
    for u in ("D000", "D001"):
        of = a.scores.filter(F.col("UNE") == u)
        assert [r.k for r in of.orderBy("k").collect()] == [2, 3, 4, 5]
        assert of.filter("chosen").first().silhouette == of.agg(F.max("silhouette")).first()[0]


def test_units_of_few_clients_are_one_segment(spark):
    v = _vectors(spark, 1, 2).union(_vectors(spark, 1, 40).withColumn("UNE", F.lit("D009")))
    s = fit_segments(v, fixture_params(k_max=4, kmeans_seeds=(0,)))
    assert {r.UNE for r in s.scores.collect()} == {"D009"}
    assert [r.Cluster for r in s.assignments.filter("UNE = 'D000'").collect()] == [0, 0]


def test_start_of_equal_candidates_has_fewer_centres():
    c = _local(np.ones((5, 2)), np.ones(5), 3, np.random.default_rng(0))
    assert len(c) == 1 and Run("u", 3, 0).centres is None
