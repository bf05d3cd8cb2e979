"""A client holding a third of all rows: results equal pandas, and AQE splits
its partition in the join back (thresholds lowered, broadcast off)."""

import random

import pandas as pd
import pytest

from cratecast.operators.stats import first_by, zscore


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_client_zscore_and_first(spark):
    rnd = random.Random(11)
    rows = [("hot", i, float(rnd.randint(1, 50))) for i in range(6000)]
    rows += [(f"c{k}", i, float(rnd.randint(1, 50))) for k in range(200) for i in range(60)]
    pdf = pd.DataFrame(rows, columns=["k", "o", "x"])
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(pdf).repartition(16)
        z = zscore(df, "x", ["k"], "z", hot=True)
        got = z.toPandas().sort_values(["k", "o"]).reset_index(drop=True)
        assert "skew=true" in final_plan(z)
        two = zscore(z.filter("z <= 1.75").drop("z"), "x", ["k", "o"], "z", hot=True)  # as the two bands of the cleaning
        two.collect()
        assert "skew=true" in final_plan(two)
        exp = pdf.copy()
        exp["z"] = exp.groupby("k")["x"].transform(lambda s: (s - s.mean()) / s.std())
        exp = exp.sort_values(["k", "o"]).reset_index(drop=True)
        assert len(got) == len(exp) == len(rows)
        assert got["z"].tolist() == pytest.approx(exp["z"].tolist(), rel=1e-9, abs=1e-12)
        f = {r.k: r.x for r in first_by(df, ["k"], ["o"], ["x"]).collect()}
        assert f["hot"] == rows[0][2]
        assert len(f) == 201
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
