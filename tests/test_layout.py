"""Lines stored by client: the same stages with and without, no exchange where nothing is hot, the split where a client is."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.plans import clean
from cratecast.plans.demand import DemandPlan
from cratecast.plans.report import observed, retention
from cratecast.session import checkpoint_dir
from cratecast.sources.fixtures import Tables

from .conftest import SF_SMALL


class Hot(Tables):
    """The fixture with a client that holds about a third of all headers."""

    @property
    def sale_header(self):
        h = Tables.sale_header.func(self)
        return h.withColumn("ClienteClave", F.when(F.crc32("TransProdID") % 3 == 0, "7").otherwise(F.col("ClienteClave")))


def plan_of(spark, cls=Tables, together=None):
    dp = DemandPlan(cls(spark, SF_SMALL), fixture_params(), materialize_stages=True)
    if together is not None:
        dp.together = together
    return dp


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("cls", [Tables, Hot])
def test_both_layouts_give_the_same_stages(spark, cls):
    a, b = plan_of(spark, cls, True), plan_of(spark, cls, False)
    for stage in ("daily", "mix_long", "day_mix", "blend"):
        x, y = getattr(a, stage), getattr(b, stage)
        r = lambda d: d.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in d.dtypes])
        assert x.count() > 100 and r(x).exceptAll(r(y)).count() == r(y).exceptAll(r(x)).count() == 0, stage


def test_stored_lines_need_no_exchange(spark):
    dp = plan_of(spark)
    assert dp.together
    dp.stages.p_value
    assert "Exchange" not in final_plan(dp.stages.clean)
    assert "Exchange" not in final_plan(dp.day_mix)
    assert final_plan(dp.blend).count("ShuffleQueryStage") <= 10


def test_the_blend_of_new_products_reads_the_lines_once(spark):
    """The day total is stored with the lines; history and segments are landed, so that only the weekday profile reads lines."""
    dp = plan_of(spark)
    dp.p = dp.p.with_(allow_new_products=True)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan(dp.stages.p_sales) and "Venta_Total_dia" not in dp.sales.columns
    assert len(re.findall(r"FileScan parquet \S*\.sales_", plan(dp.blend))) == 1
    assert dp.assignments.count() > 100


def test_a_hot_client_keeps_its_lines_in_many_tasks(spark):
    dp = plan_of(spark, Hot)
    assert clean.hot_client(dp.t, dp.p, 8) and not dp.together and not clean.hot_client(Tables(spark, SF_SMALL), dp.p, 8)
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert "skew=true" in final_plan(dp.stages.clean)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_retention_reads_the_lines_once(spark):
    """The counts are taken while the cleaning runs, and equal those of the stages counted one by one."""
    dp = plan_of(spark)
    st = dp.stages
    tapped, counts = observed(st)
    tapped.write.format("noop").mode("overwrite").save()
    plan = tapped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    want = [x.count() for x in (st.sales, st.p_sales, st.z_client, st.clean)]
    assert [counts()[k] for k in ("n_sales", "n_p", "n_z_client", "n_clean")] == want == [4067, 3858, 3594, 3404]
    a, b = retention(st).first(), retention(plan_of(spark, together=False).stages).first()
    assert a == b and (a["n_sales"], a["n_clean"]) == (4067, 3404)


def test_retention_of_nothing(spark):
    p = fixture_params().with_(units=("none",))
    dp = DemandPlan(Tables(spark, SF_SMALL), p, materialize_stages=True)
    assert tuple(retention(dp.stages).first()) == (0, 0, 0, 0, None, None, None)


def test_release_drops_what_the_plan_landed(spark):
    folder = checkpoint_dir(spark)
    files = lambda: sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(folder))
    before = files()
    dp = plan_of(spark)
    dp.weekly.count()
    assert files() > before and len(dp._tables) >= 4
    tables = list(dp._tables)
    dp.release()
    assert not dp._tables and not any(spark.catalog.tableExists(t) for t in tables)
    dp.release()


def test_sums_do_not_depend_on_the_order(spark):
    rows = [("c", "d", x) for x in (0.1, 0.2, 0.3, 1e6, 0.001)] * 50
    for seed in (1, 2):
        df = spark.createDataFrame(rows, "ClienteClave string, Fecha string, KgLts_Total double").orderBy(F.rand(seed)).repartition(7)
        assert clean.day_totals(df).first()["Venta_Total_dia"] == 50000030.05


def test_both_z_bands_share_one_sort(spark):
    """The windows by client and by (client, product) follow one sort of the stored lines."""
    dp = plan_of(spark)
    assert dp.together
    assert final_plan(dp.stages.clean).count("Sort [") == 1
