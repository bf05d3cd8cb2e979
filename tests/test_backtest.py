"""Rolling origins: nothing behind an origin is read for its forecast; the outer blend of products."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cratecast.operators.stats import band_filter, zscore, zscore_bands
from cratecast.params import fixture_params
from cratecast.plans import mix
from cratecast.plans.backtest import AHEAD, ORIGIN, Backtest, backtest
from cratecast.plans.demand import DemandPlan
from cratecast.sources.fixtures import Tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def plan(spark):
    return DemandPlan(Tables(spark, SF_SMALL), fixture_params(), materialize_stages=True)


def forecasts(b):
    return {(r[ORIGIN], r[AHEAD]): r["forecast"] for r in b.forecast().collect()}


def test_no_fact_after_an_origin_is_read(plan):
    p = plan.p
    want = forecasts(backtest(plan))
    assert len(want) == len(p.backtest_origins) * p.backtest_weeks and len(set(want.values())) > 3
    for o in p.backtest_origins:
        # whatever is sold from the origin on: other amounts, other clients' lines gone
        later = plan.sales.withColumn("KgLts_Total", F.when(F.col("Fecha") >= F.lit(o), F.col("KgLts_Total") * 50 + 1).otherwise(F.col("KgLts_Total")))
        later = later.filter((F.col("Fecha") < F.lit(o)) | (F.crc32("ClienteClave") % 2 == 0))
        one = p.with_(backtest_origins=(o,))
        got = forecasts(Backtest(later, plan.weekly_visits, plan.visit_plan, plan.plan_days, one, land=plan._m))
        assert got == pytest.approx({k: v for k, v in want.items() if k[0] == o}, rel=1e-12)


def test_one_origin_equals_the_plan_that_ends_there(spark, plan):
    """The tagged stages equal the plan itself over sales that end the day before."""
    o = plan.p.backtest_origins[1]
    b = backtest(plan)
    cut = DemandPlan(Tables(spark, SF_SMALL), plan.p.with_(end=o - dt.timedelta(days=1)), materialize_stages=True)
    cols = ["ClienteClave", "Semana", "Dia", "Venta_Total_dia", "Categoria"]
    got = b.banded.filter(F.col(ORIGIN) == F.lit(o)).select(*cols)
    want = cut.bands.daily.select(*cols)
    assert want.count() > 100 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    key = ["EsquemaID", "Visitas_Semanales", "Semana", "prediccion"]
    got, want = (sorted(map(tuple, x.select(*key).collect())) for x in (b.curves.filter(F.col(ORIGIN) == F.lit(o)), cut.curves))
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_errors_and_weeks_without_sales(spark, plan):
    far = (dt.date(2001, 6, 25), dt.date(2030, 1, 7))
    b = Backtest(plan.sales, plan.weekly_visits, plan.visit_plan, plan.plan_days, plan.p.with_(backtest_origins=far, backtest_weeks=2), land=plan._m)
    rows = {(r[ORIGIN], r[AHEAD]): r for r in b.errors().collect()}
    assert len(rows) == 4
    empty = rows[far[1], 1]
    assert empty["actual"] == 0.0 and empty["pct_error"] is None and empty["error"] == empty["forecast"] and empty["mape_origen"] is None
    r = rows[far[0], 2]
    assert r["Desde"] == dt.date(2001, 7, 2) and r["Semana"] == 27 and r["error"] == pytest.approx(r["forecast"] - r["actual"])
    assert r["mape_horizonte"] == pytest.approx(abs(r["pct_error"]))
    with pytest.raises(ValueError):
        Backtest(plan.sales, None, None, None, plan.p.with_(backtest_origins=(dt.date(2001, 6, 26),)))


def test_a_forecaster_gets_one_origin_at_a_time(plan):
    seen = []

    def flat(banded, warm):
        seen.append(({r[0] for r in banded.select(ORIGIN).distinct().collect()}, {r[0] for r in warm.select(ORIGIN).distinct().collect()}))
        return warm.withColumn("prediccion", F.lit(0.0))

    b = backtest(plan, flat)
    assert b.warm_forecast().filter("prediccion <> 0").count() == 0
    assert [s[0] for s in seen] == [{o} for o in plan.p.backtest_origins] and all(w <= {o} for (_, w), o in zip(seen, plan.p.backtest_origins))


def test_lines_are_read_once_for_all_origins(plan):
    """A line is one row however many origins count it, and stored lines reach the daily set without an exchange of theirs."""
    b = backtest(plan)
    assert b.together and b.clean.count() <= plan.sales.count()
    b.clean.collect()
    assert "Exchange" not in b.clean._jdf.queryExecution().executedPlan().toString()
    assert b.daily.select(ORIGIN).distinct().count() == len(plan.p.backtest_origins)


def test_both_layouts_give_the_same_backtest(spark, plan):
    other = DemandPlan(Tables(spark, SF_SMALL), fixture_params(), materialize_stages=True)
    other.together = False
    a, b = backtest(plan), backtest(other)
    for stage in ("daily", "planned", "cold"):
        x, y = ([tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in getattr(k, stage).select(*sorted(getattr(a, stage).columns)).collect()] for k in (a, b))
        assert len(x) > 100 and sorted(x) == sorted(y), stage
    assert forecasts(a) == pytest.approx(forecasts(b), rel=1e-9)


@pytest.mark.parametrize("together", [True, False])
def test_bands_of_several_sets_equal_those_of_each_set(spark, together):
    rows = [(k, i, float((i * 7 + k) % 11), i % 3 != 0, i < 9 + k) for k in range(4) for i in range(14)]
    rows += [(9, 0, 5.0, True, False), (10, 0, 2.0, True, True), (10, 1, 2.0, True, True), (11, 0, None, True, True), (11, 1, 1.0, True, None)]
    df = spark.createDataFrame(rows, "k int, i int, x double, a boolean, b boolean").repartition(2, "k")
    got = zscore_bands(df, "x", ["k"], ["a", "b"], -1.0, 1.2, 10.0, together).collect()
    for f in ("a", "b"):
        want = band_filter(zscore(df.filter(f), "x", ["k"], "z", 10.0), "z", -1.0, 1.2)
        assert sorted((r["k"], r["i"]) for r in got if r[f]) == sorted((r["k"], r["i"]) for r in want.collect())


# -- products that only the segment buys ------------------------------------------------------


def hand(spark):
    p = fixture_params()
    names = [n for _, n in p.days]
    hist = [("c1", "A", 100.0), ("c2", "A", 50.0), ("c2", "B", 50.0), ("c3", "Z", 100.0)]
    hist = spark.createDataFrame([(c, q, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, s) for c, q, s in hist], "ClienteClave string, ProductoClave string, " + ", ".join(f"{n} double" for n in names) + ", Porcentaje double")
    ml = spark.createDataFrame([("U", "c1", "A", 100.0), ("U", "c2", "A", 50.0), ("U", "c2", "B", 50.0)], "UNE string, ClienteClave string, ProductoClave string, Porcentaje double")
    asg = spark.createDataFrame([("U", "c1", "k"), ("U", "c2", "k"), ("U", "ghost", "k")], "UNE string, ClienteClave string, Cluster string")
    sales = spark.createDataFrame([("U", "c2", "B", 1, 3.0), ("U", "c2", "B", 4, 1.0), ("U", "c1", "A", 0, 5.0)], "UNE string, ClienteClave string, ProductoClave string, Dia int, KgLts_Total double")
    return p, hist, ml, asg, mix.segment_days(sales, asg, p)


def test_a_new_product_gets_the_segments_share_and_weekdays(spark):
    p, hist, ml, asg, profile = hand(spark)
    rows = {(r["ClienteClave"], r["ProductoClave"]): r for r in mix.outer_blend(hist, ml, asg, profile, p).collect()}
    # centre over three members: A 50, B 16.67
    assert set(rows) == {("c1", "A"), ("c1", "B"), ("c2", "A"), ("c2", "B"), ("c3", "Z")}
    new = rows["c1", "B"]
    assert new["Porcentaje"] == pytest.approx(0.1 * 50 / 3) and (new["Martes"], new["Viernes"], new["Lunes"]) == (0.75, 0.25, 0.0)
    assert rows["c1", "A"]["Porcentaje"] == pytest.approx(0.9 * 100 + 0.1 * 50) and rows["c3", "Z"]["Porcentaje"] == 100.0


def test_outer_blend_shares_sum_to_one_and_the_default_is_unchanged(spark):
    p, hist, ml, asg, profile = hand(spark)
    fc = hist.select("ClienteClave").distinct()
    for prof in (None, profile):
        out = mix.blend(hist, ml, asg, fc, p.with_(share_cut=1000.0), prof).collect()
        by = {}
        for r in out:
            by[r["ClienteClave"]] = by.get(r["ClienteClave"], 0) + r["Porcentaje"]
        assert by == pytest.approx({"c1": 1.0, "c2": 1.0, "c3": 1.0}) and (("c1", "B") in {(r["ClienteClave"], r["ProductoClave"]) for r in out}) == (prof is not None)
