"""Weekday means of training days only, a row's own left out."""

import datetime as dt
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.functions.calendar import add_calendar
from cratecast.params import fixture_params
from cratecast.plans.dataset import prediction_inputs, split_clients, with_train_means
from cratecast.plans.demand import DemandPlan
from cratecast.plans.model import ROW_KEY, hash_split
from cratecast.sources.fixtures import Tables

from .conftest import SF_SMALL

DAYS = "ClienteClave string, Fecha date, Venta_Total_dia double"


def split_of(spark, days):
    p = fixture_params()
    return {(r["ClienteClave"], r["Fecha"]): r["split"] for r in hash_split(add_calendar(spark.createDataFrame(days, DAYS), "Fecha"), ROW_KEY, p).collect()}


def run(spark, days):
    p = fixture_params()
    st = types.SimpleNamespace(kept_days=spark.createDataFrame(days, DAYS), p=p)
    rows = add_calendar(st.kept_days, "Fecha")
    return {(r["ClienteClave"], r["Fecha"]): r for r in with_train_means(rows, st).collect()}


def brute(days, split, own):
    """(leave-one-out mean, median, mean of planned days) by the rule, for one day."""
    train = [d for d in days if split[d[:2]] == "train"]
    c, f, _ = own

    def first(*choices):
        return next((float(np.mean([v for _, _, v in x])) for x in choices if x), 0.0)

    same = [d for d in train if d[0] == c and d[1].weekday() == f.weekday()]
    mine = [d for d in train if d[0] == c]
    less = lambda x: [d for d in x if d[:2] != own[:2]]
    loo = first(less(same), less(mine), less(train))
    return loo, float(np.median([v for _, _, v in less(same)])) if less(same) else loo, first(same, mine, train)


def test_rows_never_see_their_own_day_nor_other_splits(spark):
    start = dt.date(2022, 1, 3)
    days = [(f"c{i % 4}", start + dt.timedelta(days=i * 3 % 200), round(10 + i * 1.237 % 31, 3)) for i in range(160)]
    days = [(c, f, v) for (c, f), v in {(c, f): v for c, f, v in days}.items()]
    split, got = split_of(spark, days), run(spark, days)
    assert {"train", "val", "test"} == set(split.values()) and len(got) == len(days)
    for d in days:
        r = got[d[:2]]
        assert (r["Venta_media_por_dia"], r["Venta_mediana_por_dia"], r["Venta_media_plan"]) == pytest.approx(brute(days, split, d), rel=1e-12), d
    # another value on a validation or test day changes nobody's mean
    other = [d for d in days if split[d[:2]] != "train"][0]
    again = run(spark, [d if d != other else (*d[:2], 9999.0) for d in days])
    assert all(again[k]["Venta_media_por_dia"] == got[k]["Venta_media_por_dia"] for k in got)


def test_a_client_with_one_training_row(spark):
    days, split = [], {}
    for i in range(200):  # a client with one training day and one of another split
        c = f"x{i}"
        two = [(c, dt.date(2022, 1, 3), 40.0), (c, dt.date(2022, 1, 11), 90.0)]
        if sorted(split_of(spark, two).values())[-1] == "train" and len(set(split_of(spark, two).values())) == 2:
            days = two
            break
    days += [("y", dt.date(2022, 2, 7) + dt.timedelta(days=7 * i), 10.0 + i) for i in range(6)]
    split, got = split_of(spark, days), run(spark, days)
    mine = [d for d in days[:2] if split[d[:2]] == "train"][0]
    theirs = [v for c, f, v in days if c == "y" and split[c, f] == "train"]
    # its own day is all the client has: the mean of the other clients' training days
    assert got[mine[:2]]["Venta_media_por_dia"] == pytest.approx(np.mean(theirs)) == got[mine[:2]]["Venta_mediana_por_dia"]
    rest = [d for d in days[:2] if d != mine][0]
    assert got[rest[:2]]["Venta_media_por_dia"] == mine[2] == got[mine[:2]]["Venta_media_plan"]
    one = run(spark, [mine])
    assert one[mine[:2]]["Venta_media_por_dia"] == 0.0


def test_the_plan_takes_the_option(spark):
    t, p = Tables(spark, SF_SMALL), fixture_params()
    base, plan = DemandPlan(t, p), DemandPlan(t, p, train_means=True)
    assert plan.daily.count() == base.daily.count() == 797
    assert set(plan.daily.columns) - set(base.daily.columns) == {"Venta_media_plan"}
    inputs = prediction_inputs(plan.bands.daily)
    assert inputs.groupBy("ClienteClave", "Dia").count().filter("count > 1").count() == 0
    sp = split_clients(plan.visit_plan, plan.bands.daily, p)
    assert sp.warm.filter(F.col("Venta_media_por_dia").isNull()).count() == 0 and sp.warm.count() == base.split.warm.count()
