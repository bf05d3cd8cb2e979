"""Calendar rules and the forecast-vs-actual comparison."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cratecast.functions.calendar import add_calendar, weeks_between
from cratecast.plans.report import compare


def test_week_year_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 12, 30),)], "Fecha date")
    rows = {r.Fecha: r for r in add_calendar(df).collect()}
    assert (rows[dt.date(2021, 1, 1)].Semana, rows[dt.date(2021, 1, 1)].Year) == (53, 2021)
    assert (rows[dt.date(2024, 12, 30)].Semana, rows[dt.date(2024, 12, 30)].Year) == (1, 2024)
    assert rows[dt.date(2021, 1, 1)].Dia == 4
    iso = {r.Fecha: r.Year for r in add_calendar(df, iso_year=True).collect()}
    assert iso[dt.date(2021, 1, 1)] == 2020 and iso[dt.date(2024, 12, 30)] == 2025


def test_weeks_in_range(spark):
    df = spark.createDataFrame([(dt.date(2021, 7, 18), dt.date(2023, 11, 19))], "a date, b date")
    assert df.select(weeks_between(F.col("a"), F.col("b")).alias("w")).first().w == 122


# The published weekly series (week, litres), forecast and actual.
FORECAST = [(21, 1230668.8527061397), (22, 1125334.8936660464), (23, 1184469.2764174277), (24, 1148365.6490393456)]
ACTUAL = [(21, 1023039.769881563), (22, 1043510.8706043491), (23, 1054389.04645459)]


def test_compare_reproduces_published_errors(spark):
    f = spark.createDataFrame(FORECAST, "Semana int, Volumen double")
    a = spark.createDataFrame(ACTUAL, "Semana int, Volumen double")
    rows = {r.Semana: r for r in compare(f, a).collect()}
    assert sorted(rows) == [21, 22, 23]
    assert round(rows[21].pct_error, 2) == 20.30
    assert round(rows[22].pct_error, 2) == 7.84
    assert round(rows[23].pct_error, 2) == 12.34
    r = rows[21]
    assert round(r.mape, 2) == 13.49
    assert r.mae == pytest.approx(139844, abs=1)
    assert r.rmse == pytest.approx(149137, abs=1)
    assert round(r.bias_pct, 2) == 13.44


def test_visit_seconds_clamped(spark):
    from cratecast.params import fixture_params
    from cratecast.plans.clean import visit_durations

    rows = [
        ("c", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 10, 0, 0), dt.datetime(2024, 1, 2, 9, 0, 0)),
        ("c", dt.date(2024, 1, 3), dt.datetime(2024, 1, 3, 10, 0, 0), dt.datetime(2024, 1, 3, 10, 0, 1, 500000)),
    ]
    log = spark.createDataFrame(rows, "ClienteClave string, DiaClave date, FechaHoraInicial timestamp_ntz, FechaHoraFinal timestamp_ntz")
    v, q = visit_durations(log, fixture_params(visit_p_cut=1.0))
    got = sorted(r.Visita_seg for r in v.collect())
    assert got == [0.0, 1.5]
    assert q == 1.5
