"""Cold-start demand curves (G6) and the curve forecast.

A curve is the mean day total per (channel, visits per week, ISO week) over
the daily dataset, on a complete week grid; empty weeks take the channel
mean, points with z >= 1 inside their curve become gaps, gaps are filled by
linear interpolation, the tail by the last value and the head by the first.
Curve groups are bounded (one row per week), so windows are used there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import half_even
from ..operators.reshape import complete_grid
from ..operators.stats import fill_group_mean, interpolate, zscore
from ..params import PlanParams

KEYS = ["EsquemaID", "Visitas_Semanales"]


def week_range(s: DataFrame) -> tuple[int | None, int | None]:
    lo, hi = s.agg(F.min("Semana"), F.max("Semana")).first()
    return lo, hi


def curve_grid(daily: DataFrame, w0: int, w1: int) -> DataFrame:
    """(channel, visits) combinations of the daily set x weeks w0..w1, with
    the mean day total where observed (NULL elsewhere)."""
    grid = complete_grid(daily, KEYS, "Semana", w0, w1)
    mean = daily.groupBy("EsquemaID", "Semana", "Visitas_Semanales").agg(F.avg("Venta_Total_dia").alias("Venta_Total_dia"))
    return grid.join(mean, ["EsquemaID", "Semana", "Visitas_Semanales"], "left")


def curve_filled(grid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Empty cells take the mean of their channel's observed cells (Z7); ``by``: further keys."""
    return fill_group_mean(grid, "Venta_Total_dia", [*by, "EsquemaID"])


def curve_smooth(filled: DataFrame, p: PlanParams, by: Sequence[str] = ()) -> DataFrame:
    keys = [*by, *KEYS]
    z = zscore(filled, "Venta_Total_dia", keys, "Valor_Z", p.z_single)
    z = z.withColumn(
        "Venta_Total_dia", F.when(F.col("Valor_Z") >= F.lit(p.z_curve_null), F.lit(None)).otherwise(F.col("Venta_Total_dia"))
    )
    i = interpolate(z, "Venta_Total_dia", keys, "Semana", "Venta_Total_dia")
    return i.withColumn("prediccion", half_even("Venta_Total_dia", 3)).drop("Valor_Z")


def demand_curves(daily: DataFrame, w0: int, w1: int, p: PlanParams) -> DataFrame:
    return curve_smooth(curve_filled(curve_grid(daily, w0, w1)), p)


def curve_forecast(cold: DataFrame, curves: DataFrame, days: DataFrame, p: PlanParams) -> DataFrame:
    """Per planned weekday of each cold client: the curve value of its
    (channel, visits) at the forecast week, divided by its weekly visits."""
    cc = cold.join(curves.filter(F.col("Semana") == p.forecast_week), KEYS)
    x = days.select("ClienteClave", "Dia").join(cc, "ClienteClave")
    return x.select(
        "ClienteClave", "EsquemaID", "Semana", "Dia", "Visitas_Semanales",
        (F.col("prediccion") / F.col("Visitas_Semanales")).alias("prediccion"),
    )
