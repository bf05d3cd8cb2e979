"""Visit plan, daily training set, bands and the warm/cold split."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import weeks_between
from ..functions.calendar import add_calendar
from ..functions.scalar import band
from ..operators.quantile import exact_quantiles
from ..operators.stats import code_rank, distinct_size, first_by, group_mode
from ..params import PlanParams
from .clean import CleanStages
from .model import ROW_KEY, hash_split

CLIENT = "ClienteClave"
LINE_ORDER = ["Fecha", "TransProdID", "TransProdDetalleID"]


def num_weeks(s: DataFrame) -> int | None:
    """Whole weeks between the first and the last sale date (a scalar)."""
    return s.agg(weeks_between(F.min("Fecha"), F.max("Fecha"))).first()[0]


def weekly_visits(seq: DataFrame, n_weeks: int | None) -> DataFrame:
    """Visits per week = distinct frequency codes per client, a NULL code
    counted as one visit (G8); times the number of weeks = total visits."""
    v = distinct_size(seq, [CLIENT], "FrecuenciaClave", count_null=True, out="Visitas_Semanales")
    return v.withColumn("Visitas_Totales", F.col("Visitas_Semanales") * F.lit(n_weeks).cast("long"))


def weekday_codes(seq: DataFrame) -> DataFrame:
    """Distinct non-null frequency codes, sorted descending, numbered as the
    weekday (Monday = 0) of the visit (Z10)."""
    return code_rank(seq, "FrecuenciaClave", "Dia", desc=True)


def plan_days(seq: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """(client, code, channel, weekday) rows of the visit plan; NULL codes drop.

    By default a code's weekday is its position in the descending list of
    codes (right only when codes sort Monday-last without gaps); ``codes``
    (FrecuenciaClave, Dia) gives the mapping explicitly instead."""
    return seq.join(codes if codes is not None else weekday_codes(seq), "FrecuenciaClave")


def visit_plan(seq: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Planned (client, channel, weekday) with visits per week counted
    without NULL codes (G9)."""
    days = plan_days(seq, codes)
    vs = distinct_size(days, [CLIENT], "FrecuenciaClave", count_null=False, out="Visitas_Semanales")
    return days.drop("FrecuenciaClave").join(vs, CLIENT, "left")


def client_weekday_stats(st: CleanStages) -> DataFrame:
    """Mean and median day total per (client, weekday) over the cut days."""
    days = add_calendar(st.kept_days, "Fecha", st.p.iso_year)
    return days.groupBy(CLIENT, "Dia").agg(
        F.avg("Venta_Total_dia").alias("Venta_media_por_dia"),
        F.median("Venta_Total_dia").alias("Venta_mediana_por_dia"),
    )


@dataclass
class TrainTotals:
    """Day totals of the training rows, exact decimals: litres have three places, so that subtracting one leaves no noise."""

    weekday: DataFrame   # (client, weekday): _n, _s, and _a, the sorted totals (a weekday's dates at most)
    client: DataFrame    # client: _cn, _cs
    n: int               # of all clients
    s: Decimal


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,3)")


def train_totals(st: CleanStages, land=None) -> TrainTotals:
    """Sums, counts and sorted totals of the kept days whose (client, week, weekday) is a training row of the model.

    One aggregate over the days; the coarser sums come from its rows."""
    days = hash_split(add_calendar(st.kept_days, "Fecha", st.p.iso_year), ROW_KEY, st.p).filter("split = 'train'")
    v = _exact("Venta_Total_dia")
    g = days.groupBy(CLIENT, "Dia").agg(F.count(v).alias("_n"), F.sum(v).alias("_s"), F.sort_array(F.collect_list(v)).alias("_a"))
    g = land(g, "train_totals") if land else g
    c = g.groupBy(CLIENT).agg(F.sum("_n").alias("_cn"), F.sum("_s").alias("_cs"))
    n, s = g.agg(F.sum("_n"), F.sum("_s")).first()
    return TrainTotals(g, c, n or 0, s if s is not None else Decimal(0))


def _median(a: Column) -> Column:
    """Median of a sorted array; null for an empty one."""
    n = F.size(a)
    at = lambda i: F.element_at(a, i.cast("int")).cast("double")
    return F.when(n > 0, (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2)


def with_train_means(x: DataFrame, st: CleanStages, land=None) -> DataFrame:
    """Rows of the daily set with the weekday mean and median over training days only, their own day left out.

    A row of the training split subtracts its own total from the sums it is
    part of; validation and test rows are in no sum. Without another training
    day of the (client, weekday) the mean is that of the client's other
    training days, then that of all clients', then 0; the median falls back to
    the same mean. Venta_media_plan is the mean a planned day sees: training
    days with none left out.
    """
    t = train_totals(st, land)
    x = hash_split(x, ROW_KEY, st.p).join(t.weekday, [CLIENT, "Dia"], "left").join(t.client, CLIENT, "left")
    own = F.col("split") == "train"
    one, mine = F.when(own, 1).otherwise(0), F.when(own, _exact("Venta_Total_dia")).otherwise(F.lit(0).cast("decimal(20,3)"))

    def mean(s: Column, n: Column, less: bool) -> Column:
        s, n = (s - mine, n - one) if less else (s, n)
        return F.when(n > 0, s.cast("double") / n)

    every = F.lit(t.s).cast("decimal(30,3)"), F.lit(t.n).cast("long")
    chain = lambda less: F.coalesce(mean(F.col("_s"), F.col("_n"), less), mean(F.col("_cs"), F.col("_cn"), less), mean(*every, less), F.lit(0.0))
    at = F.array_position("_a", _exact("Venta_Total_dia"))
    others = F.when(own & (at > 0), F.concat(F.slice("_a", 1, (at - 1).cast("int")), F.slice("_a", (at + 1).cast("int"), F.size("_a")))).otherwise(F.col("_a"))
    x = x.withColumns({"Venta_media_por_dia": chain(True), "Venta_media_plan": chain(False), "Venta_mediana_por_dia": F.coalesce(_median(others), chain(True))})
    return x.drop("split", "_n", "_s", "_a", "_cn", "_cs")


def daily_dataset(st: CleanStages, visits: DataFrame, train_means: bool = False, land=None) -> DataFrame:
    """One row per (client, ISO week, weekday): the first cleaned line in
    (date, header, detail) order, with weekday mean/median and visits (G3).

    Years are not part of the key (as in the original): the first row of all
    years' same week and weekday is kept. ``train_means``: the mean and median
    of training days only, without the row's own (``with_train_means``).
    """
    keep = ["Fecha", "UNE", "Ruta", "EsquemaID", "Mes", "Year", "Venta_Total_dia", "Valor_Z_general", "Valor_Z_detalle"]
    # reduce first: the joins depend on keys of the result only
    x = first_by(st.clean, [CLIENT, "Semana", "Dia"], LINE_ORDER, keep)
    x = with_train_means(x, st, land) if train_means else x.join(client_weekday_stats(st), [CLIENT, "Dia"], "left")
    x = x.join(visits.select(CLIENT, "Visitas_Semanales"), CLIENT)
    plan = ["Venta_media_plan"] if train_means else []
    return x.select(CLIENT, "Semana", "Dia", *keep, "Venta_media_por_dia", "Venta_mediana_por_dia", *plan, "Visitas_Semanales")


@dataclass
class Bands:
    q1: float | None
    q2: float | None
    q3: float | None
    daily: DataFrame


def bands(daily: DataFrame) -> Bands:
    """Quartiles of the weekday mean, applied to the day total."""
    q1, q2, q3 = exact_quantiles(daily, "Venta_media_por_dia", [0.25, 0.5, 0.75])
    return Bands(q1, q2, q3, daily.withColumn("Categoria", band("Venta_Total_dia", q1, q2, q3)))


def prediction_inputs(banded: DataFrame) -> DataFrame:
    """(client, weekday) -> weekday mean and modal band."""
    mode = group_mode(banded, [CLIENT, "Dia"], "Categoria")
    # with leave-one-out means a row's own differs from what a planned day sees
    mean = "Venta_media_plan" if "Venta_media_plan" in banded.columns else "Venta_media_por_dia"
    means = banded.select(CLIENT, "Dia", F.col(mean).alias("Venta_media_por_dia")).distinct()
    return means.join(mode, [CLIENT, "Dia"])


@dataclass
class Split:
    planned: DataFrame   # plan rows with features (NULL where no history)
    warm: DataFrame      # complete rows of clients with history on every planned day
    cold: DataFrame      # one row per client lacking history on some planned day


def split_clients(plan: DataFrame, banded: DataFrame, p: PlanParams) -> Split:
    """Warm/cold split (G5): a client with *any* planned weekday lacking
    history is cold as a whole."""
    return split_from_planned(plan.join(prediction_inputs(banded), [CLIENT, "Dia"], "left"), p)


def split_from_planned(x: DataFrame, p: PlanParams) -> Split:
    """Warm/cold split of plan rows already joined with their features."""
    missing = x.filter(F.col("Categoria").isNull())
    cold = first_by(missing, [CLIENT], ["EsquemaID", "Visitas_Semanales"], ["EsquemaID", "Visitas_Semanales"])
    warm = x.dropna().join(cold.select(CLIENT), CLIENT, "left_anti")
    warm = warm.withColumns({"Mes": F.lit(p.forecast_month), "Semana": F.lit(p.forecast_week)})
    return Split(x, warm, cold)
