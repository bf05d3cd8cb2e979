"""Exploratory tables and checks.

The original drew charts (pie, line, histogram, box); these are the tables
behind them. Global scalars (quantiles, min/max for bin edges) are computed
as small aggregations and applied as literals, never by collecting rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import week_date
from ..functions.scalar import half_even
from ..operators.quantile import exact_quantiles, group_quantiles
from ..session import materialize
from ..sources.extracts import channel_codes
from ..sources.schemas import SCHEMAS
from .clean import CleanStages


def product_share(s: DataFrame) -> DataFrame:
    """Litres per product and its percent of all litres (pie chart table).

    The percent window runs over the aggregated product list only."""
    g = s.groupBy("ProductoClave").agg(F.sum("KgLts_Total").alias("KgLts_Total"))
    return g.withColumn("pct", F.col("KgLts_Total") * 100.0 / F.sum("KgLts_Total").over(W.partitionBy()))


def weekly_trend(s: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Litres per (year, ISO week) with a representative date (Jan 1 + 7*week)."""
    keys = [*(by or []), "Year", "Semana"]
    g = s.groupBy(*keys).agg(F.sum("KgLts_Total").alias("KgLts_Total"))
    # one row per week: the final sort is over a bounded result
    return g.withColumn("Fecha", week_date("Year", "Semana")).orderBy(*keys)


def client_weekly(s: DataFrame, ordered: bool = False) -> DataFrame:
    """Litres per (client, ISO week, year); ``ordered`` sorts by (year, week)
    with a range-partitioned sort, as the original listing was."""
    g = s.groupBy("ClienteClave", "Semana", "Year").agg(F.sum("KgLts_Total").alias("KgLts_Total"))
    return g.orderBy("Year", "Semana", "ClienteClave") if ordered else g


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram over [lo, hi] (default: the data's min and max);
    the max lands in the last bin, values outside the range in bins 0 / n+1."""
    if lo is None or hi is None:
        mn, mx = df.agg(F.min(col), F.max(col)).first()
        lo = mn if lo is None else lo
        hi = mx if hi is None else hi
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n long")
    if lo == hi:
        hi = lo + 1.0
    width = (hi - lo) / bins
    wb = F.width_bucket(F.col(col), F.lit(lo), F.lit(hi), F.lit(bins))
    b = F.when(F.col(col) == F.lit(hi), F.lit(bins)).otherwise(wb).cast("int")
    g = df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("hi"),
        "n",
    )


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std, min, exact quartiles, max (pandas ``describe``)."""
    q1, q2, q3 = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    a = df.agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )
    return a.select(
        "count", "mean", "std", "min",
        F.lit(q1).cast("double").alias("p25"), F.lit(q2).cast("double").alias("p50"),
        F.lit(q3).cast("double").alias("p75"), "max",
    )


def group_box(df: DataFrame, keys: list[str], col: str, weight: str | None = None) -> DataFrame:
    """Box-plot statistics of every group: n, min, quartiles, max, 1.5 IQR fences and the number of points outside them.

    ``weight``: each row counts that many times (day totals with their line count)."""
    x = df.select(*keys, F.col(col).cast("double").alias("x"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"))
    x = materialize(x.filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.col("w") > 0)), "box_values")
    q = group_quantiles(x, keys, "x", [0.25, 0.5, 0.75], ["q1", "median", "q3"], weight="w")
    iqr = F.col("q3") - F.col("q1")
    q = q.select(F.struct(*keys).alias("g"), "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("fence_lo"), (F.col("q3") + 1.5 * iqr).alias("fence_hi"))
    q = materialize(q, "box_quartiles")  # a plain side, so that the join can split a hot group
    outside = (F.col("x") < F.col("fence_lo")) | (F.col("x") > F.col("fence_hi"))
    j = x.withColumn("g", F.struct(*keys)).select("g", "x", "w").join(q, "g")
    # the group under a name of its own: dealt anew after the partial sums, so that the join may split it
    a = j.groupBy(F.struct("g").alias("h"), "q1", "median", "q3", "fence_lo", "fence_hi").agg(
        F.sum("w").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"), F.sum(F.when(outside, F.col("w")).otherwise(0)).alias("n_outliers")
    )
    return a.select("h.g.*", "n", "min", "q1", "median", "q3", "max", "fence_lo", "fence_hi", "n_outliers")


def box_stats(df: DataFrame, col: str, stage: str) -> DataFrame:
    """Quartiles, 1.5 IQR fences and the number of points outside them."""
    q1, q2, q3 = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    lo, hi = (None, None) if q1 is None else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    c = F.col(col)
    return df.agg(
        F.count(c).alias("n"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.count(F.when((c < F.lit(lo).cast("double")) | (c > F.lit(hi).cast("double")), 1)).alias("n_outliers"),
    ).select(
        F.lit(stage).alias("stage"), "n", "min", F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
        F.lit(q3).cast("double").alias("q3"), "max", F.lit(lo).cast("double").alias("fence_lo"), F.lit(hi).cast("double").alias("fence_hi"), "n_outliers",
    )


def cut_box(st: CleanStages) -> DataFrame:
    """The box of the day totals over lines before and after the quantile cut.

    Both stages are groups of one search over the (client, day) totals, each
    weighted by its lines; a day below the cut belongs to both."""
    d = st.day_totals.select("Venta_Total_dia", "n_lines")
    tags = F.array_compact(F.array(F.lit("before"), F.when(F.col("Venta_Total_dia") < F.lit(st.p_value), "after")))
    return group_box(d.select(F.explode(tags).alias("stage"), "Venta_Total_dia", "n_lines"), ["stage"], "Venta_Total_dia", "n_lines")


def channel_box(s: DataFrame) -> DataFrame:
    """The spread per channel: the box of its clients' weekly litres."""
    cw = s.groupBy("EsquemaID", "ClienteClave", "Year", "Semana").agg(F.sum("KgLts_Total").alias("KgLts_Total"))
    return group_box(cw, ["EsquemaID"], "KgLts_Total")


def channel_trend(s: DataFrame) -> DataFrame:
    """Weekly litres per channel with the spread of client-week totals."""
    cw = s.groupBy("EsquemaID", "ClienteClave", "Year", "Semana").agg(F.sum("KgLts_Total").alias("cw"))
    return cw.groupBy("EsquemaID", "Year", "Semana").agg(
        F.sum("cw").alias("KgLts_Total"),
        F.stddev_samp("cw").alias("std_cliente"),
        F.count(F.lit(1)).alias("n_clientes"),
    )


RETAINED = ("n_sales", "n_p", "n_z_client", "n_clean")


def observed(st: CleanStages) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """(the cleaned lines, counts): the rows of every stage are counted while the cleaned lines are computed.

    ``counts`` waits for the first action on the cleaned lines."""
    seen = {k: Observation(k) for k in RETAINED}
    x = st.tapped(lambda name, df: df.observe(seen[name], F.count(F.lit(1)).alias("n")))
    return x.clean, lambda: {k: o.get["n"] for k, o in seen.items()}


def _counts(st: CleanStages) -> dict[str, int]:
    """Rows of the stages: in passing where the lines are stored by client, else counted one by one.

    Stored lines run through the cleaning without an exchange, so that every
    count is taken in the tasks that write the result: a task that is run again
    after the loss of an executor counts once. Behind an exchange a stage that
    is recomputed could count twice, so the other plan counts its stages."""
    if st.p_value is None:
        return dict.fromkeys(RETAINED, 0)  # no lines; nothing would be observed
    if st.together:
        clean, counts = observed(st)
        clean.write.format("noop").mode("overwrite").save()
        return counts()
    return {k: x.count() for k, x in zip(RETAINED, (st.sales, st.p_sales, st.z_client, st.clean))}


def retention(st: CleanStages) -> DataFrame:
    """Rows kept after each cleaning step and their percentages (null without rows), as one row."""
    n = _counts(st)
    r = st.sales.sparkSession.createDataFrame([tuple(n[k] for k in RETAINED)], ", ".join(f"{k} long" for k in RETAINED))
    n_sales, n_p, n_z, n_c = (F.col(k) for k in RETAINED)
    pct = lambda a, b: a * 100.0 / F.nullif(b, F.lit(0))
    return r.select(
        *RETAINED,
        half_even(pct(n_z, n_p), 2).alias("pct_z_client"),
        half_even(pct(n_c, n_p), 2).alias("pct_clean"),
        half_even(F.lit(100.0) - pct(n_c, n_sales), 2).alias("pct_removed"),
    )


def compare(forecast: DataFrame, actual: DataFrame, key: str = "Semana", value: str = "Volumen") -> DataFrame:
    """Forecast vs actual per key, with error aggregates on every row.

    ``forecast``/``actual`` are (key, value) series; only keys present in
    both are compared. The error aggregates are windows over the whole
    series, which is bounded (one row per week).
    """
    f = forecast.select(key, F.col(value).alias("forecast"))
    a = actual.select(key, F.col(value).alias("actual"))
    j = f.join(a, key)
    j = j.withColumn("error", F.col("forecast") - F.col("actual")).withColumn(
        "pct_error", F.try_divide(F.col("error") * 100.0, F.nullif(F.col("actual"), F.lit(0.0)))
    )
    w = W.partitionBy()
    return j.select(
        key, "forecast", "actual", "error", "pct_error",
        F.avg(F.abs("pct_error")).over(w).alias("mape"),
        F.avg(F.abs("error")).over(w).alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error")).over(w)).alias("rmse"),
        F.try_divide((F.sum("forecast").over(w) - F.sum("actual").over(w)) * 100.0, F.sum("actual").over(w)).alias("bias_pct"),
    )


def load_checks(t, p, tables: tuple[str, ...] = ("sale_header", "sale_line", "client_channel", "warehouse", "sequence", "visit")) -> DataFrame:
    """What to look at after a load: (check, n) rows with the number of nulls
    in each non-nullable column, and of clients in more than one channel."""
    out = None
    for name in tables:
        keys = [f.name for f in SCHEMAS[name].fields if not f.nullable]
        one = getattr(t, name).agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
        one = one.unpivot([], keys, "check", "n").withColumn("check", F.concat(F.lit(f"{name}."), "check"))
        out = one if out is None else out.unionByName(one)
    twice = channel_codes(t, p).groupBy("ClienteClave").agg(F.count_distinct("EsquemaID").alias("k")).filter("k > 1")
    return out.unionByName(twice.agg(F.count(F.lit(1)).alias("n")).select(F.lit("clients in several channels").alias("check"), "n"))
