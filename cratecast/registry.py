"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key.

Every query reads the whole set of driver tables of ``sf_dir`` through the
fixture mapping, with every unit and the whole date range, so its work grows
with the data. Double outputs are rounded to 6 decimals (as the oracle does)
so that summation order cannot flip a compared digit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .params import fixture_params
from .plans import clean as C
from .session import tune
from .sources import extracts as X
from .sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def rnd(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Round every double column (presentation step of checked outputs).

    Half-even on the binary value scaled by 10^decimals (``rint``), the same
    formula the oracle SQL uses, so both engines round a given double alike."""
    m = F.lit(float(10**decimals))
    return df.select(
        *[
            (F.rint(F.col(f.name) * m) / m).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _ctx(spark: SparkSession, sf_dir: str):
    tune(spark)
    return Tables(spark, sf_dir), fixture_params()


def _plan(spark, sf_dir, **kw):
    from .plans.demand import DemandPlan

    t, p = _ctx(spark, sf_dir)
    kw.setdefault("materialize_stages", True)
    return DemandPlan(t, p, **kw)


def _lazy(spark, sf_dir):
    """For reports and scalars that read each stage once: nothing is landed."""
    return _plan(spark, sf_dir, materialize_stages=False)


# -- S: sources ----------------------------------------------------------------------


@register("sales_detail")
def q_sales_detail(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return rnd(X.sales_detail(t, p))


@register("channel_codes")
def q_channel_codes(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    cc = X.channel_codes(t, p)
    return cc.join(F.broadcast(t.dim_channels), cc.EsquemaID == F.col("Id")).select("ClienteClave", "EsquemaID", "Nombre")


@register("visit_sequence")
def q_visit_sequence(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return X.visit_sequence(t, p)


@register("visit_log")
def q_visit_log(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return X.visit_log(t, p)


@register("product_units")
def q_product_units(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return X.product_units(t)


@register("active_routes")
def q_active_routes(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return X.active_routes(t, p)


@register("sales_history")
def q_sales_history(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return rnd(X.sales_history(t, p))


@register("unit_litres")
def q_unit_litres(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return X.unit_litres(t)


@register("agenda")
def q_agenda(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return X.agenda(t, p)


@register("preview")
def q_preview(spark, sf_dir):
    t, _ = _ctx(spark, sf_dir)
    return X.preview(t.client_channel, 100, ["ClienteClave", "EsquemaID"])


# -- F / G1 / G2: calendar and cleaning ---------------------------------------------


@register("calendar")
def q_calendar(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    s = C.sales(t, p)
    return s.select("Fecha", "Mes", "Year", "Dia", "Semana").distinct()


@register("day_totals")
def q_day_totals(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    return rnd(C.day_totals(C.sales(t, p)))


@register("p95_sales")
def q_p95_sales(spark, sf_dir):
    st = _plan(spark, sf_dir).stages
    return rnd(st.p_sales.withColumn("p_value", F.lit(st.p_value)))


@register("zscore_client")
def q_zscore_client(spark, sf_dir):
    from .operators.stats import zscore

    dp = _plan(spark, sf_dir)
    st, p = dp.stages, dp.p
    z = zscore(st.p_sales, "Venta_Total_dia", ["ClienteClave"], "Valor_Z_general", p.z_single, hot=not st.together, together=st.together)
    return rnd(z.select("ClienteClave", "Fecha", "Venta_Total_dia", "Valor_Z_general").distinct())


@register("zscore_merged")
def q_zscore_merged(spark, sf_dir):
    """The client z-scores from four merged states, each of the lines of one quarter of a year."""
    from .operators.merged import merged_zscore

    dp = _plan(spark, sf_dir)
    st, p = dp.stages, dp.p
    parts = [F.quarter("Fecha") == q for q in range(1, 5)]
    z = merged_zscore(st.p_sales, parts, "Venta_Total_dia", ["ClienteClave"], "Valor_Z_general", p.z_single)
    return rnd(z.select("ClienteClave", "Fecha", "Venta_Total_dia", "Valor_Z_general").distinct())


@register("clean_sales")
def q_clean_sales(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).stages.clean)


@register("retention")
def q_retention(spark, sf_dir):
    from .plans.report import retention

    return rnd(retention(_plan(spark, sf_dir).stages))


@register("visit_durations")
def q_visit_durations(spark, sf_dir):
    t, p = _ctx(spark, sf_dir)
    v, q = C.visit_durations(X.visit_log(t, p), p)
    return rnd(v.withColumn("p_value", F.lit(q)))


# -- G3-G17 through the lazily staged plan ----------------------------------------------


@register("num_weeks")
def q_num_weeks(spark, sf_dir):
    from .functions.calendar import weeks_between

    dp = _lazy(spark, sf_dir)
    return dp.sales.agg(weeks_between(F.min("Fecha"), F.max("Fecha")).alias("num_semanas"))


@register("weekly_visits")
def q_weekly_visits(spark, sf_dir):
    return _lazy(spark, sf_dir).weekly_visits


@register("weekday_codes")
def q_weekday_codes(spark, sf_dir):
    from .plans.dataset import weekday_codes

    return weekday_codes(_plan(spark, sf_dir).seq)


@register("visit_plan")
def q_visit_plan(spark, sf_dir):
    return _plan(spark, sf_dir).visit_plan


@register("client_weekday_stats")
def q_client_weekday_stats(spark, sf_dir):
    from .plans.dataset import client_weekday_stats

    return rnd(client_weekday_stats(_plan(spark, sf_dir).stages))


@register("client_weekday_stats_train")
def q_client_weekday_stats_train(spark, sf_dir):
    from .plans.model import ROW_KEY, hash_split

    dp = _plan(spark, sf_dir, train_means=True)
    return rnd(hash_split(dp.daily, ROW_KEY, dp.p).select(*ROW_KEY, "split", "Venta_media_por_dia", "Venta_mediana_por_dia", "Venta_media_plan"))


@register("daily_dataset")
def q_daily_dataset(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).daily)


@register("bands")
def q_bands(spark, sf_dir):
    b = _plan(spark, sf_dir).bands
    return rnd(b.daily.withColumns({"q1": F.lit(b.q1), "q2": F.lit(b.q2), "q3": F.lit(b.q3)}))


@register("band_mode")
def q_band_mode(spark, sf_dir):
    from .operators.stats import group_mode

    return group_mode(_plan(spark, sf_dir).bands.daily, ["ClienteClave", "Dia"], "Categoria")


@register("warm_plan")
def q_warm_plan(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).split.warm)


@register("cold_clients")
def q_cold_clients(spark, sf_dir):
    return _plan(spark, sf_dir).split.cold


@register("client_attrs")
def q_client_attrs(spark, sf_dir):
    return _lazy(spark, sf_dir).client_attrs


@register("curve_grid")
def q_curve_grid(spark, sf_dir):
    from .plans import curves

    dp = _plan(spark, sf_dir)
    w0, w1 = dp.week_range
    return rnd(curves.curve_grid(dp.daily, w0, w1))


@register("curve_filled")
def q_curve_filled(spark, sf_dir):
    from .plans import curves

    dp = _plan(spark, sf_dir)
    w0, w1 = dp.week_range
    return rnd(curves.curve_filled(curves.curve_grid(dp.daily, w0, w1)))


@register("curve_smooth")
def q_curve_smooth(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).curves)


@register("curve_forecast")
def q_curve_forecast(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).curve_forecast)


@register("forecast_union")
def q_forecast_union(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).forecast)


@register("weekly_forecast")
def q_weekly_forecast(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).weekly)


@register("day_mix")
def q_day_mix(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).day_mix)


@register("mix_clean")
def q_mix_clean(spark, sf_dir):
    from .plans import mix

    dp = _plan(spark, sf_dir)
    return rnd(mix.mix_clean(dp.stages.p_sales, dp.p, dp.together).select(
        "UNE", "ClienteClave", "ProductoClave", "Fecha", "TransProdID", "TransProdDetalleID", "KgLts_Total", "Valor_Z"))


@register("mix_median")
def q_mix_median(spark, sf_dir):
    from .plans import mix

    dp = _plan(spark, sf_dir)
    return rnd(mix.mix_median(dp.stages.p_sales, dp.p, dp.together))


@register("product_mix")
def q_product_mix(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).mix_long)


@register("cluster_mix")
def q_cluster_mix(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).cluster_mix)


@register("running_share")
def q_running_share(spark, sf_dir):
    from .operators.stats import running_share
    from .plans import mix

    dp = _plan(spark, sf_dir)
    j = mix.blended(dp.day_mix, dp.mix_long, dp.assignments, dp.p)
    allr = j.unionByName(mix.unblended_clients(dp.day_mix, j))
    return rnd(running_share(allr, "ClienteClave", "Porcentaje", "ProductoClave", "Agg"))


@register("unblended_clients")
def q_unblended_clients(spark, sf_dir):
    from .plans import mix

    dp = _plan(spark, sf_dir)
    j = mix.blended(dp.day_mix, dp.mix_long, dp.assignments, dp.p)
    return rnd(mix.unblended_clients(dp.day_mix, j))


@register("blend")
def q_blend(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).blend)


@register("blend_new_products")
def q_blend_new_products(spark, sf_dir):
    dp = _plan(spark, sf_dir)
    dp.p = dp.p.with_(allow_new_products=True)
    return rnd(dp.blend)


@register("day_volume")
def q_day_volume(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).day_volume)


@register("unit_min")
def q_unit_min(spark, sf_dir):
    return _plan(spark, sf_dir).unit_min


@register("pieces")
def q_pieces(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).pieces)


@register("route_load")
def q_route_load(spark, sf_dir):
    return rnd(_plan(spark, sf_dir).route_load)


@register("crate_round")
def q_crate_round(spark, sf_dir):
    from .functions.scalar import safe_div, threshold_round

    dp = _plan(spark, sf_dir)
    g = dp.pieces.groupBy("UNE", "Ruta", "ProductoClave", "Dia").agg(F.sum("Piezas").alias("Piezas"))
    g = g.withColumn("Material", F.col("ProductoClave").cast("int")).join(dp.t.dim_crates, "Material")
    x = safe_div("Piezas", "Unidad_de_Carga")
    return rnd(g.select("UNE", "Ruta", "Material", "Dia", "Piezas", "Unidad_de_Carga",
                        threshold_round(x, dp.p.crate_round_threshold).alias("Rejas")))


@register("plan_totals")
def q_plan_totals(spark, sf_dir):
    rl = _plan(spark, sf_dir).route_load
    return rnd(rl.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Piezas").alias("Piezas"), F.sum("Litros").alias("Litros"),
        F.sum("Rejas").alias("Rejas"), F.sum("Litros_en_rejas").alias("Litros_en_rejas"),
        F.min("Litros_en_rejas").alias("min_litros_en_rejas"), F.max("Litros_en_rejas").alias("max_litros_en_rejas"),
    ))


# -- A1-A7 reports, parse, metrics, compare ----------------------------------------------

HIST_BINS = 20


@register("product_share")
def q_product_share(spark, sf_dir):
    from .plans.report import product_share

    return rnd(product_share(_lazy(spark, sf_dir).sales))


@register("weekly_trend")
def q_weekly_trend(spark, sf_dir):
    from .plans.report import weekly_trend

    return rnd(weekly_trend(_lazy(spark, sf_dir).sales))


@register("weekly_series")
def q_weekly_series(spark, sf_dir):
    """The (week, litres) series that ``write_series`` writes (S14): forecast volume per week of the plan, and sold volume per ISO week."""
    dp = _plan(spark, sf_dir)
    fc = dp.weekly.groupBy("Semana").agg(F.sum("prediccion").alias("Volumen")).withColumn("Serie", F.lit("prediccion"))
    real = dp.sales.groupBy("Semana").agg(F.sum("KgLts_Total").alias("Volumen")).withColumn("Serie", F.lit("real"))
    return rnd(fc.unionByName(real))


@register("client_weekly")
def q_client_weekly(spark, sf_dir):
    from .plans.report import client_weekly

    return rnd(client_weekly(_lazy(spark, sf_dir).sales, ordered=True))


@register("client_weekly_clean")
def q_client_weekly_clean(spark, sf_dir):
    from .plans.report import client_weekly

    return rnd(client_weekly(_plan(spark, sf_dir).stages.clean))


@register("client_weekly_hist")
def q_client_weekly_hist(spark, sf_dir):
    from .plans.report import client_weekly, histogram

    return rnd(histogram(client_weekly(_lazy(spark, sf_dir).sales), "KgLts_Total", HIST_BINS))


@register("describe_weekly")
def q_describe_weekly(spark, sf_dir):
    from .plans.report import client_weekly, describe

    return rnd(describe(client_weekly(_lazy(spark, sf_dir).sales), "KgLts_Total"))


@register("box_stats")
def q_box_stats(spark, sf_dir):
    from .plans.report import cut_box

    return rnd(cut_box(_plan(spark, sf_dir).stages))


@register("channel_box")
def q_channel_box(spark, sf_dir):
    from .plans.report import channel_box

    return rnd(channel_box(_lazy(spark, sf_dir).sales))


@register("channel_trend")
def q_channel_trend(spark, sf_dir):
    from .plans.report import channel_trend

    return rnd(channel_trend(_lazy(spark, sf_dir).sales))


@register("parse_dates")
def q_parse_dates(spark, sf_dir):
    from .functions.calendar import add_calendar, parse_day_first

    t, p = _ctx(spark, sf_dir)
    a = X.agenda(t, p).select("ClienteClave", F.date_format("DiaClave", "dd/MM/yyyy").alias("DiaTexto"))
    a = a.withColumn("Fecha", parse_day_first("DiaTexto"))
    return add_calendar(a, "Fecha")


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    from .plans.model import regression_metrics

    d = _plan(spark, sf_dir).daily
    return rnd(regression_metrics(d, "Venta_Total_dia", "Venta_media_por_dia"))


@register("compare_weekly")
def q_compare_weekly(spark, sf_dir):
    from .plans.report import compare

    dp = _plan(spark, sf_dir)
    d = dp.daily
    fc = d.groupBy("Semana").agg((F.sum("Venta_media_por_dia") * F.lit(dp.p.uplift)).alias("Volumen"))
    ac = d.groupBy("Semana").agg(F.sum("Venta_Total_dia").alias("Volumen"))
    return rnd(compare(fc, ac))


@register("backtest")
def q_backtest(spark, sf_dir):
    from .plans.backtest import backtest

    return rnd(backtest(_plan(spark, sf_dir)).errors())


# -- M: models (rows-only checks; no SQL oracle for fitted models) -------------------------

@lru_cache(maxsize=4)
def _fitted(app: str, sf_dir: str) -> tuple:
    """The plan of a folder with its forecast model and its segments, fitted
    once per session with the plan's own parameters and shared by the queries below."""
    from .plans.mix import mix_vectors
    from .plans.model import fit_gbt, score
    from .plans.segments import fit_segments

    dp = _plan(SparkSession.getActiveSession(), sf_dir)

    @lru_cache(maxsize=1)
    def model():
        return fit_gbt(dp.bands.daily, dp.p)

    @lru_cache(maxsize=1)
    def segments():
        return fit_segments(mix_vectors(dp.mix_long), dp.p)

    dp.forecaster = lambda banded, warm: score(model(), warm)
    dp.segmenter = lambda mix_long, sales: segments().assignments
    return dp, model, segments


def _models(spark, sf_dir):
    return _fitted(spark.sparkContext.applicationId, sf_dir)


@register("features")
def q_features(spark, sf_dir):
    from .plans.model import _prep, feature_pipeline

    dp = _plan(spark, sf_dir)
    d = _prep(dp.bands.daily)
    fm = feature_pipeline().fit(d)
    x = fm.transform(d)
    return x.select("ClienteClave", "Semana", "Dia", F.col("features").cast("string").alias("features"))


@register("features_long")
def q_features_long(spark, sf_dir):
    """The feature vectors in long form: the place and value of every entry that is not 0."""
    from pyspark.ml.functions import vector_to_array

    from .plans.model import _prep, feature_pipeline

    d = _prep(_plan(spark, sf_dir).bands.daily)
    x = feature_pipeline().fit(d).transform(d)
    x = x.select("ClienteClave", F.col("Semana").cast("int").alias("Semana"), F.col("Dia").cast("int").alias("Dia"), F.posexplode(vector_to_array("features")).alias("idx", "valor"))
    return rnd(x.filter("valor <> 0"))


@register("split")
def q_split(spark, sf_dir):
    from .plans.model import ROW_KEY, hash_split

    dp = _plan(spark, sf_dir)
    return hash_split(dp.daily, ROW_KEY, dp.p).select(*ROW_KEY, "split")


@register("gbt_metrics")
def q_gbt_metrics(spark, sf_dir):
    f = _models(spark, sf_dir)[1]()
    return f.metrics.withColumn("n_trees", F.lit(f.n_trees))


@register("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    return _models(spark, sf_dir)[0].warm_forecast


@register("mix_vectors")
def q_mix_vectors(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from .plans.mix import mix_vectors

    v = mix_vectors(_plan(spark, sf_dir).mix_long)
    return rnd(v.select("UNE", "ClienteClave", F.posexplode(vector_to_array("features")).alias("idx", "valor")))


@register("best_k")
def q_best_k(spark, sf_dir):
    return _models(spark, sf_dir)[2]().scores


@register("cluster_assign")
def q_cluster_assign(spark, sf_dir):
    return _models(spark, sf_dir)[0].assignments


@register("cluster_mix_kmeans")
def q_cluster_mix_kmeans(spark, sf_dir):
    return _models(spark, sf_dir)[0].cluster_mix


@register("route_load_model")
def q_route_load_model(spark, sf_dir):
    """End to end with the fitted models: GBT forecast for warm clients and
    k-means segments for the mix blend."""
    return rnd(_models(spark, sf_dir)[0].route_load)


@register("backtest_model")
def q_backtest_model(spark, sf_dir):
    """Rolling origins with the fitted forecast model: a model an origin, with the plan's own parameters."""
    from .plans.backtest import backtest
    from .plans.model import gbt_forecaster

    dp = _plan(spark, sf_dir)
    return rnd(backtest(dp, gbt_forecaster(dp.p)).errors())
