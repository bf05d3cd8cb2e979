"""Forecast union and weekly totals (G10, G11), day volumes (G15), pieces
(G16) and route crate loads (G17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import code_to_int, half_even, safe_div, threshold_round
from ..operators.reshape import melt_days
from ..operators.stats import min_row_by
from ..params import PlanParams

CLIENT, PRODUCT = "ClienteClave", "ProductoClave"
FC_COLS = ["ClienteClave", "EsquemaID", "Semana", "Dia", "Visitas_Semanales", "prediccion"]
WEEK_KEYS = ["ClienteClave", "UNE", "Ruta", "EsquemaID", "Semana", "Visitas_Semanales"]


def combine(warm: DataFrame, cold: DataFrame, p: PlanParams) -> DataFrame:
    """Warm (model) and cold (curve) day forecasts, times the uplift."""
    u = warm.select(*FC_COLS).unionByName(cold.select(*FC_COLS))
    return u.withColumn("prediccion", F.col("prediccion") * F.lit(p.uplift))


def weekly_forecast(fc: DataFrame, attrs: DataFrame) -> DataFrame:
    """Sum of day forecasts per client week with unit and route.

    Rows with a NULL key are dropped; an all-NULL sum is 0 (pandas' rule)."""
    x = fc.join(attrs, CLIENT)
    x = x.filter(F.greatest(*[F.col(k).isNull() for k in WEEK_KEYS]) == F.lit(False))
    return x.groupBy(*WEEK_KEYS).agg(F.coalesce(F.sum("prediccion"), F.lit(0.0)).alias("prediccion"))


def day_volume(weekly: DataFrame, blend: DataFrame, p: PlanParams) -> DataFrame:
    """Weekly litres x product share, then x weekday fraction."""
    x = weekly.join(blend, CLIENT, "left")
    x = x.withColumn("Porcentaje", F.col("prediccion") * F.col("Porcentaje"))
    x = x.withColumns({name: F.col(name) * F.col("Porcentaje") for _, name in p.days})
    return x.drop("prediccion")


def unit_min(units: DataFrame) -> DataFrame:
    """Litres per piece of each product's smallest unit type."""
    return min_row_by(units, PRODUCT, "PRUTipoUnidad", ["KgLts"]).select(PRODUCT, "KgLts")


def pieces(vol: DataFrame, umin: DataFrame, p: PlanParams) -> DataFrame:
    """Weekday litres -> whole pieces (half-even) and their litres, days
    without pieces dropped (R3, F11, F12, P14)."""
    names = [name for _, name in p.days]
    m = melt_days(vol, ["UNE", "Ruta", CLIENT, PRODUCT], names)
    x = m.join(umin, PRODUCT)
    pz = F.ceil(half_even(safe_div("Total", "KgLts"), 0, p.share_decimals)).cast("double")
    x = x.withColumn("Piezas", pz).withColumn("Litros", F.col("Piezas") * F.col("KgLts"))
    return x.filter(F.col("Piezas") > 0).select("UNE", "Ruta", CLIENT, PRODUCT, "Dia", "Piezas", "Litros")


def route_load(pz: DataFrame, umin: DataFrame, crates: DataFrame, p: PlanParams) -> DataFrame:
    """Pieces and litres per (unit, route, material, weekday) and the crates
    they fill, rounded up from ``crate_round_threshold``; materials with 0
    pieces per crate drop out (F13, F16, A16)."""
    g = pz.groupBy("UNE", "Ruta", PRODUCT, "Dia").agg(F.sum("Piezas").alias("Piezas"), F.sum("Litros").alias("Litros"))
    g = g.join(umin, PRODUCT).withColumn("Material", code_to_int(F.col(PRODUCT))).filter(F.col("Piezas") > 0)
    g = g.join(crates, "Material")
    rej = threshold_round(safe_div("Piezas", "Unidad_de_Carga"), p.crate_round_threshold)
    g = g.withColumn("Rejas", rej)
    g = g.withColumn("Piezas_en_rejas", F.col("Rejas") * F.col("Unidad_de_Carga"))
    g = g.withColumn("Litros_en_rejas", F.col("KgLts") * F.col("Piezas_en_rejas"))
    g = g.filter(F.col("Litros_en_rejas") > 0)
    return g.select("UNE", "Ruta", "Material", "Dia", "Piezas", "Litros", "Rejas", "Piezas_en_rejas", "Litros_en_rejas")
