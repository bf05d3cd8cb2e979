"""Product mix: historical day mix (G12), per-unit mix vectors (G13), cluster
centres (A18/M10) and the blend of the two (G14).

All of it runs on aggregated tables whose per-client groups are bounded by
the product catalogue (x 7 weekdays), so per-client windows are safe here.
The blend joins each client's historical products with its segment centre
directly; the dense client x product matrix of the original is never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import safe_div
from ..operators.reshape import pivot_days
from ..operators.stats import band_filter, running_share, share_of_total, zscore
from ..params import PlanParams

CLIENT, PRODUCT = "ClienteClave", "ProductoClave"


def day_mix(p_sales: DataFrame, p: PlanParams) -> DataFrame:
    """Per (client, product): its percent of the client's litres and, per
    named weekday, the fraction of that product's litres sold on that day.

    The pivot is a single conditional aggregation over explicit weekday
    values (no value scan; a weekday with no sales is 0). Sunday has no name
    in ``p.days`` and is therefore not distributed, as in the original."""
    g = pivot_days(p_sales, [CLIENT, PRODUCT], "KgLts_Total", p.days, extra=[F.sum("KgLts_Total").alias("kg")])
    # percent of the client's litres; the weekday fractions are ratios of
    # litre sums (equal to the ratio of summed percents, without their noise)
    g = share_of_total(g, [CLIENT], "kg", "Porcentaje")
    return g.select(CLIENT, PRODUCT, *[safe_div(F.col(name), F.col("kg")).alias(name) for _, name in p.days], "Porcentaje")


def mix_clean(p_sales: DataFrame, p: PlanParams, together: bool = False) -> DataFrame:
    """Lines kept for the mix: z of line litres per (unit, client) <= 2 (Z5, P11); ``together``: as for ``zscore``."""
    z = zscore(p_sales, "KgLts_Total", [CLIENT, "UNE"], "Valor_Z", p.z_single, hot=not together, together=together)
    return band_filter(z, "Valor_Z", hi=p.z_mix)


def mix_median(p_sales: DataFrame, p: PlanParams, together: bool = False) -> DataFrame:
    """Median over observed weeks of the weekly litres per (unit, client, product) (A10)."""
    wk = mix_clean(p_sales, p, together).groupBy("UNE", CLIENT, "Year", "Semana", PRODUCT).agg(F.sum("KgLts_Total").alias("w"))
    return wk.groupBy("UNE", CLIENT, PRODUCT).agg(F.median("w").alias("KgLts_Total"))


def product_mix(p_sales: DataFrame, p: PlanParams, together: bool = False) -> DataFrame:
    """Long-form mix vectors: (unit, client, product, percent of the client's
    summed medians)."""
    return share_of_total(mix_median(p_sales, p, together), ["UNE", CLIENT], "KgLts_Total", "Porcentaje").select(
        "UNE", CLIENT, PRODUCT, "Porcentaje"
    )


def unit_products(mix_long: DataFrame) -> DataFrame:
    """Products of each unit's vector space, with their 0-based position."""
    up = mix_long.select("UNE", PRODUCT).distinct()
    return up.withColumn("idx", (F.row_number().over(W.partitionBy("UNE").orderBy(PRODUCT)) - 1).cast("int"))


def mix_vectors(mix_long: DataFrame) -> DataFrame:
    """Dense vectors per (unit, client) over the unit's products, absent
    products 0 (R2), built JVM-side from the long form."""
    from pyspark.ml.functions import array_to_vector

    up = unit_products(mix_long)
    n = up.groupBy("UNE").agg(F.count(F.lit(1)).cast("int").alias("n"))
    x = mix_long.join(up, ["UNE", PRODUCT])
    g = x.groupBy("UNE", CLIENT).agg(F.map_from_entries(F.collect_list(F.struct("idx", "Porcentaje"))).alias("m"))
    g = g.join(n, "UNE")
    arr = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0)))
    return g.select("UNE", CLIENT, array_to_vector(arr).alias("features"))


def channel_segments(mix_long: DataFrame, sales: DataFrame) -> DataFrame:
    """Stand-in segmentation: each client's cluster is its (smallest) channel."""
    # distinct first, so that a string's minimum does not sort the lines
    ch = sales.select(CLIENT, "EsquemaID").distinct().groupBy(CLIENT).agg(F.min("EsquemaID").alias("Cluster"))
    return mix_long.select("UNE", CLIENT).distinct().join(ch, CLIENT)


def cluster_centres(mix_long: DataFrame, assign: DataFrame) -> DataFrame:
    """Mean member vector per (unit, cluster), dense over the unit's
    products: sum of shares / number of members, so absent products count 0."""
    members = assign.groupBy("UNE", "Cluster").agg(F.count(F.lit(1)).alias("n_members"))
    sums = mix_long.join(assign, ["UNE", CLIENT]).groupBy("UNE", "Cluster", PRODUCT).agg(F.sum("Porcentaje").alias("s"))
    up = unit_products(mix_long).select("UNE", PRODUCT)
    dense = members.join(up, "UNE")  # clusters x products of one unit: bounded by k x catalogue
    c = dense.join(sums, ["UNE", "Cluster", PRODUCT], "left")
    return c.select(
        "UNE", "Cluster", PRODUCT, (F.coalesce(F.col("s"), F.lit(0.0)) / F.col("n_members")).alias("Porcentaje_kmeans")
    )


def cluster_mix(mix_long: DataFrame, assign: DataFrame) -> DataFrame:
    """Recommended mix per client: its cluster's centre (long form)."""
    return assign.join(cluster_centres(mix_long, assign), ["UNE", "Cluster"]).select(
        "UNE", CLIENT, "Cluster", PRODUCT, "Porcentaje_kmeans"
    )


def with_centres(hist: DataFrame, mix_long: DataFrame, assign: DataFrame) -> DataFrame:
    """Historical rows with their segment centre's share, null where the
    product is not in the unit's vector space or the client has no segment."""
    centres = cluster_centres(mix_long, assign)
    return hist.join(assign, CLIENT, "left").join(centres, ["UNE", "Cluster", PRODUCT], "left").drop("UNE", "Cluster")


def _mixed(p: PlanParams):
    w = p.blend_weight
    return F.lit(1.0 - w) * F.col("Porcentaje") + F.lit(w) * F.col("Porcentaje_kmeans")


def blended(hist: DataFrame, mix_long: DataFrame, assign: DataFrame, p: PlanParams) -> DataFrame:
    """Historical share blended with the segment centre on the client's
    historical products that exist in its unit's vector space (J11)."""
    j = with_centres(hist, mix_long, assign).filter(F.col("Porcentaje_kmeans").isNotNull())
    return j.withColumn("Porcentaje", _mixed(p)).drop("Porcentaje_kmeans")


def unblended_clients(hist: DataFrame, joined: DataFrame) -> DataFrame:
    """Historical rows of clients that got no blended row."""
    return hist.join(joined.select(CLIENT).distinct(), CLIENT, "left_anti")


def segment_days(p_sales: DataFrame, assign: DataFrame, p: PlanParams) -> DataFrame:
    """Weekday profile of each product in each segment: the part of its litres that the members bought on each named weekday."""
    x = p_sales.select("UNE", CLIENT, PRODUCT, "Dia", "KgLts_Total").join(assign, ["UNE", CLIENT])
    g = pivot_days(x, ["UNE", "Cluster", PRODUCT], "KgLts_Total", p.days, extra=[F.sum("KgLts_Total").alias("kg")])
    return g.select("UNE", "Cluster", PRODUCT, *[safe_div(F.col(name), F.col("kg")).alias(name) for _, name in p.days])


def new_products(hist: DataFrame, mix_long: DataFrame, assign: DataFrame, profile: DataFrame, p: PlanParams) -> DataFrame:
    """(client, product, weekday fractions, share) of products that a client's segment buys and the client never did.

    The share is the segment's, times the weight of segments in the blend; the
    weekday fractions are the segment's. At most the products of the client's
    unit a client: the pairs are what the option asks for, no cross join."""
    centres = cluster_centres(mix_long, assign).filter("Porcentaje_kmeans > 0").join(profile, ["UNE", "Cluster", PRODUCT])
    # clients with a history only: others get no plan to add to
    x = assign.join(hist.select(CLIENT).distinct(), CLIENT, "left_semi").join(centres, ["UNE", "Cluster"])
    x = x.join(hist.select(CLIENT, PRODUCT).distinct(), [CLIENT, PRODUCT], "left_anti")
    return x.select(CLIENT, PRODUCT, *[name for _, name in p.days], (F.lit(p.blend_weight) * F.col("Porcentaje_kmeans")).alias("Porcentaje"))


def outer_blend(hist: DataFrame, mix_long: DataFrame, assign: DataFrame, profile: DataFrame, p: PlanParams) -> DataFrame:
    """History and segment blended over the products of both: (1 - w) * history + w * segment, a side without the product counting 0.

    A client without a segment keeps its history. A product with a history has
    its own weekday fractions, a new one those of its segment."""
    x = with_centres(hist.join(assign.select(CLIENT).distinct().withColumn("_has", F.lit(True)), CLIENT, "left"), mix_long, assign)
    both = F.when(F.col("_has"), F.lit(1.0 - p.blend_weight) * F.col("Porcentaje") + F.lit(p.blend_weight) * F.coalesce("Porcentaje_kmeans", F.lit(0.0)))
    x = x.withColumn("Porcentaje", F.coalesce(both, F.col("Porcentaje"))).drop("Porcentaje_kmeans", "_has")
    return x.unionByName(new_products(hist, mix_long, assign, profile, p))


def blend(hist: DataFrame, mix_long: DataFrame, assign: DataFrame, forecast: DataFrame, p: PlanParams, profile: DataFrame | None = None) -> DataFrame:
    """Blend, then keep products while the running share (largest first) is
    below ``share_cut``; clients left with none keep their top product at
    share 1; kept shares are renormalised to sum 1 (G14, T4). Restricted to
    clients in the forecast.

    One left join to the centres and one set of windows per client, bounded by
    the catalogue (times the client's segments). A client without any blended
    row keeps its historical ones.

    ``profile`` (``segment_days``): blend over the products of both sides
    (``outer_blend``); the cut and the renormalisation then span old and new
    products."""
    per = W.partitionBy(CLIENT)
    if profile is not None:
        x = outer_blend(hist, mix_long, assign, profile, p).join(forecast.select(CLIENT).distinct(), CLIENT, "left_semi")
        return _cut(x, p, per)
    x = with_centres(hist, mix_long, assign).join(forecast.select(CLIENT).distinct(), CLIENT, "left_semi")
    matched = F.col("Porcentaje_kmeans").isNotNull()
    x = x.withColumn("_any", F.max(matched).over(per))
    x = x.withColumn("_again", F.row_number().over(W.partitionBy(CLIENT, PRODUCT).orderBy(F.lit(1))))
    x = x.filter(F.when(F.col("_any"), matched).otherwise(F.col("_again") == 1))
    x = x.withColumn("Porcentaje", F.coalesce(_mixed(p), F.col("Porcentaje"))).drop("Porcentaje_kmeans", "_any", "_again")
    return _cut(x, p, per)


def _cut(x: DataFrame, p: PlanParams, per) -> DataFrame:
    """Products while the running share is below the cut, or the top one, renormalised."""
    x = running_share(x, CLIENT, "Porcentaje", PRODUCT, "_agg")
    kept = F.round("_agg", p.share_decimals) < F.lit(p.share_cut)
    first = F.row_number().over(per.orderBy(F.col("Porcentaje").desc(), F.col(PRODUCT)))
    x = x.withColumns({"_kept": kept, "_first": first}).withColumn("_total", F.sum(F.when(F.col("_kept"), F.col("Porcentaje"))).over(per))
    x = x.filter(F.col("_kept") | (F.col("_total").isNull() & (F.col("_first") == 1)))
    share = F.when(F.col("_kept"), (F.col("Porcentaje") * 100.0 / F.col("_total")) / 100.0).otherwise(F.lit(1.0))
    return x.withColumn("Porcentaje", share).drop("_agg", "_kept", "_first", "_total")
