"""The whole demand plan as lazily built stages.

``DemandPlan(tables, params)`` exposes each stage as a property; nothing
runs until a stage (or a scalar it needs: a quantile, the week range) is
asked for. ``materialize_stages`` lands what is read more than once (day
totals, kept lines, the daily set, the weekly forecast) as Parquet tables in
the cluster's checkpoint folder, so the loss of an executor late in the plan
does not replay the whole lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import first_by
from ..params import PlanParams
from ..sources import extracts
from . import clean, curves, dataset, load, mix


class DemandPlan:
    def __init__(self, tables, p: PlanParams, forecaster=None, segmenter=None, materialize_stages: bool = False, codes: DataFrame | None = None, train_means: bool = False):
        self.t = tables
        self.p = p
        self.forecaster = forecaster    # callable(daily_banded, warm) -> warm with 'prediccion'
        self.segmenter = segmenter      # callable(vectors long form, sales) -> (UNE, ClienteClave, Cluster)
        self.codes = codes              # (FrecuenciaClave, Dia), or None: by the codes' order
        self.train_means = train_means  # weekday means of training days only, a row's own left out
        self._mat = materialize_stages
        self._tables: list[str] = []    # landed by this plan

    def _m(self, df: DataFrame, name: str = "stage", by: tuple[str, ...] = (), then=None) -> DataFrame:
        if not self._mat:
            return df
        from ..session import joins_where_stored, land_table

        if self.together:
            with joins_where_stored(self.t.spark):  # no client is hot
                out, table = land_table(df, name, by, then)
        else:
            out, table = land_table(df, name)
        self._tables.append(table)
        return out

    def release(self) -> None:
        """Drop the tables this plan has landed, with their files. Stages already handed out can then not be read any more."""
        from ..session import drop_tables

        drop_tables(self.t.spark, self._tables)
        self._tables.clear()

    @cached_property
    def together(self) -> bool:
        """Lines are stored by client: stages are landed and no client is hot."""
        return self._mat and not clean.hot_client(self.t, self.p, int(self.t.spark.conf.get("spark.sql.shuffle.partitions")))

    def _c(self, df: DataFrame) -> DataFrame:
        """Lazy cache for small tables read several times by one plan (no
        extra job; recomputed from lineage if an executor is lost)."""
        if not self._mat:
            return df
        from pyspark import StorageLevel

        return df.persist(StorageLevel.MEMORY_AND_DISK)

    # -- extracts ---------------------------------------------------------------------
    @cached_property
    def lines(self) -> DataFrame:
        # stored by client with their day total, the lines serve every client-keyed stage without another exchange;
        # with a hot client they stay lazy, and the day totals and the kept lines are landed
        s = clean.sales(self.t, self.p)
        return self._m(s, "sales", by=(clean.CLIENT,), then=clean.with_day_total) if self.together else s

    @cached_property
    def sales(self) -> DataFrame:
        return self.lines.drop(clean.TOTAL)

    @cached_property
    def seq(self) -> DataFrame:
        # read by the weekly visits, the plan days and the visit plan
        return self._c(extracts.visit_sequence(self.t, self.p))

    @cached_property
    def units(self) -> DataFrame:
        return extracts.product_units(self.t)

    # -- cleaning ---------------------------------------------------------------------
    @cached_property
    def stages(self) -> clean.CleanStages:
        return clean.clean_sales(self.lines, self.p, lambda df, name: self._m(df, name, by=(clean.CLIENT,)), self.together)

    @cached_property
    def client_attrs(self) -> DataFrame:
        """First (route, unit) per client in line order."""
        return first_by(self.sales, ["ClienteClave"], dataset.LINE_ORDER, ["Ruta", "UNE"])

    # -- dataset ----------------------------------------------------------------------
    @cached_property
    def n_weeks(self) -> int | None:
        return dataset.num_weeks(self.sales)

    @cached_property
    def weekly_visits(self) -> DataFrame:
        return dataset.weekly_visits(self.seq, self.n_weeks)

    @cached_property
    def plan_days(self) -> DataFrame:
        return dataset.plan_days(self.seq, self.codes)

    @cached_property
    def visit_plan(self) -> DataFrame:
        return dataset.visit_plan(self.seq, self.codes)

    @cached_property
    def daily(self) -> DataFrame:
        return self._m(dataset.daily_dataset(self.stages, self.weekly_visits, self.train_means, self._m), "daily")

    @cached_property
    def bands(self) -> dataset.Bands:
        return dataset.bands(self.daily)

    @cached_property
    def split(self) -> dataset.Split:
        sp = dataset.split_clients(self.visit_plan, self.bands.daily, self.p)
        if self._mat:
            # warm and cold both derive from the planned rows: cut once
            return dataset.split_from_planned(self._c(sp.planned), self.p)
        return sp

    # -- curves -----------------------------------------------------------------------
    @cached_property
    def week_range(self) -> tuple[int, int]:
        return curves.week_range(self.sales)

    @cached_property
    def curves(self) -> DataFrame:
        w0, w1 = self.week_range
        return curves.demand_curves(self.daily, w0, w1, self.p)

    @cached_property
    def curve_forecast(self) -> DataFrame:
        return curves.curve_forecast(self.split.cold, self.curves, self.plan_days, self.p)

    # -- forecast ---------------------------------------------------------------------
    @cached_property
    def warm_forecast(self) -> DataFrame:
        w = self.split.warm
        if self.forecaster is None:
            # stand-in: the client's mean day total for that weekday
            return w.withColumn("prediccion", F.col("Venta_media_por_dia"))
        return self.forecaster(self.bands.daily, w)

    @cached_property
    def forecast(self) -> DataFrame:
        return load.combine(self.warm_forecast, self.curve_forecast, self.p)

    @cached_property
    def weekly(self) -> DataFrame:
        return self._m(load.weekly_forecast(self.forecast, self.client_attrs), "weekly")

    # -- product mix ------------------------------------------------------------------
    @cached_property
    def day_mix(self) -> DataFrame:
        # read by both sides of the blend
        return self._m(mix.day_mix(self.stages.p_sales, self.p), "day_mix", by=(clean.CLIENT,))

    @cached_property
    def mix_long(self) -> DataFrame:
        return self._m(mix.product_mix(self.stages.p_sales, self.p, self.together), "mix", by=(clean.CLIENT,))

    @cached_property
    def assignments(self) -> DataFrame:
        if self.segmenter is None:
            # read by the centres and by every client's blend
            return self._m(mix.channel_segments(self.mix_long, self.sales), "segments", by=(clean.CLIENT,))
        return self.segmenter(self.mix_long, self.sales)

    @cached_property
    def cluster_mix(self) -> DataFrame:
        return mix.cluster_mix(self.mix_long, self.assignments)

    @cached_property
    def blend(self) -> DataFrame:
        # clients of the (materialised) weekly forecast: the same set as the
        # forecast's clients among those with a historical mix
        profile = mix.segment_days(self.stages.p_sales, self.assignments, self.p) if self.p.allow_new_products else None
        return mix.blend(self.day_mix, self.mix_long, self.assignments, self.weekly, self.p, profile)

    # -- pieces and crates ------------------------------------------------------------
    @cached_property
    def unit_min(self) -> DataFrame:
        return load.unit_min(self.units)

    @cached_property
    def day_volume(self) -> DataFrame:
        return load.day_volume(self.weekly, self.blend, self.p)

    @cached_property
    def pieces(self) -> DataFrame:
        return load.pieces(self.day_volume, self.unit_min, self.p)

    @cached_property
    def route_load(self) -> DataFrame:
        return load.route_load(self.pieces, self.unit_min, self.t.dim_crates, self.p)
