"""Sales cleaning (G1) and visit durations.

G1: p-quantile cut on the client-day total, then a two-sided z band per
client (on the day total, over lines) and per (client, product) (on line
litres). The day total is aggregated once per (client, day) and joined back;
the quantile is taken on that aggregated table weighted by its line count,
which equals the quantile over lines but scans far fewer rows.
"""

from __future__ import annotations

import copy
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import add_calendar
from ..functions.scalar import clamp_seconds
from ..operators.quantile import exact_quantile, quantile_cut
from ..operators.stats import band_filter, zscore
from ..params import PlanParams
from ..sources import extracts

CLIENT, DAY, PRODUCT = "ClienteClave", "Fecha", "ProductoClave"
TOTAL = "Venta_Total_dia"


def sales(t, p: PlanParams) -> DataFrame:
    """Sales detail with calendar columns."""
    return add_calendar(extracts.sales_detail(t, p), "Fecha", p.iso_year)


def day_totals(s: DataFrame) -> DataFrame:
    """(client, day) -> day total and number of lines."""
    return s.groupBy(CLIENT, DAY).agg(_litres().alias("Venta_Total_dia"), F.count(F.lit(1)).alias("n_lines"))


def _litres(over=None) -> Column:
    """Sum of line litres, which have three places: summed as whole thousandths, the same in any order."""
    s = F.sum(F.rint(F.col("KgLts_Total") * 1000).cast("long"))
    return (s.over(over) if over is not None else s) / 1000.0


def with_day_total(s: DataFrame) -> DataFrame:
    """The lines with their day total, for lines that are dealt or stored by client; they come out in order of client and day."""
    return s if TOTAL in s.columns else s.withColumn(TOTAL, _litres(W.partitionBy(CLIENT, DAY)))


def hot_client(t, p: PlanParams, parts: int) -> bool:
    """Whether a client holds more than twice an equal part of the sales headers, of ``parts`` parts.

    One combined count per client; then its rows must be split over tasks, and
    storing the lines by client would put them into one."""
    h = t.sale_header.filter(F.col("DiaClave").between(F.lit(p.start), F.lit(p.end))).groupBy(CLIENT).agg(F.count(F.lit(1)).alias("n"))
    most, total = h.agg(F.max("n"), F.sum("n")).first()
    return most is not None and most * parts > 2 * total


class CleanStages:
    """The stages of the cleaning; ``land`` (or nothing) cuts the lineage of those read more than once.

    ``together``: the lines are stored by client and no client is hot. Day
    totals are then on the stored lines (or a window over them) and z-scores are
    windows, and nothing is exchanged, joined or landed but the day totals."""

    def __init__(self, s: DataFrame, p: PlanParams, land=None, together: bool = False):
        self.p, self._land, self.together = p, land or (lambda df, name: df), together
        self._tap = lambda name, df: df
        self.sales = s                                              # every extracted line, with calendar
        self.day_totals = self._land(day_totals(s), "day_totals")   # (client, day, total, lines) before the cut

    @cached_property
    def p_value(self) -> float | None:
        """The quantile of the day total over lines."""
        return exact_quantile(self.day_totals, "Venta_Total_dia", self.p.p_cut, weight="n_lines")

    @cached_property
    def kept_days(self) -> DataFrame:
        """(client, day, total) strictly below the quantile."""
        return self.day_totals.filter(F.col("Venta_Total_dia") < F.lit(self.p_value)).select(CLIENT, DAY, "Venta_Total_dia")

    @cached_property
    def p_sales(self) -> DataFrame:
        """Lines of the kept days."""
        if self.together:
            return self._tap("n_p", with_day_total(self.sales).filter(F.col(TOTAL) < F.lit(self.p_value)))
        return self._tap("n_p", self._land(self.sales.join(self.kept_days, [CLIENT, DAY]), "p_sales"))

    @cached_property
    def z_client(self) -> DataFrame:
        """After the client z band."""
        # in the order of client and product, one sort serves the windows of both z bands
        x = self.p_sales.sortWithinPartitions(CLIENT, PRODUCT) if self.together else self.p_sales
        z = zscore(x, "Venta_Total_dia", [CLIENT], "Valor_Z_general", self.p.z_single, hot=not self.together, together=self.together)
        return self._tap("n_z_client", band_filter(z, "Valor_Z_general", self.p.z_lo, self.p.z_hi))

    @cached_property
    def clean(self) -> DataFrame:
        """After the (client, product) z band."""
        z = zscore(self.z_client, "KgLts_Total", [CLIENT, PRODUCT], "Valor_Z_detalle", self.p.z_single, hot=not self.together, together=self.together)
        return self._tap("n_clean", band_filter(z, "Valor_Z_detalle", self.p.z_lo, self.p.z_hi))

    def tapped(self, tap) -> CleanStages:
        """The same stages, each passed through tap(name of its row count, stage); the quantile is not searched again."""
        self.p_value
        x = copy.copy(self)
        for stage in ("p_sales", "z_client", "clean"):
            x.__dict__.pop(stage, None)
        x._tap = tap
        x.sales = tap("n_sales", self.sales)
        return x


def clean_sales(s: DataFrame, p: PlanParams, land=None, together: bool = False) -> CleanStages:
    return CleanStages(s, p, land, together)


def visit_durations(log: DataFrame, p: PlanParams) -> tuple[DataFrame, float | None]:
    """Visit seconds (end - start, clamped at 0) with calendar columns, cut at
    ``<=`` the p-quantile of the seconds."""
    v = log.select(
        CLIENT,
        "DiaClave",
        clamp_seconds("FechaHoraInicial", "FechaHoraFinal").alias("Visita_seg"),
    )
    v = add_calendar(v, "DiaClave", p.iso_year)
    return quantile_cut(v, "Visita_seg", p.visit_p_cut, strict=False)


__all__ = ["sales", "day_totals", "clean_sales", "visit_durations", "CleanStages"]
