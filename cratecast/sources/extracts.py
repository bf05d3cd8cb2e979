"""Source extracts S2-S10: the relational selections the plan starts from.

Each function takes the domain tables (anything with the attributes of
``fixtures.Tables``: a JDBC-backed or Parquet-landed set works the same) and
returns a lazy DataFrame. Filters are plain column predicates so they reach
the scans; small dimension sides are left to AQE, which broadcasts them on
measured size and falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import PlanParams


def channel_codes(t, p: PlanParams) -> DataFrame:
    """Client channel rows whose code has exactly 3 characters (trailing
    blanks ignored, as a SQL Server LEN does) and is in the channel list."""
    cc = t.client_channel.withColumn("EsquemaID", F.rtrim("EsquemaID"))
    return cc.filter((F.length("EsquemaID") == 3) & F.col("EsquemaID").isin(list(p.channels)))


def sales_detail(t, p: PlanParams) -> DataFrame:
    """Sale lines in litres with unit, route, client, channel and product.

    Carries ``TransProdID``/``TransProdDetalleID`` so that later "first row"
    choices have a total order (date, header id, detail id).
    """
    h = t.sale_header.filter(
        (F.col("Tipo") == p.tipo)
        & (F.col("TipoFaseIntSal") == p.tipo_fase_int_sal)
        & (F.col("TipoFase") != 0)
        & (F.col("TipoMovimiento") == p.tipo_movimiento)
        & F.col("DiaClave").between(F.lit(p.start), F.lit(p.end))
    )
    line = t.sale_line.select("TransProdID", "TransProdDetalleID", "ProductoClave", "TipoUnidad", "Cantidad")
    wh = t.warehouse.filter(F.col("AlmacenPadreid").isin(list(p.units)))
    cc = channel_codes(t, p)
    pu = t.product_unit
    x = (
        h.join(line, "TransProdID")
        .join(wh, h.MUsuarioID == wh.AlmacenID)
        .join(cc, "ClienteClave")
        .join(pu, (line.ProductoClave == pu.ProductoClave) & (line.TipoUnidad == pu.PRUTipoUnidad))
    )
    return x.select(
        F.col("DiaClave").alias("Fecha"),
        F.col("AlmacenPadreid").alias("UNE"),
        F.col("AlmacenID").alias("Ruta"),
        "ClienteClave",
        "EsquemaID",
        line.ProductoClave.alias("ProductoClave"),
        F.round(F.col("Cantidad") * F.col("KgLts"), 3).alias("KgLts_Total"),
        "TransProdID",
        "TransProdDetalleID",
    )


def visit_sequence(t, p: PlanParams) -> DataFrame:
    """Visit plan rows of active clients in the units and channels (S3).

    Written as two left joins with the channel filtered afterwards, like the
    source query; Catalyst turns the second one into an inner join.
    """
    c = t.client.filter((F.col("TipoEstado") == 1) & F.col("AlmacenID").isin(list(p.units)))
    seq = t.sequence.select("ClienteClave", "FrecuenciaClave")
    cc = t.client_channel
    x = c.join(seq, "ClienteClave", "left").join(cc, "ClienteClave", "left")
    x = x.filter(F.col("EsquemaID").isin(list(p.channels)))
    return x.select("ClienteClave", "FrecuenciaClave", "EsquemaID")


def visit_log(t, p: PlanParams) -> DataFrame:
    """Visit start/end per client and day in the units, dates and channels."""
    v = t.visit.filter(
        F.substring("RUTClave", 1, 4).isin(list(p.units)) & F.col("DiaClave").between(F.lit(p.start), F.lit(p.end))
    )
    cc = t.client_channel.filter(F.col("EsquemaID").isin(list(p.channels)))
    x = v.join(cc, "ClienteClave")
    return x.select("ClienteClave", "DiaClave", "FechaHoraInicial", "FechaHoraFinal")


def product_units(t) -> DataFrame:
    """Product detail with litres per unit, on (product, unit type)."""
    pd_ = t.product_detail
    pu = t.product_unit
    return pd_.join(pu, ["ProductoClave", "PRUTipoUnidad"]).select("ProductoClave", "PRUTipoUnidad", "Factor", "KgLts")


def active_routes(t, p: PlanParams) -> DataFrame:
    """Distinct routes of the visit plan within the units."""
    seq = t.sequence.select("RUTClave")
    wh = t.warehouse.filter(F.col("AlmacenPadreid").isin(list(p.units)))
    x = seq.join(wh, seq.RUTClave == wh.AlmacenID).select("AlmacenID").distinct()
    return x.withColumn("ID", F.col("AlmacenID").cast("string"))


def sales_history(t, p: PlanParams) -> DataFrame:
    """Line-level sales history with audit columns."""
    line = t.sale_line
    h = t.sale_header
    wh = t.warehouse
    cc = t.client_channel
    x = (
        line.join(h.drop("MUsuarioID"), "TransProdID")
        .join(wh, line.MUsuarioID == wh.AlmacenID)
        .join(cc, "ClienteClave")
    )
    x = x.filter(
        (F.col("Tipo") == p.tipo)
        & (F.col("TipoFaseIntSal") == p.tipo_fase_int_sal)
        & (F.col("TipoFase") != 0)
        & (F.col("TipoMovimiento") == p.tipo_movimiento)
        & F.col("MFechaHora").cast("date").between(F.lit(p.start), F.lit(p.end))
        & F.col("AlmacenPadreid").isin(list(p.units))
        & F.col("EsquemaID").isin(list(p.channels))
    )
    return x.select(
        "TransProdID", "TransProdDetalleID", "ClienteClave", "EsquemaID", "ProductoClave", "TipoUnidad",
        "Cantidad", "Precio", "Total", "MFechaHora", line.MUsuarioID.alias("MUsuarioID"),
        F.col("AlmacenPadreid").alias("AlmacenPadreId"), "Tipo", "TipoFaseIntSal", "TipoFase", "TipoMovimiento",
    )


def unit_litres(t) -> DataFrame:
    """Litres per piece: bare projection."""
    return t.product_unit.select("ProductoClave", "PRUTipoUnidad", "KgLts")


def agenda(t, p: PlanParams) -> DataFrame:
    """Seller agenda by date and depot."""
    a = t.agenda.filter(F.col("ClaveCEDI").isin(list(p.units)) & F.col("DiaClave").between(F.lit(p.start), F.lit(p.end)))
    return a.select("DiaClave", "VendedorId", "FrecuenciaClave", "RUTClave", "ClienteClave", "ClaveCEDI")


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows in an explicit order (S10: the source's TOP n had none)."""
    return df.orderBy(*order_by).limit(n)
