"""Explicit schemas of the domain tables, checked at load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, I, D, DT, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


SCHEMAS: dict[str, T.StructType] = {
    "sale_header": _st(
        ("TransProdID", S, False), ("ClienteClave", S, False), ("MUsuarioID", S, False),
        ("DiaClave", DT, False), ("Tipo", I, False), ("TipoFaseIntSal", I, False),
        ("TipoFase", I, False), ("TipoMovimiento", I, False),
    ),
    "sale_line": _st(
        ("TransProdID", S, False), ("TransProdDetalleID", S, False), ("ProductoClave", S, False),
        ("TipoUnidad", I, False), ("Cantidad", D, True), ("Precio", D, True), ("Total", D, True),
        ("MFechaHora", TS, True), ("MUsuarioID", S, False),
    ),
    "warehouse": _st(("AlmacenID", S, False), ("AlmacenPadreid", S, False)),
    "client_channel": _st(("ClienteClave", S, False), ("EsquemaID", S, False)),
    "product_unit": _st(("ProductoClave", S, False), ("PRUTipoUnidad", I, False), ("KgLts", D, True)),
    "product_detail": _st(("ProductoClave", S, False), ("PRUTipoUnidad", I, False), ("Factor", D, True)),
    "client": _st(("ClienteClave", S, False), ("TipoEstado", I, False), ("AlmacenID", S, False)),
    "sequence": _st(("ClienteClave", S, False), ("FrecuenciaClave", S, True), ("RUTClave", S, False)),
    "visit": _st(
        ("ClienteClave", S, False), ("DiaClave", DT, False), ("FechaHoraInicial", TS, True),
        ("FechaHoraFinal", TS, True), ("RUTClave", S, False),
    ),
    "agenda": _st(
        ("DiaClave", DT, False), ("VendedorId", S, False), ("FrecuenciaClave", S, True),
        ("RUTClave", S, False), ("ClienteClave", S, False), ("ClaveCEDI", S, False),
    ),
    "dim_channels": _st(("Id", S, False), ("Nombre", S, False)),
    "dim_crates": _st(("Material", I, False), ("Unidad_de_Carga", D, True)),
}


class SchemaError(ValueError):
    pass


def check(name: str, df: DataFrame) -> DataFrame:
    """Assert column names and types of a domain table; reorder columns.

    Nullability is not compared (Parquet readers mark everything nullable);
    ``plans.report.load_checks`` counts the nulls of the non-nullable columns.
    """
    want = SCHEMAS[name]
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in want.fields if f.name not in have]
    if missing:
        raise SchemaError(f"{name}: missing columns {missing}")
    wrong = [(f.name, have[f.name], f.dataType) for f in want.fields if have[f.name] != f.dataType]
    if wrong:
        raise SchemaError(f"{name}: wrong types {wrong}")
    return df.select(*[f.name for f in want.fields])
