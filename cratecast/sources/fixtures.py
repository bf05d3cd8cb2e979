"""Domain tables derived from the driver's star-schema test tables.

The mapping (see FIXTURES.md section 2) turns orders/lineitem/customer/part/
nation/events into the sale header, sale line, route, channel, product-unit,
client, visit-plan, visit-log and agenda tables the plan reads. Every table
is a lazy DataFrame over the Parquet files, so Catalyst prunes columns and
pushes filters into the scans of whatever a query actually uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import CHANNELS
from .schemas import check

# Market segment -> 3-char channel code of the fixture.
SEGMENT_CHANNEL: tuple[tuple[str, str], ...] = (
    ("AUTOMOBILE", "D02"),
    ("BUILDING", "D03"),
    ("FURNITURE", "D06"),
    ("HOUSEHOLD", "D21"),
    ("MACHINERY", "D22"),
)

# Pieces per crate of the fixture materials 1..6 (one is 0).
FIXTURE_CRATES: tuple[tuple[int, float], ...] = ((1, 6.0), (2, 9.0), (3, 12.0), (4, 0.0), (5, 16.0), (6, 24.0))

# Unit types of every product (1 = piece, 2 = pack).
UNIT_TYPES: tuple[int, ...] = (1, 2)

# Suffix that turns a channel code into a 6-char child code (every 10th client).
CHILD_SUFFIX = "X01"


def _pad(c: Column | str, n: int) -> Column:
    return F.lpad(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), n, "0")


def _segment_code(seg: Column) -> Column:
    m = F.create_map(*[F.lit(x) for pair in SEGMENT_CHANNEL for x in pair])
    return m[seg]


class Tables:
    """Lazily built domain tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- helpers over the star schema -------------------------------------------------
    @cached_property
    def routes(self) -> DataFrame:
        """nation -> (UNE, Ruta). 25 rows by definition of the star schema."""
        n = self.raw("nation")
        une = F.concat(F.lit("D00"), (F.col("n_regionkey") + 1).cast("string"))
        return n.select(
            F.col("n_nationkey"),
            une.alias("UNE"),
            F.concat(une, F.lit("R"), F.col("n_nationkey").cast("string")).alias("Ruta"),
        )

    @cached_property
    def client_route(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        # nation has a fixed 25 rows, so the broadcast is bounded
        return c.join(F.broadcast(self.routes), c.c_nationkey == F.col("n_nationkey")).select(
            "c_custkey", "c_mktsegment", "UNE", "Ruta"
        )

    @cached_property
    def product_codes(self) -> DataFrame:
        """distinct p_type -> zero-padded dense rank ('001', ...).

        The rank window runs over the distinct type values only, never over
        the part table itself.
        """
        from pyspark.sql import Window as W

        types = self.raw("part").select("p_type").distinct()
        return types.select(
            "p_type",
            _pad(F.dense_rank().over(W.orderBy("p_type")), 3).alias("ProductoClave"),
        )

    # -- domain tables ------------------------------------------------------------------
    @cached_property
    def sale_header(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        cr = self.client_route.select("c_custkey", "Ruta")
        h = o.join(cr, o.o_custkey == cr.c_custkey)
        return check(
            "sale_header",
            h.select(
                _pad("o_orderkey", 12).alias("TransProdID"),
                F.col("o_custkey").cast("string").alias("ClienteClave"),
                F.col("Ruta").alias("MUsuarioID"),
                F.col("o_orderdate").cast("date").alias("DiaClave"),
                F.lit(1).alias("Tipo"),
                F.lit(1).alias("TipoFaseIntSal"),
                F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("TipoFase"),
                F.lit(2).alias("TipoMovimiento"),
            ),
        )

    @cached_property
    def sale_line(self) -> DataFrame:
        li = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
        )
        part = self.raw("part").select("p_partkey", "p_type", "p_retailprice").join(self.product_codes, "p_type")
        sup = self.raw("supplier").select("s_suppkey", "s_nationkey")
        sup = sup.join(F.broadcast(self.routes), sup.s_nationkey == F.col("n_nationkey")).select(
            "s_suppkey", F.col("Ruta").alias("MUsuarioID")
        )
        x = li.join(part, li.l_partkey == part.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
        detail = F.concat_ws(
            "-",
            _pad("l_linenumber", 3),
            _pad("l_partkey", 12),
            _pad("l_suppkey", 12),
            _pad(F.col("l_quantity").cast("bigint"), 6),
        )
        return check(
            "sale_line",
            x.select(
                _pad("l_orderkey", 12).alias("TransProdID"),
                detail.alias("TransProdDetalleID"),
                F.col("ProductoClave"),
                (F.lit(1) + F.col("l_linenumber") % 2).cast("int").alias("TipoUnidad"),
                F.col("l_quantity").alias("Cantidad"),
                F.col("p_retailprice").alias("Precio"),
                F.col("l_extendedprice").alias("Total"),
                F.col("l_shipdate").alias("MFechaHora"),
                F.col("MUsuarioID"),
            ),
        )

    @cached_property
    def warehouse(self) -> DataFrame:
        return check(
            "warehouse",
            self.routes.select(F.col("Ruta").alias("AlmacenID"), F.col("UNE").alias("AlmacenPadreid")),
        )

    @cached_property
    def client_channel(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_mktsegment")
        code = _segment_code(F.col("c_mktsegment"))
        main = c.select(F.col("c_custkey").cast("string").alias("ClienteClave"), code.alias("EsquemaID"))
        child = c.filter(F.col("c_custkey") % 10 == 0).select(
            F.col("c_custkey").cast("string").alias("ClienteClave"),
            F.concat(code, F.lit(CHILD_SUFFIX)).alias("EsquemaID"),
        )
        return check("client_channel", main.unionByName(child))

    @cached_property
    def product_unit(self) -> DataFrame:
        u = F.explode(F.array(*[F.lit(t) for t in UNIT_TYPES])).alias("PRUTipoUnidad")
        x = self.product_codes.select("ProductoClave", u)
        kg = (F.col("ProductoClave").cast("int") * F.col("PRUTipoUnidad")).cast("double")
        return check("product_unit", x.select("ProductoClave", "PRUTipoUnidad", kg.alias("KgLts")))

    @cached_property
    def product_detail(self) -> DataFrame:
        u = F.explode(F.array(*[F.lit(t) for t in UNIT_TYPES])).alias("PRUTipoUnidad")
        x = self.product_codes.select("ProductoClave", u)
        return check(
            "product_detail",
            x.select("ProductoClave", "PRUTipoUnidad", F.col("PRUTipoUnidad").cast("double").alias("Factor")),
        )

    @cached_property
    def client(self) -> DataFrame:
        cr = self.client_route
        return check(
            "client",
            cr.select(
                F.col("c_custkey").cast("string").alias("ClienteClave"),
                F.when(F.col("c_custkey") % 20 == 19, 0).otherwise(1).alias("TipoEstado"),
                F.col("UNE").alias("AlmacenID"),
            ),
        )

    @cached_property
    def sequence(self) -> DataFrame:
        o = self.raw("orders").select("o_custkey", "o_orderpriority").distinct()
        cr = self.client_route.select("c_custkey", "Ruta")
        x = o.join(cr, o.o_custkey == cr.c_custkey)
        code = F.when(
            (F.col("o_custkey") % 50 == 0) & (F.col("o_orderpriority") == "5-LOW"), F.lit(None).cast("string")
        ).otherwise(F.col("o_orderpriority"))
        return check(
            "sequence",
            x.select(
                F.col("o_custkey").cast("string").alias("ClienteClave"),
                code.alias("FrecuenciaClave"),
                F.col("Ruta").alias("RUTClave"),
            ),
        )

    @cached_property
    def visit(self) -> DataFrame:
        e = self.raw("events").select("user_id", "ts")
        v = e.groupBy("user_id", F.col("ts").cast("date").alias("DiaClave")).agg(
            F.min("ts").alias("FechaHoraInicial"), F.max("ts").alias("FechaHoraFinal")
        )
        cr = self.client_route.select("c_custkey", "Ruta")
        v = v.join(cr, v.user_id == cr.c_custkey)
        return check(
            "visit",
            v.select(
                F.col("user_id").cast("string").alias("ClienteClave"),
                "DiaClave",
                "FechaHoraInicial",
                "FechaHoraFinal",
                F.col("Ruta").alias("RUTClave"),
            ),
        )

    @cached_property
    def agenda(self) -> DataFrame:
        o = self.raw("orders").select(
            F.col("o_orderdate").cast("date").alias("DiaClave"), "o_custkey", "o_orderpriority"
        ).distinct()
        cr = self.client_route.select("c_custkey", "UNE", "Ruta")
        x = o.join(cr, o.o_custkey == cr.c_custkey)
        return check(
            "agenda",
            x.select(
                "DiaClave",
                F.col("Ruta").alias("VendedorId"),
                F.col("o_orderpriority").alias("FrecuenciaClave"),
                F.col("Ruta").alias("RUTClave"),
                F.col("o_custkey").cast("string").alias("ClienteClave"),
                F.col("UNE").alias("ClaveCEDI"),
            ),
        )

    @cached_property
    def dim_channels(self) -> DataFrame:
        return check("dim_channels", self.spark.createDataFrame(list(CHANNELS), "Id string, Nombre string"))

    @cached_property
    def dim_crates(self) -> DataFrame:
        return check(
            "dim_crates",
            self.spark.createDataFrame(list(FIXTURE_CRATES), "Material int, Unidad_de_Carga double"),
        )
