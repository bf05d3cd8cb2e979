"""Plan-level checks: stage counts of FIXTURES.md at sf0.001, domain hand
cases on tiny tables, and agreement with the DuckDB oracle on a subset."""

import datetime as dt
import types

import duckdb
import pytest
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.plans import dataset, load, mix
from cratecast.plans.demand import DemandPlan
from cratecast.sources import extracts
from cratecast.sources.fixtures import Tables

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def plan(spark):
    return DemandPlan(Tables(spark, SF_SMALL), fixture_params(), materialize_stages=True)


def test_stage_counts_sf0001(plan):
    st = plan.stages
    assert st.sales.count() == 4067
    assert round(st.p_value) == 1426
    assert st.p_sales.count() == 3858
    assert st.z_client.count() == 3594
    assert st.clean.count() == 3404
    d = plan.daily
    assert d.count() == 797
    assert d.agg(F.sum("Venta_Total_dia")).first()[0] == pytest.approx(461806)
    assert plan.visit_plan.count() == 611
    sp = plan.split
    assert sp.warm.select("ClienteClave").distinct().count() == 12
    assert sp.cold.count() == 131
    # warm and cold never overlap
    assert sp.warm.join(sp.cold, "ClienteClave").count() == 0


def test_blend_shares_sum_to_one(plan):
    b = plan.blend
    bad = b.groupBy("ClienteClave").agg(F.sum("Porcentaje").alias("s")).filter(F.abs(F.col("s") - 1.0) > 1e-9)
    assert bad.count() == 0


def test_pieces_whole_and_positive(plan):
    pz = plan.pieces
    assert pz.filter((F.col("Piezas") <= 0) | (F.col("Piezas") != F.floor("Piezas"))).count() == 0


def test_filters_never_add_rows(plan):
    st = plan.stages
    assert st.clean.count() <= st.z_client.count() <= st.p_sales.count() <= st.sales.count()


# -- hand cases ---------------------------------------------------------------------------


def test_any_day_cold(spark):
    p = fixture_params()
    planned = spark.createDataFrame([("c1", "D02", 0, 2), ("c1", "D02", 1, 2)], "ClienteClave string, EsquemaID string, Dia int, Visitas_Semanales long")
    banded = spark.createDataFrame([("c1", 0, 10.0, "Bajo")], "ClienteClave string, Dia int, Venta_media_por_dia double, Categoria string")
    sp = dataset.split_clients(planned, banded, p)
    assert sp.warm.count() == 0
    assert [r.ClienteClave for r in sp.cold.collect()] == ["c1"]


def _hist(spark, rows):
    names = [n for _, n in fixture_params().days]
    schema = "ClienteClave string, ProductoClave string, " + ", ".join(f"{n} double" for n in names) + ", Porcentaje double"
    return spark.createDataFrame([(c, pr, *([1.0 / 6] * 6), s) for c, pr, s in rows], schema)


def _empty_mix(spark):
    ml = spark.createDataFrame([], "UNE string, ClienteClave string, ProductoClave string, Porcentaje double")
    asg = spark.createDataFrame([], "UNE string, ClienteClave string, Cluster string")
    return ml, asg


def test_running_share_cut_and_single_product(spark):
    p = fixture_params()
    hist = _hist(spark, [("c", "001", 60.0), ("c", "002", 30.0), ("c", "003", 10.0), ("s", "004", 100.0)])
    ml, asg = _empty_mix(spark)
    fc = spark.createDataFrame([("c",), ("s",)], "ClienteClave string")
    got = {(r.ClienteClave, r.ProductoClave): r.Porcentaje for r in mix.blend(hist, ml, asg, fc, p).collect()}
    assert got[("c", "001")] == pytest.approx(2 / 3)
    assert got[("c", "002")] == pytest.approx(1 / 3)
    assert ("c", "003") not in got
    assert got[("s", "004")] == 1.0


def test_sunday_in_total_not_in_days(spark):
    p = fixture_params()
    rows = [("c", 0, "001", 10.0), ("c", 6, "001", 10.0)]
    ps = spark.createDataFrame(rows, "ClienteClave string, Dia int, ProductoClave string, KgLts_Total double")
    r = mix.day_mix(ps, p).first()
    assert r.Porcentaje == 100.0
    assert r.Lunes == 0.5 and r.Sabado == 0.0


def test_crate_size_zero_dropped(spark):
    p = fixture_params()
    pz = spark.createDataFrame(
        [("D001", "D001R0", "c", "004", "Lunes", 10.0, 40.0), ("D001", "D001R0", "c", "001", "Lunes", 10.0, 10.0)],
        "UNE string, Ruta string, ClienteClave string, ProductoClave string, Dia string, Piezas double, Litros double",
    )
    umin = spark.createDataFrame([("004", 4.0), ("001", 1.0)], "ProductoClave string, KgLts double")
    crates = spark.createDataFrame([(4, 0.0), (1, 6.0)], "Material int, Unidad_de_Carga double")
    out = load.route_load(pz, umin, crates, p).collect()
    assert [r.Material for r in out] == [1]
    assert out[0].Rejas == 2.0  # 10 / 6 = 1.67 -> fraction .67 >= .3 -> 2


def test_two_channels_double_lines(spark):
    p = fixture_params()
    t = types.SimpleNamespace(
        sale_header=spark.createDataFrame(
            [("h1", "c1", "R1", dt.date(2020, 1, 6), 1, 1, 1, 2)],
            "TransProdID string, ClienteClave string, MUsuarioID string, DiaClave date, Tipo int, TipoFaseIntSal int, TipoFase int, TipoMovimiento int",
        ),
        sale_line=spark.createDataFrame(
            [("h1", "d1", "001", 1, 2.0)], "TransProdID string, TransProdDetalleID string, ProductoClave string, TipoUnidad int, Cantidad double"
        ),
        warehouse=spark.createDataFrame([("R1", "D001")], "AlmacenID string, AlmacenPadreid string"),
        client_channel=spark.createDataFrame([("c1", "D02"), ("c1", "D03"), ("c1", "D02X01")], "ClienteClave string, EsquemaID string"),
        product_unit=spark.createDataFrame([("001", 1, 3.0)], "ProductoClave string, PRUTipoUnidad int, KgLts double"),
    )
    s = extracts.sales_detail(t, p).collect()
    assert len(s) == 2 and {r.EsquemaID for r in s} == {"D02", "D03"}
    assert all(r.KgLts_Total == 6.0 for r in s)


# -- oracle agreement on a subset at sf0.001 -----------------------------------------------

ORACLE_KEYS = ["sales_detail", "clean_sales", "daily_dataset", "warm_plan", "curve_smooth", "blend", "route_load", "retention"]


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_oracle_agreement(spark, key):
    import __spark_entry__ as E
    from tools.check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[key])
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    b, bc = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert ac == bc
    assert a == b


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"ClienteClave", "Semana", "Year", "KgLts_Total"}
