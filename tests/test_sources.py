"""Sources and sinks: landing to Parquet and reading back, crate file, plan sink."""

from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.sources import extracts
from cratecast.sources.dims import read_crates, write_plan, write_series
from cratecast.sources.fixtures import Tables
from cratecast.sources.jdbc import JdbcTables, ParquetTables, Slicing, land

from .conftest import SF_SMALL


def test_land_and_read_back(spark, tmp_path):
    t = Tables(spark, SF_SMALL)
    land(t, str(tmp_path / "landed"))
    pt = ParquetTables(spark, str(tmp_path / "landed"), crates=t.dim_crates)
    p = fixture_params()
    a = extracts.sales_detail(t, p)
    b = extracts.sales_detail(pt, p)
    assert a.count() == b.count() == 4067
    assert a.exceptAll(b).count() == 0


def test_crates_file_and_sinks(spark, tmp_path):
    csv = tmp_path / "crates.csv"
    csv.write_text("Material,Unidad de Carga\n1,6.0\n4,0.0\n")
    c = read_crates(spark, str(csv))
    assert sorted(tuple(r) for r in c.collect()) == [(1, 6.0), (4, 0.0)]
    df = spark.createDataFrame([("D001", "R1", 1.0), ("D002", "R2", 2.0)], "UNE string, Ruta string, Rejas double")
    write_plan(df, str(tmp_path / "plan"))
    back = spark.read.parquet(str(tmp_path / "plan"))
    assert back.count() == 2 and set(r.UNE for r in back.select("UNE").collect()) == {"D001", "D002"}
    s = spark.createDataFrame([(21, 1.5)], "Semana int, Volumen double")
    write_series(s, str(tmp_path / "series"))
    assert spark.read.option("header", True).csv(str(tmp_path / "series")).select(F.col("Semana").cast("int")).first()[0] == 21


def test_day_filter_reads_only_those_folders(spark, tmp_path):
    land(Tables(spark, SF_SMALL), str(tmp_path / "landed"))
    h = ParquetTables(spark, str(tmp_path / "landed")).sale_header
    day = h.selectExpr("min(DiaClave) as d").first().d
    plan = h.filter(F.col("DiaClave").between(F.lit(day), F.lit(day)))
    assert "PartitionFilters: [isnotnull(DiaClave" in plan._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count() < h.count()


class StubReader:
    """Takes JDBC options, returns a frame."""

    def __init__(self, df):
        self.df, self.options = df, {}
        self.read = self

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def option(self, k, v):
        self.options[k] = v
        return self

    def load(self):
        return self.df


def test_jdbc_options(spark):
    import pytest

    t = Tables(spark, SF_SMALL)
    stub = StubReader(t.sale_line)
    with pytest.raises(ValueError, match="Slicing"):
        JdbcTables(stub, "jdbc:x").sale_line
    cut = Slicing("MFechaHora", "2021-07-18 00:00:00", "2023-11-19 00:00:00", 64)
    jt = JdbcTables(stub, "jdbc:x", {"user": "u"}, {"sale_line": cut}, crates=t.dim_crates)
    assert jt.sale_line.columns == t.sale_line.columns
    assert stub.options == {
        "url": "jdbc:x", "dbtable": "TransProdDetalle", "user": "u", "partitionColumn": "MFechaHora",
        "lowerBound": "2021-07-18 00:00:00", "upperBound": "2023-11-19 00:00:00", "numPartitions": 64,
    }
    assert jt.dim_crates.count() == t.dim_crates.count()


def test_one_unit_replaces_only_its_folder(spark, tmp_path):
    rows = [("D001", 1.0), ("D002", 2.0)]
    out = str(tmp_path / "plan")
    write_plan(spark.createDataFrame(rows, "UNE string, Rejas double"), out)
    write_plan(spark.createDataFrame([("D002", 9.0)], "UNE string, Rejas double"), out)
    assert sorted((r.UNE, r.Rejas) for r in spark.read.parquet(out).collect()) == [("D001", 1.0), ("D002", 9.0)]


def test_channel_codes_ignore_trailing_blanks(spark):
    from types import SimpleNamespace

    p = fixture_params()
    code = p.channels[0]
    t = SimpleNamespace(client_channel=spark.createDataFrame([("a", code + " "), ("b", code), ("c", code + "x")], "ClienteClave string, EsquemaID string"))
    assert sorted(tuple(r) for r in extracts.channel_codes(t, p).select("ClienteClave", "EsquemaID").collect()) == [("a", code), ("b", code)]


def test_load_checks(spark):
    from types import SimpleNamespace

    from cratecast.plans.report import load_checks

    t, p = Tables(spark, SF_SMALL), fixture_params()
    assert {r.n for r in load_checks(t, p).collect() if "." in r.check} == {0}
    a, b = p.channels[:2]
    bad = SimpleNamespace(client_channel=spark.createDataFrame([("x", a), ("x", b), (None, a)], "ClienteClave string, EsquemaID string"))
    got = {r.check: r.n for r in load_checks(bad, p, ("client_channel",)).collect()}
    assert got == {"client_channel.ClienteClave": 1, "client_channel.EsquemaID": 0, "clients in several channels": 1}
