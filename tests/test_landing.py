"""Landing only changed days behind a manifest; slices of equal row counts."""

import datetime as dt
import os
import random
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from cratecast.params import fixture_params
from cratecast.sources import extracts
from cratecast.sources.fixtures import Tables
from cratecast.sources.jdbc import SOURCE_NAMES, EqualSlices, JdbcTables, counted, equal_cuts, predicates
from cratecast.sources.landing import DAY, LandedTables, refresh
from cratecast.sources.schemas import SCHEMAS

from .conftest import SF_SMALL


def source(spark, **changed):
    """The fixture's tables, some replaced."""
    t = Tables(spark, SF_SMALL)
    heads = t.sale_header.filter("DiaClave < '1995-03-01'")
    few = {"sale_header": heads, "sale_line": t.sale_line.join(heads.select("TransProdID"), "TransProdID", "left_semi"), "visit": t.visit.filter("dayofmonth(DiaClave) < 4")}
    return SimpleNamespace(**{n: changed.get(n, few.get(n, getattr(t, n))) for n in SOURCE_NAMES}, dim_crates=t.dim_crates)


def files(path, name):
    return {(os.path.relpath(d, path), f) for d, _, fs in os.walk(f"{path}/{name}") for f in fs if f.endswith(".parquet")}


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_two_landings(spark, tmp_path):
    path, t = str(tmp_path / "landed"), source(spark)
    first = refresh(t, path, 1)
    assert len(first["sale_header"]) == t.sale_header.select(DAY).distinct().count() > 10
    assert len(first["sale_line"]) == t.sale_line.join(t.sale_header, "TransProdID").select(DAY).distinct().count()
    one = LandedTables(spark, path, t.dim_crates)
    assert all(same(getattr(one, n), getattr(t, n)) for n in SOURCE_NAMES)
    p = fixture_params()
    assert same(extracts.sales_detail(one, p), extracts.sales_detail(t, p))
    before = {n: files(path, n) for n in ("sale_header", "sale_line", "visit")}

    # nothing new: no day gets files, although the watermark's own lines are looked at again
    assert refresh(t, path) == {"sale_header": [], "sale_line": [], "visit": []}
    assert {n: files(path, n) for n in before} == before

    # a late line of an old day, and a new day
    head = t.sale_header.orderBy("DiaClave", "TransProdID").first()
    top = t.sale_line.agg(F.max("MFechaHora")).first()[0]
    late = [(head["TransProdID"], "late", "001", 1, 7.0, 1.0, 7.0, top + dt.timedelta(days=3), head["MUsuarioID"]), ("new", "x", "001", 1, 2.0, 1.0, 2.0, top + dt.timedelta(days=3), head["MUsuarioID"])]
    lines = t.sale_line.unionByName(spark.createDataFrame(late, SCHEMAS["sale_line"]))
    heads = t.sale_header.unionByName(spark.createDataFrame([("new", head["ClienteClave"], head["MUsuarioID"], dt.date(2029, 1, 1), 1, 1, 2, 2)], SCHEMAS["sale_header"]))
    t2 = source(spark, sale_line=lines, sale_header=heads)
    got = refresh(t2, path)
    assert got == {"sale_header": [dt.date(2029, 1, 1)], "sale_line": [head[DAY], dt.date(2029, 1, 1)], "visit": []}
    now = {n: files(path, n) for n in before}
    assert all(before[n] <= now[n] for n in before) and now["visit"] == before["visit"]
    assert {d.split("DiaClave=")[1] for d, _ in now["sale_line"] - before["sale_line"]} == {str(head[DAY]), "2029-01-01"}
    two = LandedTables(spark, path)
    assert same(two.sale_line, lines) and same(two.sale_header, heads)
    # what was read before is still whole
    assert same(one.sale_line, t.sale_line)


def test_a_failed_refresh_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path, t = str(tmp_path / "landed"), source(spark)
    refresh(t, path)
    lines = t.sale_line.withColumn("MFechaHora", F.col("MFechaHora") + F.expr("interval 9000 days")).withColumn("Cantidad", F.col("Cantidad") + 1)

    class Broken(SimpleNamespace):
        @property
        def warehouse(self):
            raise RuntimeError("lost")

    parts = {n: getattr(t, n) for n in SOURCE_NAMES if n != "warehouse"}
    with pytest.raises(RuntimeError):
        refresh(Broken(**(parts | {"sale_line": lines})), path)
    assert same(LandedTables(spark, path).sale_line, t.sale_line)
    # the next attempt takes the same version over
    assert len(refresh(source(spark, sale_line=lines), path)["sale_line"]) > 10
    assert LandedTables(spark, path).version == 2 and same(LandedTables(spark, path).sale_line, lines)


def test_day_filters_prune_folders_and_nothing_landed(spark, tmp_path):
    path, t = str(tmp_path / "landed"), source(spark)
    with pytest.raises(FileNotFoundError):
        LandedTables(spark, path).sale_header
    refresh(t, path)
    h = LandedTables(spark, path).sale_header
    day = h.selectExpr("min(DiaClave) as d").first().d
    plan = h.filter(F.col(DAY) == F.lit(day))
    assert 0 < plan.count() < h.count() and "PartitionFilters: [" in plan._jdf.queryExecution().executedPlan().toString()
    assert all(f"DiaClave={day}" in r[0] for r in plan.select(F.input_file_name()).distinct().collect())


# -- slices of equal work ----------------------------------------------------------------------

DUCK = ("date_trunc('day', {c})", "date_trunc('hour', {c})", "date_trunc('minute', {c})")


def stub_rows():
    rng = random.Random(1)
    day = dt.datetime(2023, 1, 1)
    rows = [day + dt.timedelta(days=int(rng.paretovariate(0.7)) % 400, seconds=rng.randrange(86400)) for _ in range(6000)]
    rows += [dt.datetime(2023, 6, 1, 9, rng.randrange(60), rng.randrange(60)) for _ in range(9000)]  # most of the rows within an hour
    return rows + [None] * 70 + [dt.datetime(2023, 3, 3)] * 40


def test_skewed_days_give_equal_slices(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE TransProdDetalle (MFechaHora TIMESTAMP)")
    con.executemany("INSERT INTO TransProdDetalle VALUES (?)", [(r,) for r in stub_rows()])
    asked = []

    def read(unit, where):
        asked.append(where)
        return [{"v": v, "n": n} for v, n in con.execute(f"SELECT {unit} AS v, count(*) AS n FROM TransProdDetalle WHERE {where} GROUP BY {unit}").fetchall()]

    counts = counted(read, "MFechaHora", DUCK, 16)
    assert sum(n for _, n in counts) == len(stub_rows()) - 70 and counts == sorted(counts)
    where = predicates("MFechaHora", equal_cuts(counts, 16))
    sizes = [con.execute(f"SELECT count(*) FROM TransProdDetalle WHERE {w}").fetchone()[0] for w in where]
    assert sum(sizes) == len(stub_rows()) and len(sizes) == 16 and max(sizes) <= 2 * min(sizes), sizes
    assert con.execute(f"SELECT max(x) FROM (SELECT {' + '.join(f'coalesce(({w})::INT, 0)' for w in where)} AS x FROM TransProdDetalle)").fetchone()[0] == 1
    assert 2 < len(asked) < 60


def test_cuts_of_few_values():
    d = dt.datetime(2023, 1, 1)
    assert equal_cuts([], 4) == [] and equal_cuts([(d, 5)], 4) == [] and predicates("c", []) == ["1 = 1"]
    assert equal_cuts([(d, 5), (d + dt.timedelta(days=1), 5)], 8) == [d + dt.timedelta(days=1)]


def test_tables_are_read_by_the_source_s_own_counts(spark):
    t = Tables(spark, SF_SMALL)
    lines = t.sale_line.toPandas()
    con = duckdb.connect()
    con.register("TransProdDetalle", lines)
    seen = {}

    class Reader:
        def __init__(self):
            self.read, self.opts = self, {}

        def format(self, kind):
            return self

        def option(self, k, v):
            self.opts[k] = v
            return self

        def load(self):
            rows = con.execute(f"SELECT * FROM {self.opts['dbtable']}").fetchall()
            return spark.createDataFrame(rows, "v timestamp_ntz, n long")

        def jdbc(self, url, table, predicates, properties):
            seen.update(predicates=predicates, properties=properties)
            return t.sale_line

    jt = JdbcTables(Reader(), "jdbc:x", {"fetchsize": 10}, {"sale_line": EqualSlices("MFechaHora", 12, DUCK)})
    assert jt.sale_line.count() == len(lines)
    sizes = [con.execute(f"SELECT count(*) FROM TransProdDetalle WHERE {w}").fetchone()[0] for w in seen["predicates"]]
    assert sum(sizes) == len(lines) and max(sizes) <= 2 * min(sizes) and seen["properties"] == {"fetchsize": "10"}
