"""Relational source (S1): the domain tables read over JDBC.

The original pulled whole query results into one process over ODBC. Here
each table is a Spark JDBC relation read in parallel slices of a numeric, date
or timestamp column (``partitionColumn`` / bounds / ``numPartitions``, or ``EqualSlices``); Spark
pushes the plan's filters and column lists into the generated SQL. For repeated
use, ``land`` writes every table once to Parquet (sale headers and visits
partitioned by day) and ``ParquetTables`` reads them back: a filter on
``DiaClave`` reads only those days' folders.

Credentials come only from Spark conf / the caller, never from code.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SCHEMAS, check

# source relation name of each domain table
SOURCE_NAMES = {
    "sale_header": "TransProd",
    "sale_line": "TransProdDetalle",
    "warehouse": "Almacen",
    "client_channel": "ClienteEsquema",
    "product_unit": "ProductoUnidad",
    "product_detail": "ProductoDetalle",
    "client": "Cliente",
    "sequence": "Secuencia",
    "visit": "Visita",
    "agenda": "AgendaVendedor",
}


@dataclass
class Slicing:
    """Bounds are numbers, or dates / timestamps in ISO form, as the column is."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


#: Start of the day, hour and minute of a column, in the source's SQL.
UNITS = (
    "CAST({c} AS DATE)",
    "DATEADD(hour, DATEDIFF(hour, 0, {c}), 0)",
    "DATEADD(minute, DATEDIFF(minute, 0, {c}), 0)",
)
_STEPS = (dt.timedelta(days=1), dt.timedelta(hours=1), dt.timedelta(minutes=1))


@dataclass
class EqualSlices:
    """Slices of about equal row counts of a date or timestamp column.

    The source counts its rows per day, and per hour and minute where a day or
    hour alone is more than a slice; the cuts follow the counts, so that no
    bounds have to be guessed. ``units``: the source's SQL for the start of a
    day, hour and minute."""

    column: str
    partitions: int
    units: tuple[str, ...] = UNITS


def counted(read, column: str, units: tuple[str, ...], partitions: int) -> list[tuple[dt.datetime, int]]:
    """(start, rows) of the column's days, in order; heavy days as their hours, heavy hours as their minutes.

    read(expression of the start, condition) gives the source's counts: rows with ``v`` and ``n``, a calendar's days at most."""

    def ask(unit: str, where: str) -> list[tuple[dt.datetime, int]]:
        rows = [(r["v"], r["n"]) for r in read(unit.format(c=column), where)]
        return sorted((dt.datetime.combine(v, dt.time()) if not isinstance(v, dt.datetime) else v, int(n)) for v, n in rows if v is not None)

    out = ask(units[0], f"{column} IS NOT NULL")
    most = sum(n for _, n in out) / max(1, partitions)
    for unit, step in zip(units[1:], _STEPS):
        finer = []
        for v, n in out:
            heavy = n > most / 2 and (step == _STEPS[0] or _on(v, step))
            finer += ask(unit, f"{column} >= '{v:%Y-%m-%d %H:%M:%S}' AND {column} < '{v + step:%Y-%m-%d %H:%M:%S}'") if heavy else [(v, n)]
        out = finer
    return out


def _on(v: dt.datetime, step: dt.timedelta) -> bool:
    """Whether a start can be that of a whole step of this length (a day's start may stand for an hour)."""
    return not (v - dt.datetime.min) % step


def equal_cuts(counts: list[tuple[dt.datetime, int]], partitions: int) -> list[dt.datetime]:
    """Starts that divide the counts into at most ``partitions`` slices: each cut is the start nearest to its share of the rows."""
    total, run, edges = sum(n for _, n in counts), 0, []
    for v, n in counts:
        edges.append((run, v))
        run += n
    cuts = []
    for i in range(1, partitions):
        want = total * i / partitions
        at = min(edges[1:], key=lambda e: abs(e[0] - want), default=None)
        if at is not None and (not cuts or at[1] > cuts[-1]):
            cuts.append(at[1])
    return cuts


def predicates(column: str, cuts: list[dt.datetime]) -> list[str]:
    """Conditions of the slices: every row, and one without a value, is in exactly one."""
    if not cuts:
        return ["1 = 1"]
    t = [f"'{c:%Y-%m-%d %H:%M:%S}'" for c in cuts]
    return [f"{column} < {t[0]} OR {column} IS NULL", *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(t, t[1:])], f"{column} >= {t[-1]}"]


#: Tables too large for one connection: reading them unsliced is an error.
SLICED = ("sale_line",)
#: Landed by day; filters on the column prune folders.
BY_DAY = ("sale_header", "visit")


@dataclass
class JdbcTables:
    """Domain tables backed by JDBC relations (lazy)."""

    spark: SparkSession
    url: str
    options: dict = field(default_factory=dict)          # user, password, driver, fetchsize ...
    slicing: dict[str, Slicing | EqualSlices] = field(default_factory=dict)
    crates: DataFrame | None = None                       # see sources.dims.read_crates

    def _read(self, name: str) -> DataFrame:
        r = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", SOURCE_NAMES[name])
        for k, v in self.options.items():
            r = r.option(k, v)
        s = self.slicing.get(name)
        if s is None and name in SLICED:
            raise ValueError(f"{name}: give a Slicing (e.g. on its timestamp MFechaHora); one connection cannot carry it")
        if isinstance(s, EqualSlices):
            return self._typed(name, self._equal(name, s))
        if s is not None:
            r = (
                r.option("partitionColumn", s.column)
                .option("lowerBound", str(s.lower))
                .option("upperBound", str(s.upper))
                .option("numPartitions", s.partitions)
            )
        return self._typed(name, r.load())

    def _equal(self, name: str, s: EqualSlices) -> DataFrame:
        def read(unit: str, where: str) -> list:
            q = f"(SELECT {unit} AS v, COUNT(*) AS n FROM {SOURCE_NAMES[name]} WHERE {where} GROUP BY {unit}) counts"
            r = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", q)
            for k, v in self.options.items():
                r = r.option(k, v)
            return r.load().collect()

        cuts = equal_cuts(counted(read, s.column, s.units, s.partitions), s.partitions)
        return self.spark.read.jdbc(self.url, SOURCE_NAMES[name], predicates=predicates(s.column, cuts), properties={k: str(v) for k, v in self.options.items()})

    def _typed(self, name: str, df: DataFrame) -> DataFrame:
        want = SCHEMAS[name]
        return check(name, df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want.fields]))

    def __getattr__(self, name: str) -> DataFrame:
        if name in SOURCE_NAMES:
            return self._read(name)
        if name == "dim_crates":
            if self.crates is None:
                raise AttributeError("dim_crates: pass the crate table as crates (see sources.dims.read_crates)")
            return self.crates
        raise AttributeError(name)


def land(tables, path: str) -> None:
    """Write every domain table once to Parquet under ``path``; sale headers
    and visits by day. A day's rows are spread over up to 8 files, so that a
    large day is not one task."""
    for name in SOURCE_NAMES:
        df = getattr(tables, name)
        if name in BY_DAY:
            w = df.repartition("DiaClave", (F.rand(0) * 8).cast("int")).write.mode("overwrite").partitionBy("DiaClave")
        else:
            w = df.write.mode("overwrite")
        w.parquet(f"{path.rstrip('/')}/{name}")


class ParquetTables:
    """Domain tables landed by ``land`` (or produced by any other job)."""

    def __init__(self, spark: SparkSession, path: str, crates: DataFrame | None = None):
        self.spark, self.path, self._crates = spark, path.rstrip("/"), crates

    def __getattr__(self, name: str) -> DataFrame:
        if name == "dim_crates":
            if self._crates is None:
                raise AttributeError("dim_crates: pass the crate table (see sources.dims.read_crates)")
            return self._crates
        if name in SOURCE_NAMES:
            # the schema is given: the day in the folder's name is a date
            return check(name, self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}"))
        raise AttributeError(name)
