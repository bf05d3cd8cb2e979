"""Landing only what is new (S1, S12): versions of day folders behind a manifest.

``refresh`` asks the source for lines modified since the last watermark, finds
the days they belong to, and lands those days again: all their headers, lines
and visits, into folders of a new version. A day whose rows turn out equal (by
count and a sum of row hashes) keeps its old folder. The manifest of the new
version says which version holds each day; it is one file and written last, so
whatever is lost before that leaves the state of the last manifest whole, and a
repeated attempt overwrites what the failed one left.

    <path>/<table>/v=<version>/DiaClave=<day>/...   tables by day
    <path>/<table>/v=<version>/...                  the others, landed whole
    <path>/manifest/n=<version>/...

Rows deleted in the source show when their day is landed again for another reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jdbc import SOURCE_NAMES
from .schemas import SCHEMAS, check

DAY = "DiaClave"
#: Tables stored by day, with the column that tells when a row was changed (none: changed with the lines of its day).
BY_DAY = {"sale_header": None, "sale_line": "MFechaHora", "visit": "FechaHoraFinal"}
MANIFEST = "name string, day date, v int, rows long, hash string, watermark timestamp_ntz"


class LandedTables:
    """Domain tables as the last manifest has them."""

    def __init__(self, spark: SparkSession, path: str, crates: DataFrame | None = None):
        self.spark, self.path, self._crates = spark, path.rstrip("/"), crates
        self.version, self.days = _state(spark, self.path)

    def __getattr__(self, name: str) -> DataFrame:
        if name == "dim_crates":
            if self._crates is None:
                raise AttributeError("dim_crates: pass the crate table (see sources.dims.read_crates)")
            return self._crates
        if name not in SOURCE_NAMES:
            raise AttributeError(name)
        return check(name, self.with_day(name))

    def with_day(self, name: str) -> DataFrame:
        """A table with its folder's day, if it is stored by day; partition filters keep only the folders that count."""
        own = [(d, v) for n, d, v in ((r["name"], r["day"], r["v"]) for r in self.days) if n == name]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[name].fields if name not in BY_DAY or f.name != DAY)
        if not own:
            raise FileNotFoundError(f"{name} has not been landed in {self.path}")
        if name not in BY_DAY:
            return self.spark.read.schema(cols).parquet(f"{self.path}/{name}/v={own[0][1]}")
        found = [(d, v) for d, v in own if d is not None]
        if not found:
            return self.spark.createDataFrame([], f"{cols}, {DAY} date")
        of: dict[int, list[dt.date]] = {}
        for d, v in found:
            of.setdefault(v, []).append(d)
        x = self.spark.read.schema(f"{cols}, v int, {DAY} date").parquet(f"{self.path}/{name}")
        keep = F.lit(False)
        for v, days in sorted(of.items()):  # a calendar's days
            keep = keep | ((F.col("v") == v) & F.col(DAY).isin(days))
        return x.filter(keep).drop("v")


def _state(spark: SparkSession, path: str) -> tuple[int, list]:
    """(version, rows of its manifest): a row a table and day. Version 0 and none before the first landing."""
    try:
        m = spark.read.schema(f"{MANIFEST}, n int").parquet(f"{path.rstrip('/')}/manifest")
    except AnalysisException:
        return 0, []
    last = m.agg(F.max("n")).first()[0]
    return (last, m.filter(F.col("n") == last).drop("n").collect()) if last else (0, [])


def _prints(df: DataFrame) -> DataFrame:
    """(day, rows, hash): count and sum of row hashes a day, the same in any order."""
    cols = sorted(c for c in df.columns if c != DAY)
    return df.groupBy(F.col(DAY).alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).cast("string").alias("hash"))


def changed_days(tables, marks: dict[str, dt.datetime | None], known: set[dt.date]) -> list[dt.date]:
    """Days that may have changed: those of lines and visits modified at or after the watermark (or without a time), and days not landed yet.

    A line modified within the watermark's own tick is seen again, not missed."""
    since = lambda c, m: F.col(c).isNull() | (F.col(c) >= F.lit(m).cast("timestamp_ntz")) if m is not None else F.lit(True)
    heads = tables.sale_header.select("TransProdID", DAY)
    lines = tables.sale_line.filter(since("MFechaHora", marks.get("sale_line"))).select("TransProdID").distinct()
    days = heads.join(lines, "TransProdID", "left_semi").select(DAY)
    days = days.unionByName(tables.visit.filter(since("FechaHoraFinal", marks.get("visit"))).select(DAY))
    new = heads.filter(~F.col(DAY).isin(sorted(known))).select(DAY) if known else heads.select(DAY)
    return sorted(r[0] for r in days.unionByName(new).distinct().filter(F.col(DAY).isNotNull()).collect())  # a calendar's days


def refresh(tables, path: str, spread: int = 8) -> dict[str, list[dt.date]]:
    """Land what changed since the last refresh; per table by day, the days that got new files.

    ``spread``: files that a day is dealt to at most."""
    spark = tables.sale_header.sparkSession
    path = path.rstrip("/")
    last, state = _state(spark, path)
    v = last + 1
    now = {(r["name"], r["day"]): tuple(r) for r in state}
    marks = {n: max((r["watermark"] for r in state if r["name"] == n and r["watermark"] is not None), default=None) for n in BY_DAY}
    days = changed_days(tables, marks if last else {}, {r["day"] for r in state if r["day"] is not None})
    out: dict[str, list[dt.date]] = {}
    heads = tables.sale_header.filter(F.col(DAY).isin(days))
    bodies = {"sale_header": heads, "sale_line": tables.sale_line.join(heads.select("TransProdID", DAY), "TransProdID"), "visit": tables.visit.filter(F.col(DAY).isin(days))}
    for name, body in bodies.items():
        body = body.persist()  # the source is read once for the fingerprints and the files
        found = {r["day"]: (r["rows"], r["hash"]) for r in _prints(body).collect()}
        new = [d for d, x in sorted(found.items()) if now.get((name, d), (0,) * 6)[3:5] != x]
        for d in days:
            if d in new:
                now[name, d] = (name, d, v, *found[d], None)
            elif d not in found:
                now.pop((name, d), None)  # its rows are gone
        if new:
            rows = body.filter(F.col(DAY).isin(new)).repartition(DAY, (F.rand(0) * spread).cast("int"))
            rows.write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/{name}/v={v}")
        time = BY_DAY[name]
        top = body.agg(F.max(time)).first()[0] if time else None
        now[name, None] = (name, None, v, 0, None, max((x for x in (top, marks[name]) if x is not None), default=None))
        body.unpersist()
        out[name] = new
    for name in SOURCE_NAMES:
        if name not in BY_DAY:
            getattr(tables, name).write.mode("overwrite").parquet(f"{path}/{name}/v={v}")
            now[name, None] = (name, None, v, None, None, None)
    spark.createDataFrame(list(now.values()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/n={v}")
    return out
