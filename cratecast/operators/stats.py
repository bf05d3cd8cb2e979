"""Group statistics and group-transforms.

Rule used throughout: statistics over *fact* rows keyed by client (or any
key that can be hot) are computed with ``groupBy().agg()`` — partially
aggregated map-side — and joined back, never with an unbounded window. Where
a key can be hot the statistics are landed first: both sides of the join are
then plain exchanges, the only shape whose hot partitions AQE's skew join
splits (it does not where an aggregate sits on one side).
Windows are used only where a group is bounded by construction (products of
one client, weeks of one curve, the distinct code list), or where the largest
share of a key has been measured and rows are stored by that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize


def _cols(xs: Sequence[str] | str) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def zscore(df: DataFrame, col: str, keys: Sequence[str] | str, out: str, single: float = 10.0, hot: bool = False, together: bool = False) -> DataFrame:
    """Group z-score of ``col``: ``single`` if the group has at most one row,
    0 if its sample standard deviation is 0, else (x - mean) / std.

    ``hot``: a key may hold a large part of the rows; lands the statistics
    (one row a key) so that the join back can split it. ``together``: the rows
    of a key already lie in one partition and no key is hot: a window, without
    exchange or join."""
    keys = _cols(keys)
    if together:
        w = W.partitionBy(*keys)
        x = df.withColumns({"_zn": F.count(F.lit(1)).over(w), "_zm": F.avg(col).over(w), "_zs": F.stddev_samp(col).over(w)})
        return _scored(x, col, out, single)
    st = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_zn"), F.avg(col).alias("_zm"), F.stddev_samp(col).alias("_zs")
    )
    x = df.join(materialize(st, "zstats") if hot else st, keys, "left")
    return _scored(x, col, out, single)


def _z(col: str, single: float, i: int | str = "") -> Column:
    return (
        F.when(F.col(f"_zn{i}") <= 1, F.lit(float(single)))
        .when(F.col(f"_zs{i}") == 0, F.lit(0.0))
        .otherwise((F.col(col) - F.col(f"_zm{i}")) / F.col(f"_zs{i}"))
    )


def _scored(x: DataFrame, col: str, out: str, single: float) -> DataFrame:
    return x.withColumn(out, _z(col, single)).drop("_zn", "_zm", "_zs")


def zscore_bands(df: DataFrame, col: str, keys: Sequence[str], flags: Sequence[str], lo: float, hi: float, single: float = 10.0, together: bool = False) -> DataFrame:
    """``zscore`` and ``band_filter`` for several sets of rows at once: each of ``flags`` marks a set, has its own statistics
    per key, and stays set inside the band; rows without a flag go. ``together``: as for ``zscore``, else keys may be hot."""
    at = {}
    for i, f in enumerate(flags):
        v = F.when(F.col(f), F.col(col))
        at |= {f"_zn{i}": F.count(F.when(F.col(f), 1)), f"_zm{i}": F.avg(v), f"_zs{i}": F.stddev_samp(v)}
    if together:
        w = W.partitionBy(*keys)
        x = df.withColumns({k: a.over(w) for k, a in at.items()})
    else:
        x = df.join(materialize(df.groupBy(*keys).agg(*[a.alias(k) for k, a in at.items()]), "zstats"), [*keys], "left")
    inside = lambda z: (z > F.lit(lo)) & (z <= F.lit(hi))
    x = x.withColumns({f: F.coalesce(F.col(f) & inside(_z(col, single, i)), F.lit(False)) for i, f in enumerate(flags)})
    return x.drop(*at).filter(F.array_contains(F.array(*flags), True))


def band_filter(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Keep ``lo < col <= hi`` (either side optional)."""
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c > F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return df.filter(cond)


def first_by(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in the explicit total ``order``.

    ``min_by`` over a struct is a declarative aggregate, so it combines
    map-side and a hot key never gathers its rows in one task.
    """
    keys = _cols(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    r = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
    return r.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in cols])


def min_row_by(df: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Arg-min row per key (e.g. the smallest unit type per product)."""
    return first_by(df, [key], [order], [order, *cols])


def group_mode(df: DataFrame, keys: Sequence[str] | str, col: str, out: str | None = None) -> DataFrame:
    """Most frequent non-null value of ``col`` per key; ties go to the
    smallest value (the first of pandas' sorted ``mode()``)."""
    keys = _cols(keys)
    cnt = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    m = cnt.groupBy(*keys).agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(out or col))
    return m


def distinct_size(df: DataFrame, keys: Sequence[str] | str, col: str, count_null: bool, out: str) -> DataFrame:
    """Number of distinct values of ``col`` per key; a null counts as one more
    value when ``count_null`` (pandas ``unique()`` keeps it)."""
    keys = _cols(keys)
    n = F.count_distinct(F.col(col))
    if count_null:
        n = n + F.max(F.col(col).isNull().cast("int"))
    return df.groupBy(*keys).agg(n.cast("long").alias(out))


def code_rank(df: DataFrame, col: str, out: str, desc: bool = True) -> DataFrame:
    """Distinct non-null codes numbered 0.. in sorted order (descending by
    default). The rank window runs over the distinct codes only."""
    codes = df.select(col).filter(F.col(col).isNotNull()).distinct()
    o = F.col(col).desc() if desc else F.col(col).asc()
    return codes.select(col, (F.row_number().over(W.orderBy(o)) - 1).cast("int").alias(out))


def share_of_total(df: DataFrame, keys: Sequence[str] | str, col: str, out: str, scale: float = 100.0) -> DataFrame:
    """``col * scale / group sum`` on every row (NULL for a zero total).

    Meant for aggregated tables whose groups are bounded (products x days of
    one client), so a window is used.
    """
    keys = _cols(keys)
    tot = F.sum(col).over(W.partitionBy(*keys))
    return df.withColumn(out, F.try_divide(F.col(col) * F.lit(scale), F.nullif(tot, F.lit(0.0))))


def running_share(df: DataFrame, key: str, col: str, tie: str, out: str) -> DataFrame:
    """Cumulative sum of ``col`` per ``key``, largest first, ties by ``tie``."""
    w = W.partitionBy(key).orderBy(F.col(col).desc(), F.col(tie).asc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(out, F.sum(col).over(w))


def fill_group_mean(df: DataFrame, col: str, keys: Sequence[str] | str) -> DataFrame:
    """Replace NULLs of ``col`` by the mean of its group (bounded groups)."""
    keys = _cols(keys)
    return df.withColumn(col, F.coalesce(F.col(col), F.avg(col).over(W.partitionBy(*keys))))


def interpolate(df: DataFrame, col: str, keys: Sequence[str] | str, order: str, out: str) -> DataFrame:
    """Linear interpolation of NULL gaps by position within each group, the
    last value carried past the end, then a back-fill of the start. A group
    with no value stays NULL. ``order`` must be gap-free positions (e.g. a
    complete week grid). Groups are small (one curve), so windows are used.
    """
    keys = _cols(keys)
    v, pos = F.col(col), F.col(order)
    prev_w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    next_w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.currentRow, W.unboundedFollowing)
    pv = F.last(v, ignorenulls=True).over(prev_w)
    pp = F.last(F.when(v.isNotNull(), pos), ignorenulls=True).over(prev_w)
    nv = F.first(v, ignorenulls=True).over(next_w)
    np_ = F.first(F.when(v.isNotNull(), pos), ignorenulls=True).over(next_w)
    x = df.withColumns({"_pv": pv, "_pp": pp, "_nv": nv, "_np": np_})
    lin = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (pos - F.col("_pp")) / (F.col("_np") - F.col("_pp"))
    val = (
        F.when(v.isNotNull(), v)
        .when(F.col("_pv").isNotNull() & F.col("_nv").isNotNull(), lin)
        .when(F.col("_pv").isNotNull(), F.col("_pv"))
        .otherwise(F.col("_nv"))
    )
    return x.withColumn(out, val).drop("_pv", "_pp", "_nv", "_np")

