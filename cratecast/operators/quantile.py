"""Exact quantiles (linear interpolation) computed as distributed selection.

A global exact percentile aggregate keeps every distinct value in one final
task. Here the k-th order statistic is found instead by narrowing a value
bracket: each pass is one aggregation (equal-width ``width_bucket`` histogram
with per-bucket count/min/max, partially aggregated map-side) that serves the
brackets of all requested quantiles. The driver receives at most ``bins + 1``
rows per quantile and pass. The next bracket is the min and max of the bucket
that holds rank k, so it is at least ``bins`` times narrower or ends at data
values closer than that; a hot value collapses it at once. The value above
rank k, where interpolation needs it, is one more aggregate.

The result equals pandas/NumPy ``quantile`` (method 'linear') and DuckDB
``quantile_cont``: with ``pos = p * (n - 1)``, ``k = floor(pos)``,
``v = x[k] + (x[k+1] - x[k]) * (pos - k)``.

``group_quantiles`` is the same search for every group of a table at once. The
brackets are a table, one row a group, that is joined to the values by the
group; groups end one by one, and the driver sees only how many ranks are open.
"""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize


def _values(df: DataFrame, col: str, weight: str | None, *more) -> DataFrame:
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    x = df.select(*more, F.col(col).cast("double").alias("x"), w.alias("w"))
    return x.filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.col("w") > 0))


def _histograms(x: DataFrame, brackets: list[tuple[float, float]], bins: int) -> dict[int, list]:
    """Per bracket (by position) its non-empty buckets (count, min, max) in order."""
    cells = []
    for i, (lo, hi) in enumerate(brackets):
        s = 2.0**-20 if hi / 2 - lo / 2 > 1e300 else 1.0  # bins * range must stay a double
        b = F.width_bucket(F.col("x") * s, F.lit(lo * s), F.lit(hi * s), F.lit(bins))
        cells.append(F.when(F.col("x").between(lo, hi), F.struct(F.lit(i).alias("i"), b.alias("b"))))
    at = x.select("x", "w", F.explode(F.array_compact(F.array(*cells))).alias("c"))
    rows = at.groupBy("c.i", "c.b").agg(F.sum("w").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")).collect()
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["i"], r["b"])):
        out.setdefault(r["i"], []).append((r["n"], r["mn"], r["mx"]))
    return out


def order_statistics(x: DataFrame, ranks: list[int], lo: float, hi: float, bins: int = 2048) -> tuple[dict[int, tuple[float, int]], int]:
    """For each 0-based rank (value there, number of values up to and including it), and the number of passes."""
    found: dict[int, tuple[float, int]] = {}
    todo = {k: (lo, hi, 0) for k in ranks}  # bracket and number of values below it
    passes = 0
    while todo:
        passes += 1
        brackets = sorted({(a, b) for a, b, _ in todo.values()})
        hists = _histograms(x, [(a, b if a < b else math.nextafter(b, math.inf)) for a, b in brackets], bins)
        for k, (a, b, below) in list(todo.items()):
            for n, mn, mx in hists[brackets.index((a, b))]:
                if k < below + n:
                    break
                below += n
            if mn == mx:
                found[k] = (mn, below + n)
                del todo[k]
            else:
                todo[k] = (mn, mx, below)
    return found, passes


def exact_quantiles(df: DataFrame, col: str, probs: list[float], weight: str | None = None, bins: int = 2048) -> list[float | None]:
    """Exact linear-interpolated quantiles of ``col``; None for an empty input.

    ``weight`` (a non-negative integer column) counts each row that many
    times: the quantile of line-level values can be taken on a pre-aggregated
    table of (value, number of lines).
    """
    x = _values(df, col, weight)
    n, lo, hi = x.agg(F.sum("w"), F.min("x"), F.max("x")).first()
    if not n:
        return [None for _ in probs]
    at = [p * (n - 1) for p in probs]
    found, _ = order_statistics(x, sorted({math.floor(a) for a in at}), lo, hi, bins)
    above = sorted({found[math.floor(a)][0] for a in at if a > math.floor(a) and math.floor(a) + 1 >= found[math.floor(a)][1]})
    nxt = dict(zip(above, x.agg(*[F.min(F.when(F.col("x") > v, F.col("x"))) for v in above]).first())) if above else {}
    out = []
    for a in at:
        v, upto = found[math.floor(a)]
        up = nxt[v] if a > math.floor(a) and math.floor(a) + 1 >= upto else v
        out.append(v + (up - v) * (a - math.floor(a)))
    return out


def exact_quantile(df: DataFrame, col: str, p: float, weight: str | None = None, **kw) -> float | None:
    return exact_quantiles(df, col, [p], weight=weight, **kw)[0]


def group_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float], names: Sequence[str], weight: str | None = None, bins: int = 256) -> DataFrame:
    """Exact linear-interpolated quantiles of ``col`` in every group: the keys and one column for each of ``probs``.

    A null key is a group of its own; null and NaN values and weights of 0 or
    less count for nothing, and a group without a value has no row. ``weight``
    as in ``exact_quantiles``.

    Values are landed once. In each pass they meet the open brackets of their
    group (landed too, so that the join can split a hot group), and a histogram
    per bracket, combined map-side, tells which bucket holds the wanted rank;
    from the second pass on only values inside open brackets are read.
    """
    x = materialize(_values(df, col, weight, F.struct(*keys).alias("g")), "gq_values")
    ends = materialize(x.groupBy("g").agg(F.sum("w").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")), "gq_ends")
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    k = [F.floor(a).cast("long") for a in at]
    nxt = [F.least(F.floor(a).cast("long") + 1, F.col("n") - 1) for a in at]
    ranks = F.explode(F.array_distinct(F.array(*k, *nxt))).alias("k")
    state = materialize(ends.select("g", ranks, "lo", "hi", F.lit(0).cast("long").alias("below")), "gq_state")
    passes = 0
    while state.filter("lo < hi").limit(1).count():
        passes += 1
        todo = state.filter("lo < hi")
        # open brackets of a group are equal or disjoint, two a quantile at most
        brackets = materialize(todo.groupBy("g").agg(F.collect_set(F.struct("lo", "hi")).alias("b")), "gq_brackets")
        inside = x.join(brackets, "g").select("g", "x", "w", F.explode(F.filter("b", lambda b: F.col("x").between(b.lo, b.hi))).alias("c"))
        if passes > 1:
            inside = materialize(inside, "gq_inside")
            x = inside.select("g", "x", "w")
        scale = F.when(F.col("c.hi") / 2 - F.col("c.lo") / 2 > 1e300, F.lit(2.0**-20)).otherwise(1.0)  # bins * range must stay a double
        bucket = F.width_bucket(F.col("x") * scale, F.col("c.lo") * scale, F.col("c.hi") * scale, F.lit(bins))
        # under a name of its own the group is dealt anew after the partial sums; else the join's dealing would
        # serve the aggregate too, and a hot group could not be split
        hist = inside.groupBy(F.struct("g").alias("h"), "c", bucket.alias("bucket")).agg(F.sum("w").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
        upto = W.partitionBy("h", "c").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)  # bins + 1 rows at most
        hist = hist.withColumn("upto", F.sum("n").over(upto)).select("h.g", "c", "mn", "mx", (F.col("upto") - F.col("n")).alias("before"), "upto")
        found = todo.withColumn("c", F.struct("lo", "hi")).join(hist, ["g", "c"]).filter("below + before <= k and k < below + upto")
        found = found.select("g", "k", F.col("mn").alias("lo"), F.col("mx").alias("hi"), (F.col("below") + F.col("before")).alias("below"))
        state = materialize(state.filter("lo = hi").unionByName(found), "gq_state")
    values = state.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("k", "lo"))).alias("m"))  # two entries a quantile at most
    m = lambda r: F.element_at("m", r)
    out = [(m(a) + (m(b) - m(a)) * (p - a)).alias(name) for p, a, b, name in zip(at, k, nxt, names)]
    return ends.join(values, "g").select("g.*", *out)


def quantile_cut(df: DataFrame, col: str, p: float, strict: bool, weight_df: DataFrame | None = None, weight: str | None = None) -> tuple[DataFrame, float | None]:
    """Keep rows with ``col`` below (``strict``) or at most the p-quantile.

    The quantile is taken over ``weight_df`` when given (e.g. a pre-aggregated
    table with a line-count ``weight``), else over ``df`` itself. The cut is
    a literal predicate, so it stays inside the scan/codegen stage.
    """
    q = exact_quantile(weight_df if weight_df is not None else df, col, p, weight=weight)
    if q is None:
        return df.limit(0), None
    c = F.col(col)
    return df.filter(c < F.lit(q) if strict else c <= F.lit(q)), q
