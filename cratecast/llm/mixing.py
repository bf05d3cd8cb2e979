"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word budget. Whole passes over the source (epochs) come
first; what is left is filled by weighted sampling without replacement: a
document's key is -ln(u) / quality, with u from a hash of its id, and documents
are taken in key order while their running words fit the rest. Only DataFrame
functions are used.

The running sum never sorts a source: keys are dealt into ``cells`` cells per
source, cells are summed with map-side combining and their prefix sums
(at most ``cells`` rows a source) tell which cells are in, out, or on the
border; only a border cell's rows are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land, n_words

WEIGHTS = (5, 2, 1)
CAP = 3
CELLS = 4096


def quality(text: Column, size: Column) -> Column:
    """Quality weight in [0.5, 1]: 1 for texts whose mean word has 3 to 9
    characters, falling to 0.5 outside; empty texts get 0.5."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.coalesce(F.when(size == 0, 0.5).when(mean < 3, 0.5 + mean / 6).when(mean > 9, 0.5 + 4.5 / mean).otherwise(1.0), F.lit(0.5))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """sources (source, source_size) with the target of each.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    the total of all sizes; a target stops at ``cap`` times its source's size
    and the excess is reshared by weight until none is above. That is one level
    per unit of weight: sources fill up in the order of cap * size / weight.
    The table has one row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    s = sources.withColumn("_i", F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    by = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    all_, before = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), by.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(all_) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    still = F.sum("_w").over(all_) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    # the level if this source were the first that is not full
    s = s.withColumn("_level", rest / still).withColumn("_full", F.col("_level") * F.col("_w") >= F.col("_cap"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(all_)
    s = s.withColumn("_at", level.getField("_level"))
    target = F.when(F.col("_full") | F.col("_at").isNull(), F.col("_cap")).otherwise(F.col("_at") * F.col("_w"))
    return s.select("source", "source_size", F.coalesce(target, F.lit(0.0)).cast("double").alias("target"))


def uniform(key: Column, seed: int = 0) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the key."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, cells: int = CELLS, seed: int = 0) -> DataFrame:
    """doc_id, size, source, source_size, target, epochs, copies, taken of every row.

    size: words of the text (null or empty: 0). copies: whole passes, plus one
    if the document is in the sampled rest; taken = copies * size. A document
    is in the rest if the middle of it lies within the budget, in the order of
    (key, doc_id, size); where whole passes use the target up, no document is in
    the rest, empty ones included. Repeated rows count as documents of their own. A null
    doc_id has one key of its own, a null source is a source. No rows: no rows.
    """
    size = n_words("text")
    rows = docs.select("doc_id", "source", size.alias("size"), F.col("text"))
    rows = rows.select("doc_id", "source", "size", quality(F.col("text"), F.col("size")).alias("_q"))
    rows = rows.withColumn("_key", -F.ln(uniform(F.col("doc_id"), seed)) / F.col("_q"))
    # exp(-key / 2): close to uniform over the cells for weights in [0.5, 1]
    rows = rows.withColumn("_cell", F.floor((F.lit(1.0) - F.exp(-F.col("_key") * F.lit(0.75))) * F.lit(cells)).cast("int"))
    rows = land(rows.select("doc_id", F.struct("source").alias("_s"), "size", "_key", "_cell"), "mix_rows")
    sums = land(rows.groupBy("_s", "_cell").agg(F.sum("size").alias("_words")), "mix_cells")
    share = targets(sums.groupBy(F.col("_s.source").alias("source")).agg(F.sum("_words").alias("source_size")), weights, cap)
    share = share.select(F.struct("source").alias("_s"), "source_size", "target", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("int").alias("epochs"))
    share = land(share.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix_targets")
    upto = Window.partitionBy("_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = sums.withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0))).join(share, "_s")
    # out: starts beyond the rest; in: ends a whole cell before it
    nothing = (F.col("_rest") <= 0) & (F.col("epochs") > 0)  # whole passes only, for empty texts too
    state = F.when(nothing | (F.col("_before") > F.col("_rest")), 0).when(F.col("_before") + F.col("_words") <= F.col("_rest"), 2).otherwise(1)
    plan = land(plan.select("_s", "_cell", "source_size", "target", "epochs", "_rest", "_before", state.alias("_state")), "mix_plan")
    rows = rows.join(plan, ["_s", "_cell"])
    done = rows.where("_state <> 1").withColumn("_more", (F.col("_state") == 2).cast("int"))
    run = Window.partitionBy("_s", "_cell").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where("_state = 1").withColumn("_run", F.col("_before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    edge = edge.withColumn("_more", (F.col("_run") + F.col("size") / 2 <= F.col("_rest")).cast("int")).drop("_run")
    out = done.unionByName(edge).withColumn("copies", F.col("epochs") + F.col("_more"))
    return out.select("doc_id", "size", F.col("_s.source").alias("source"), "source_size", "target", "epochs", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
