"""Connected components by alternating stars (large star, small star).

Every round turns each node's neighbours towards the smallest one it knows; a
round is two aggregations with map-side combining and two joins with their
landed results, so that a hub's rows are split by the skew join. Rounds end
when all edges are stars; nothing is collected but whether they are. Rounds
grow with the logarithm of the longest chain. No round has more edges than the
first, so that their number gives the tasks that write a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, land


def _stars(e: DataFrame, ends_most: int) -> bool:
    """Whether every node is a centre or a leaf of one centre: another round would change nothing."""
    ends = e.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("lo", F.lit(0), F.lit(1)))
    ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return gathered(ends, ends_most).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, comp): the smallest node reachable from each node that has an edge.

    edges: columns a, b (long), landed (they are counted first). Self-links and rows with a null are dropped.
    """
    n = edges.count()

    def put(df: DataFrame, name: str) -> DataFrame:
        return land(gathered(df, 2 * n), name)

    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(a.isNotNull() & b.isNotNull() & (a != b)).distinct()
    e = put(e, "cc_edges")
    for _ in range(most_rounds):
        if _stars(e, 2 * n):
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc_low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("lo < hi").distinct()
        large = put(large, "cc_large")
        low = put(large.groupBy("hi").agg(F.min("lo").alias("m")), "cc_low")
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = put(small.union(low.select("hi", F.col("m").alias("lo"))).distinct(), "cc_edges")
    else:
        raise RuntimeError("components did not settle")
    centres = gathered(e.select(F.col("lo").alias("node"), F.col("lo").alias("comp")).distinct(), n)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).union(centres)
