"""Group statistics that merge: a landed state of count, mean and sum of
squared deviations per key (Z1-Z5).

A refresh computes the state of the new rows only and merges it into the landed
one by the parallel formula, so last year's lines are not read again for this
week's z-scores. States of one key are merged in a fixed order (by their
versions), and only a handful of states meet at a time, so the merge needs no
window and a hot key is one row of each state.

The filter in front of the statistics must stay the same between refreshes: a
cut by a quantile that moves changes rows already counted, so give the cut as a
value and start a new state when it is set anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize


def state_of(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, n, mean, m2): count, mean and sum of squared deviations of the non-null values per key.

    One aggregate with map-side combining. A key without a value has n = 0 and
    a mean and m2 of 0; a null key is a key."""
    n, m = F.count(col), F.avg(F.col(col).cast("double"))
    # the population variance is defined for one row, too
    return df.groupBy(*keys).agg(n.alias("n"), F.coalesce(m, F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(F.col(col).cast("double")) * n, F.lit(0.0)).alias("m2"))


def _merge(a: Column, b: Column) -> Column:
    """Count, mean and m2 of two sets of values from those of each."""
    n = a.n + b.n
    d = b["mean"] - a["mean"]
    share = F.when(n > 0, b.n / n).otherwise(0.0)
    return F.struct(n.alias("n"), (a["mean"] + d * share).alias("mean"), (a.m2 + b.m2 + d * d * a.n * share).alias("m2"))


def merged(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One state of all; ``states`` in a fixed order, so that reruns agree to the last bit."""
    u = None
    for i, s in enumerate(states):
        s = s.select(*keys, F.struct(F.lit(i).alias("i"), "n", "mean", "m2").alias("s"))
        u = s if u is None else u.unionByName(s)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    # at most one entry a state and key
    g = u.groupBy(*keys).agg(F.aggregate(F.sort_array(F.collect_list("s")), zero, _merge).alias("s"))
    return g.select(*keys, "s.n", "s.mean", "s.m2")


def zscore_from(df: DataFrame, state: DataFrame, col: str, keys: Sequence[str], out: str, single: float = 10.0) -> DataFrame:
    """``operators.stats.zscore`` from a state instead of the rows' own statistics.

    A key that the state lacks, or knows with one value, gets ``single``; a
    constant group 0. ``state`` should be landed (one row a key), so that the
    join can split a hot key."""
    s = state.select(F.struct(*keys).alias("_k"), F.col("n").alias("_n"), F.col("mean").alias("_m"), F.col("m2").alias("_m2"))
    x = df.withColumn("_g", F.struct(*keys)).join(s, F.col("_g") == F.col("_k"), "left")
    std = F.sqrt(F.col("_m2") / (F.col("_n") - 1))
    z = F.when(F.coalesce(F.col("_n"), F.lit(0)) <= 1, F.lit(float(single))).when(F.col("_m2") == 0, F.lit(0.0)).otherwise((F.col(col) - F.col("_m")) / std)
    return x.withColumn(out, z).drop("_g", "_k", "_n", "_m", "_m2")


class LandedState:
    """The state under a path, one version a refresh; a version counts once it is written whole."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], col: str):
        self.spark, self.path, self.keys, self.col = spark, path.rstrip("/"), list(keys), col

    def version(self) -> int:
        """0 before the first update. Versions are named in a file of one row, written last."""
        try:
            return self.spark.read.schema("done int").parquet(f"{self.path}/done").agg(F.max("done")).first()[0] or 0
        except AnalysisException:
            return 0

    def read(self) -> DataFrame | None:
        v = self.version()
        return self.spark.read.parquet(f"{self.path}/state/v={v}") if v else None

    def update(self, new: DataFrame) -> DataFrame:
        """Merge the rows of ``new`` (read once, nothing else is) and return the state landed. Rows given twice count twice."""
        v, old, own = self.version(), self.read(), state_of(new, self.keys, self.col)
        out = merged([old, own], self.keys) if old is not None else own
        out.write.mode("overwrite").parquet(f"{self.path}/state/v={v + 1}")
        self.spark.createDataFrame([(v + 1,)], "done int").coalesce(1).write.mode("append").parquet(f"{self.path}/done")
        return self.read()


def merged_zscore(df: DataFrame, parts: Sequence[Column], col: str, keys: Sequence[str], out: str, single: float = 10.0) -> DataFrame:
    """Z-scores of df from the merged states of its parts (conditions that divide the rows), as after that many refreshes."""
    state = materialize(merged([state_of(df.filter(p), keys, col) for p in parts], keys), "merged_state")
    return zscore_from(df, state, col, keys, out, single)
