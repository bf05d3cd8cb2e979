"""Warm-client forecast model (M1-M7) on Spark ML.

* Features: one-hot (all levels kept; an unseen level is an error) of
  channel, week, month, weekday and band, plus visits per week and the
  weekday mean, assembled into one vector (M1, M2).
* Split: a repeatable hash (MD5) of the row key into 25 buckets, 16 train / 4
  validation / 5 test (M4). ``randomSplit`` depends on partitioning.
* Model: boosting by trees fitted to the residuals, squared error (M3), in
  blocks. After each block the validation error of each of its trees is
  looked at; fitting stops ``patience`` trees after the lowest error, and the
  trees up to it are the model (M5); R2 / MAE / RMSE on test (M6).
* Fit: over packed rows (``boosting.py``), by the split rules of Spark ML's
  tree. Up to ``FEW_ROWS`` rows Spark ML's own tree is fitted, which takes some
  thirty short stages; the following holds for that fit.
* State: features are landed once, in buckets by row number. A block lands
  the prediction so far in the same buckets, which meet without an exchange.
  Inside a block each tree's rows are kept (memory, then disk) until the next
  tree's are there, so that a tree passes over the rows once and no tree
  before it is replayed.
* Tasks: buckets follow the number of rows (``PART_ROWS`` each), up to the
  session's partitions.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import PlanParams
from ..session import drop_tables, land_table, shuffle_partitions
from . import boosting

CATS = ["EsquemaID", "Semana", "Mes", "Dia", "Categoria"]
NUMS = ["Visitas_Semanales", "Venta_media_por_dia"]
LABEL = "Venta_Total_dia"
ROW_KEY = ["ClienteClave", "Semana", "Dia"]
ROW = ["_row", "_nth"]
#: Rows of a bucket while Spark ML fits the trees, and the rows up to which it does.
PART_ROWS, FEW_ROWS = 50_000, 1_000
#: Models fitted at a time; one of them holds the session's number of partitions.
AT_ONCE, _SETTING = 3, threading.Lock()


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """R2, MAE and RMSE as one row. The mean of ``y`` is one scalar
    aggregation; the rest is a second aggregation."""
    mu = df.agg(F.avg(y)).first()[0]
    e = F.col(y) - F.col(yhat)
    d = F.col(y) - F.lit(mu)
    a = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        F.sum(d * d).alias("sst"),
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
    )
    return a.select("n", (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))).alias("R2"), "MAE", "RMSE")


def hash_split(df: DataFrame, keys: list[str], p: PlanParams) -> DataFrame:
    """Add ``split`` in {train, val, test} from a hash of the row key."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    b = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(p.split_buckets))
    s = F.when(b < p.split_train, "train").when(b < p.split_train + p.split_val, "val").otherwise("test")
    return df.withColumn("split", s)


def feature_pipeline(cats: list[str] = CATS, nums: list[str] = NUMS):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="error", stringOrderType="alphabetAsc") for c in cats]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_ohe" for c in cats], dropLast=False)
    asm = VectorAssembler(inputCols=[f"{c}_ohe" for c in cats] + nums, outputCol="features")
    return Pipeline(stages=[*idx, ohe, asm])


def _prep(df: DataFrame) -> DataFrame:
    # StringIndexer needs strings; numbers of the categorical set are labels
    return df.withColumns({c: F.col(c).cast("string") for c in CATS}).withColumns(
        {c: F.col(c).cast("double") for c in NUMS}
    )


@dataclass
class Fitted:
    features: object        # fitted feature PipelineModel
    model: object           # GBTRegressionModel of the kept trees
    base: float             # mean label: the prediction before the first tree
    n_trees: int            # trees kept
    errors: list[float]     # validation error after each fitted tree
    metrics: DataFrame      # one row: n, R2, MAE, RMSE on the test split

    def predict(self, x: DataFrame) -> DataFrame:
        return self.model.transform(x).withColumn("prediction", F.col("prediction") + F.lit(self.base))


def _ensemble(spark, trees: list, step: float):
    """A Spark GBT model of the trees, each weighted by the step."""
    from pyspark.ml.regression import GBTRegressionModel

    sc = spark.sparkContext
    ml = sc._jvm.org.apache.spark.ml.regression
    ts = sc._gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    ws = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, t in enumerate(trees):
        ts[i], ws[i] = t._java_obj, float(step)
    java = ml.GBTRegressionModel(f"gbt_{len(trees)}_trees", ts, ws)
    return GBTRegressionModel(java).setFeaturesCol("features").setPredictionCol("prediction")


def numbered(df: DataFrame) -> DataFrame:
    """Add ``_row`` (hash of the row key) and ``_nth`` (among rows of one hash), together a key of the row.

    Both come from the values alone, so that a stage computed again numbers its
    rows alike; rows equal in every used column may change places."""
    order = list(dict.fromkeys([*ROW_KEY, *CATS, *NUMS, LABEL]))
    df = df.withColumn("_row", F.xxhash64(*ROW_KEY))
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy("_row").orderBy(*order)))


def with_state(x: DataFrame, state: DataFrame) -> DataFrame:
    """The feature rows with the prediction so far. Both sides are stored by ``ROW``: no exchange."""
    return x.join(state.select(*ROW, "_at"), ROW)


def fit_gbt(daily: DataFrame, p: PlanParams, seed: int = 0) -> Fitted:
    spark = daily.sparkSession
    n = daily.count()
    if n > FEW_ROWS:
        return _fit_packed(daily, p, n)
    with _SETTING:
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        with shuffle_partitions(spark, max(1, min(most, -(-n // PART_ROWS)))):
            return _fit(daily, p, seed)


def _fit_packed(daily: DataFrame, p: PlanParams, n: int) -> Fitted:
    """The same boosting over packed rows (``boosting.py``)."""
    spark = daily.sparkSession
    d = hash_split(_prep(daily), ROW_KEY, p).withColumn(LABEL, F.col(LABEL).cast("double"))
    fm = feature_pipeline().fit(d)
    places, side = [f"{c}_idx" for c in CATS], F.when(F.col("split") == "train", boosting.TRAIN).when(F.col("split") == "val", boosting.VAL)
    x, _ = land_table(fm.transform(numbered(d)).select(*ROW, *places, *NUMS, "features", LABEL, "split", side.alias("_side")), "gbt_rows")
    train = x.filter("split = 'train'")
    base, known, rows = train.agg(F.avg(LABEL), F.count(F.when(F.col(LABEL).isNotNull() & ~F.isnan(LABEL), 1)), F.count(F.lit(1))).first()
    if known < rows:
        raise ValueError(f"{rows - known} training rows have no {LABEL}")
    bins = boosting.Bins([len(m.labels) for m in fm.stages[: len(CATS)]], [boosting.number_cuts(train, c, min(p.gbt_max_bins, rows)) for c in NUMS], rows)
    # dealt and ordered by value, so that a part computed again is the same
    parts = 1 if n <= boosting.LOCAL_ROWS else min(-(-n // boosting.PART_ROWS), spark.sparkContext.defaultParallelism)
    dealt = x.filter((F.col("split") == "train") | F.col(LABEL).isNotNull()).repartition(parts, *ROW).sortWithinPartitions(*ROW)
    plan = boosting.Plan(bins, float(base or 0.0), p.gbt_max_iter, p.gbt_max_depth, p.gbt_step, p.gbt_patience, p.gbt_block)
    got = boosting.boost(boosting.packed(dealt, places, NUMS, LABEL, "_side", bins.cuts), plan, parts)
    f = Fitted(fm, boosting.as_spark_model(spark, got, bins, p.gbt_step), plan.base, len(got.trees), got.errors, None)
    f.metrics = regression_metrics(f.predict(x.filter("split = 'test'")), LABEL, "prediction")
    return f


def _fit(daily: DataFrame, p: PlanParams, seed: int) -> Fitted:
    from pyspark.ml.regression import DecisionTreeRegressor

    spark = daily.sparkSession
    d = hash_split(_prep(daily), ROW_KEY, p).withColumn(LABEL, F.col(LABEL).cast("double"))
    fm = feature_pipeline().fit(d)
    x, _ = land_table(fm.transform(numbered(d)).select(*ROW, "features", LABEL, "split"), "gbt_rows", by=ROW)
    base = x.filter("split = 'train'").agg(F.avg(LABEL)).first()[0] or 0.0
    fitter = DecisionTreeRegressor(
        featuresCol="features", labelCol="_residual", predictionCol="_tree", maxDepth=p.gbt_max_depth, maxBins=p.gbt_max_bins, seed=seed,
    )
    now, trees, errors, block = x.withColumn("_at", F.lit(float(base))), [], [], []
    while len(trees) < p.gbt_max_iter and len(errors) - _best(errors) <= p.gbt_patience:
        curve, kept = [], []
        for _ in range(min(p.gbt_block, p.gbt_max_iter - len(trees))):
            train = now.filter("split = 'train'").withColumn("_residual", F.col(LABEL) - F.col("_at"))
            trees.append(fitter.fit(train))
            now = trees[-1].transform(now).withColumn("_at", F.col("_at") + F.lit(p.gbt_step) * F.col("_tree")).drop("_tree")
            e = F.col(LABEL) - F.col("_at")
            curve.append(f"_e{len(trees)}")
            now = now.withColumn(curve[-1], F.when(F.col("split") == "val", e * e)).persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(now)  # filled by the next pass, from the one before it; older ones go
            if len(kept) > 2:
                kept.pop(0).unpersist()
        # a block lands predictions (and errors of validation rows), no features, so that
        # the trees before it are not replayed; the block before it goes
        state, table = land_table(now.select(*ROW, "_at", *curve), "gbt_block", by=ROW)
        for k in kept:
            k.unpersist()
        drop_tables(spark, block)
        block = [table]
        errors += [r if r is not None else 0.0 for r in state.agg(*[F.avg(c) for c in curve]).first()]
        now = with_state(x, state)
    drop_tables(spark, block)
    n = _best(errors)
    f = Fitted(fm, _ensemble(spark, trees[:n], p.gbt_step), float(base), n, errors, None)
    f.metrics = regression_metrics(f.predict(x.filter("split = 'test'")), LABEL, "prediction")
    return f


_best = boosting.best_of


def unseen(f: Fitted, warm: DataFrame) -> dict[str, list[str]]:
    """Levels of the plan rows that the features were not fitted on, by column (at most 20 each)."""
    labels = {m.getInputCol(): list(m.labels) for m in f.features.stages[: len(CATS)]}
    new = _prep(warm).agg(*[F.slice(F.collect_set(F.when(~F.col(c).isin(labels[c]), F.col(c))), 1, 20).alias(c) for c in CATS]).first()
    return {c: sorted(new[c]) for c in CATS if new[c]}


def score(f: Fitted, warm: DataFrame) -> DataFrame:
    """Predict the warm plan rows (M7); unseen categories are an error that names them."""
    if new := unseen(f, warm):
        raise ValueError(f"plan rows have levels without history: {new}")
    x = f.features.transform(_prep(warm))
    y = f.predict(x)
    # the plan rows keep their column types
    return y.select(*[F.col(c).cast(warm.schema[c].dataType).alias(c) for c in warm.columns], F.col("prediction").alias("prediccion"))


@dataclass
class GbtForecaster:
    """A ``DemandPlan`` forecaster: fit on the banded daily set, score warm rows."""

    p: PlanParams
    seed: int = 0

    def __call__(self, banded: DataFrame, warm: DataFrame) -> DataFrame:
        return score(fit_gbt(banded, self.p, self.seed), warm)

    def each(self, pairs: list[tuple[DataFrame, DataFrame]]) -> list[DataFrame]:
        """A forecast a pair, ``AT_ONCE`` models fitted at a time: one alone leaves cores idle between its jobs."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(lambda pair: self(*pair), pairs))


def gbt_forecaster(p: PlanParams, seed: int = 0) -> GbtForecaster:
    return GbtForecaster(p, seed)
