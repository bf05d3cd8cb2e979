"""Exact top-k search by distributed histogram selection.

Scores are integer inner products of quantised vectors. Every (candidate block,
query block) pair is scored in one task; tasks send histograms of the scores,
which are summed over all candidates to find the histogram bin that holds each
query's k-th score. The bin is refined until it is one score wide, then rows at
or above the k-th score are kept and ties go to the smaller id. Blocks have a
fixed size, so a task's memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land, python_workers
from .vectors import matrix, packed_vectors

SCALE = 64
CANDIDATES, QUERIES, BINS, STRIP = 4096, 2048, 256, 128


def _quantised(scale: int):
    def change(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = np.floor(scale * m)
        fits = (np.abs(q) < 2**31).all(axis=1)
        return np.where(fits[:, None], q, 0).astype(np.int32), fits

    return change


def _strips(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """(queries, ids of the candidates, exact scores with the query's own rows masked out) of a block pair, some queries at a time."""
    q, c = pdf[pdf["is_query"]], pdf[~pdf["is_query"]]
    if not len(q) or not len(c):
        return
    qm, cm, ids = matrix(q["v"], np.int32), matrix(c["v"], np.int32), c["id"].to_numpy()
    top = float(np.abs(qm).max()) * float(np.abs(cm).max()) * qm.shape[1]
    kind = np.float32 if top < 2**24 else np.float64 if top < 2**53 else np.int64
    ct = cm.astype(kind).T
    for a in range(0, len(q), STRIP):
        part = q.iloc[a : a + STRIP]
        s = (qm[a : a + STRIP].astype(kind) @ ct).astype(np.int64)
        s[part["id"].to_numpy()[:, None] == ids[None, :]] = np.iinfo(np.int64).min
        yield part, ids, s


def _histograms(width: int, n_bins: int, k: int):
    """Per query of a block pair: (id, bin, n) of its scores in n_bins bins from its ``lo`` on."""

    def histograms(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, _, s in _strips(pdf):
            lo = part["lo"].to_numpy()[:, None]
            at = np.where(s < lo, -1, (s - np.minimum(lo, s)) // width)
            at[at >= n_bins] = -1
            counts = np.bincount((at + np.arange(len(part))[:, None] * (n_bins + 1) + 1).ravel(), minlength=len(part) * (n_bins + 1)).reshape(len(part), -1)[:, 1:]
            # the k-th of all is no lower than the k-th here: lower bins cannot hold it
            higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            i, j = np.nonzero((counts > 0) & (higher < k))
            out.append(pd.DataFrame({"id": part["id"].to_numpy()[i], "bin": j.astype(np.int64), "n": counts[i, j]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "bin": [], "n": []}).astype("int64")

    return histograms


def top_k(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k highest scores.

    is_query: a condition on the column ``id`` (the key as long).

    Candidates of a query: every row of its length but those with its own id;
    all of them, if fewer than k. Vectors that are null or empty, hold a null or
    non-finite component, or a quantised component beyond 31 bits, and rows with
    a null id take no part. Repeated candidate rows each count; of query rows
    with one id the smallest vector asks. No rows: no rows.
    """
    python_workers(df.sparkSession)
    rows = land(packed_vectors(df.where(F.col(key).isNotNull()), key, vector, _quantised(scale)), "topk_vectors")
    asking = rows.where(is_query)
    asking = land(asking.groupBy("id", "dim").agg(F.min("v").alias("v")).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("m")).select("id", "m.dim", "m.v"), "topk_queries")
    n, nq = rows.count(), asking.count()
    cb, qb = max(1, -(-n // CANDIDATES)), max(1, -(-nq // QUERIES))
    # the largest score is at most the largest squared norm
    norm = rows.mapInPandas(lambda bs: (pd.DataFrame({"m": [float((matrix([v], np.int32).astype(np.float64) ** 2).sum()) for v in b["v"]]}) for b in bs), "m double").agg(F.max("m")).first()[0]
    most = int(norm or 0) + 1
    width = max(1, -(-(2 * most + 1) // BINS))
    block = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    zero = F.lit(0).cast("long")
    right = rows.select("dim", block(cb).alias("cb"), "id", "v").select("dim", "cb", every(qb).alias("qb"), F.lit(False).alias("is_query"), "id", "v", zero.alias("lo"), zero.alias("above"))

    def paired(spec: DataFrame) -> DataFrame:
        left = spec.select("dim", block(qb).alias("qb"), "id", "v", "lo", "above")
        left = left.select("dim", every(cb).alias("cb"), "qb", F.lit(True).alias("is_query"), "id", "v", "lo", "above")
        return right.unionByName(left).groupBy("dim", "cb", "qb")

    spec = asking.withColumns({"lo": F.lit(-most).cast("long"), "above": zero})
    n_bins = BINS
    while True:
        bins = paired(spec).applyInPandas(_histograms(width, n_bins, k), "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin"))  # at most BINS rows a query
        bins = bins.withColumn("_upto", F.sum("n").over(down))
        bins = spec.join(bins, "id").where((F.col("_upto") - F.col("n") + F.col("above")) < k)
        # the last of these bins holds the k-th score, or is the lowest there is
        found = bins.groupBy("id").agg(F.min(F.struct("bin", (F.col("_upto") - F.col("n")).alias("over"))).alias("b"))
        spec = land(spec.join(found, "id").select("id", "dim", "v", (F.col("lo") + F.col("b.bin") * width).alias("lo"), (F.col("above") + F.col("b.over")).alias("above")), "topk_spec")
        if width == 1:
            break
        finer = -(-width // BINS)
        width, n_bins = finer, -(-width // finer)

    def reached(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, ids, s in _strips(pdf):
            for i, (qid, lo) in enumerate(zip(part["id"], part["lo"])):
                j = np.flatnonzero(s[i] >= lo)
                j = j[np.lexsort((ids[j], -s[i, j]))[:k]]
                out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[j], "score": s[i, j]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    hits = paired(spec).applyInPandas(reached, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
