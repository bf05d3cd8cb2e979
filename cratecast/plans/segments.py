"""Client segments per business unit.

For each unit, k-means is fitted on the clients' mix vectors for every k in
``k_min..k_max`` (capped at n - 1 clients) and several seeds; per k the run
with the lowest training cost is kept, k is chosen by the highest mean
silhouette (ties to the smaller k), and clients get that run's clusters.

All runs (unit, k, seed) go through the data together: vectors are packed into
blocks once, and a pass (one Spark job) serves every run that has not yet
converged. A task meets each block with the centres of its unit's runs, a few
megabytes in a broadcast, and the partial sums are added up by run. So the
number of jobs is that of the slowest run, not the sum over all runs.
Differences from the original: the k-means|| start replaces k-means++ with
``n_init``, and the silhouette is the squared-Euclidean one, which needs sums
per cluster only (the plain Euclidean one needs all point pairs).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import PlanParams

#: Rows of a block, blocks of a large part, passes of the k-means|| start, and the move (squared) below which a centre stands still.
BLOCK, BLOCKS, INIT_STEPS, STILL = 2048, 32, 2, 1e-8
_U = np.uint64


@dataclass
class Segments:
    scores: DataFrame        # (UNE, k, silhouette, cost, chosen)
    assignments: DataFrame   # (UNE, ClienteClave, Cluster)


@dataclass
class Run:
    """One fit: a unit, a number of clusters and a seed."""

    une: str
    k: int
    seed: int
    centres: np.ndarray | None = field(default=None, repr=False)
    cost: float = 0.0


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(keys: np.ndarray, run: Run, step: int) -> np.ndarray:
    """A number in [0, 1) for each key, run and step: from the values alone, so that it does not depend on partitions."""
    salt = _mixed(np.array([(run.seed << 20) + (run.k << 8) + step + 1], dtype=_U))
    return (_mixed(keys ^ salt) >> _U(11)).astype(np.float64) / float(1 << 53)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, from 0."""
    d = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", centres, centres)[None, :] - 2.0 * (x @ centres.T)
    return np.maximum(d, 0.0)


def packed(vectors: DataFrame) -> DataFrame:
    """(UNE, keys, hashes, x): the vectors of a unit in blocks of ``BLOCK`` rows at most, components as doubles."""
    from pyspark.ml.functions import vector_to_array

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for une, g in b.groupby("UNE", sort=True):
                for s in range(0, len(g), BLOCK):
                    p = g.iloc[s : s + BLOCK]
                    x = np.stack([np.asarray(v, dtype=np.float64) for v in p["x"]])
                    yield pd.DataFrame({"UNE": [une], "keys": [p["ClienteClave"].tolist()], "hashes": [p["h"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()]})

    rows = vectors.select("UNE", "ClienteClave", F.xxhash64("ClienteClave").alias("h"), vector_to_array("features").alias("x"))
    return rows.mapInPandas(pack, "UNE string, keys array<string>, hashes binary, x binary")


def _block(row) -> tuple[str, np.ndarray, np.ndarray]:
    h = np.frombuffer(row["hashes"], dtype=_U)
    return row["UNE"], h, np.frombuffer(row["x"], dtype=np.float64).reshape(len(h), -1)


def _by_run(sc, blocks, runs: list[Run], visit) -> dict[int, tuple]:
    """One pass: visit(keys, rows, runs of the block's unit) yields (run, tuple of arrays); tuples are added up by run."""
    shared = sc.broadcast({u: [(i, r) for i, r in enumerate(runs) if r.une == u] for u in {r.une for r in runs}})

    def part(rows):
        acc: dict[int, list] = {}
        for une, h, x in map(_block, rows):
            mine = shared.value.get(une)
            if mine:
                for i, got in visit(h, x, mine):
                    acc[i] = [a + b for a, b in zip(acc[i], got)] if i in acc else list(got)
        return acc.items()

    try:
        return dict(blocks.mapPartitions(part).reduceByKey(lambda a, b: [x + y for x, y in zip(a, b)]).collect())
    finally:
        shared.destroy()


def _each(x: np.ndarray, mine: list) -> Iterator[tuple[int, Run, np.ndarray]]:
    """Squared distances of the rows to each run's centres, by one product for all runs of the unit."""
    d, at = _distances(x, np.concatenate([r.centres for _, r in mine])), 0
    for i, r in mine:
        yield i, r, d[:, at : at + len(r.centres)]
        at += len(r.centres)


def _costs(h, x, mine):
    for i, _, d in _each(x, mine):
        yield i, (d.min(axis=1).sum(),)


def _sizes(h, x, mine):
    for i, r, d in _each(x, mine):
        yield i, (np.bincount(d.argmin(axis=1), minlength=len(r.centres)).astype(np.float64),)


def _sums(h, x, mine):
    """Per run the rows' sum and number by nearest centre: one product of the rows and the 0/1 matrix of all runs."""
    at, hit = 0, np.zeros((len(x), sum(len(r.centres) for _, r in mine)))
    for _, r, d in _each(x, mine):
        hit[np.arange(len(x)), at + d.argmin(axis=1)] = 1.0
        at += len(r.centres)
    sums, n, at = hit.T @ x, hit.sum(axis=0), 0
    for i, r in mine:
        k = len(r.centres)
        yield i, (sums[at : at + k], n[at : at + k])
        at += k


def _groups(h, x, mine):
    """Per run and cluster: number, sum and sum of squared norms of its rows; and the run's cost."""
    sq = np.einsum("ij,ij->i", x, x)
    for i, r, d in _each(x, mine):
        to, k = d.argmin(axis=1), len(r.centres)
        hit = np.zeros((len(x), k))
        hit[np.arange(len(x)), to] = 1.0
        yield i, (np.bincount(to, minlength=k).astype(np.float64), hit.T @ x, np.bincount(to, sq, k), d.min(axis=1).sum())


def _local(cand: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator, steps: int = 30) -> np.ndarray:
    """k centres of the weighted candidates of a start: k-means++, then k-means, on a few rows a run."""
    c = cand[[rng.choice(len(cand), p=weight / weight.sum())]]
    while len(c) < k:
        p = weight * _distances(cand, c).min(axis=1)
        if not p.sum() > 0:
            break
        c = np.concatenate((c, cand[[rng.choice(len(cand), p=p / p.sum())]]))
    before = None
    for _ in range(steps):
        to = _distances(cand, c).argmin(axis=1)
        if before is not None and (to == before).all():
            break
        before = to
        for j in range(len(c)):
            w = weight[to == j]
            if w.sum() > 0:
                c[j] = (cand[to == j] * w[:, None]).sum(axis=0) / w.sum()
    return c


def _start(sc, blocks, runs: list[Run]) -> None:
    """k-means||: a random row, two passes that draw rows by their distance, and the drawn rows, weighted, reduced to k."""

    def first(h, x, mine):
        for i, r in mine:
            u = _uniform(h, r, 0)
            j = int(u.argmin())
            yield i, (_Least(u[j], x[j].copy()),)

    for i, (best,) in _by_run(sc, blocks, runs, first).items():
        runs[i].centres = best.row[None, :]
    for step in range(1, INIT_STEPS + 1):
        costs = {i: c for i, (c,) in _by_run(sc, blocks, runs, _costs).items()}

        def drawn(h, x, mine, step=step, costs=costs):
            for i, r, d in _each(x, mine):
                take = _uniform(h, r, step) * costs[i] < 2.0 * r.k * d.min(axis=1)
                if take.any():
                    yield i, (_Rows([x[take]]),)

        for i, (rows,) in _by_run(sc, blocks, runs, drawn).items():
            new = np.concatenate([runs[i].centres, *rows.parts])
            runs[i].centres = np.unique(new, axis=0)
    for i, (n,) in _by_run(sc, blocks, runs, _sizes).items():
        r = runs[i]
        if len(r.centres) > r.k:
            r.centres = _local(r.centres, n, r.k, np.random.default_rng([r.seed, r.k]))


class _Least:
    """The row of the smallest number; adding keeps the smaller."""

    def __init__(self, u: float, row: np.ndarray):
        self.u, self.row = u, row

    def __add__(self, other: _Least) -> _Least:
        return self if self.u <= other.u else other


class _Rows:
    """Drawn rows (about 2k a run and pass); adding joins them."""

    def __init__(self, parts: list[np.ndarray]):
        self.parts = parts

    def __add__(self, other: _Rows) -> _Rows:
        return _Rows(self.parts + other.parts)


def _lloyd(sc, blocks, runs: list[Run], steps: int) -> None:
    """Move the centres to the means of their rows until none moves; a run that stands still leaves the passes."""
    todo = runs
    for _ in range(steps):
        got, still = _by_run(sc, blocks, todo, _sums), []
        for i, r in enumerate(todo):
            sums, n = got[i]
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1.0)[:, None], r.centres)
            if (((new - r.centres) ** 2).sum(axis=1) > STILL).any():
                still.append(r)
            r.centres = new
        todo = still
        if not todo:
            break


def _silhouettes(sc, blocks, runs: list[Run], groups: dict[int, tuple]) -> dict[int, float]:
    """Mean squared-Euclidean silhouette of each run, from the number, sum and squared norms of its clusters."""

    def visit(h, x, mine):
        sq = np.einsum("ij,ij->i", x, x)[:, None]
        for i, _, d in _each(x, mine):
            n, sums, norms, _ = groups[i]
            own, size = d.argmin(axis=1), np.maximum(n, 1.0)
            mean = np.where(n > 0, np.maximum(sq + (norms / size)[None, :] - 2.0 * (x @ (sums / size[:, None]).T), 0.0), np.inf)
            me = np.arange(len(x))
            a = mean[me, own] * n[own] / np.maximum(n[own] - 1.0, 1.0)
            mean[me, own] = np.inf
            b = mean.min(axis=1)
            s = np.where((n[own] > 1) & (np.maximum(a, b) > 0), (b - a) / np.where(np.maximum(a, b) > 0, np.maximum(a, b), 1.0), 0.0)
            yield i, (s.sum(), float(len(x)))

    return {i: float(s / n) for i, (s, n) in _by_run(sc, blocks, runs, visit).items()}


def _fit_all(blocks, sc, counts: list[tuple[str, int]], p: PlanParams) -> tuple[list[tuple], dict[str, np.ndarray]]:
    """Score rows (une, k, silhouette, cost, chosen), and the centres of each unit's chosen run."""
    runs = [Run(une, k, seed) for une, n in counts for k in range(p.k_min, min(p.k_max, n - 1) + 1) for seed in p.kmeans_seeds]
    if not runs:
        return [], {}
    _start(sc, blocks, runs)
    _lloyd(sc, blocks, runs, p.kmeans_max_iter)
    for i, (cost,) in _by_run(sc, blocks, runs, _costs).items():
        runs[i].cost = float(cost)
    best: dict[tuple[str, int], Run] = {}
    for r in runs:  # in (unit, k, seed) order: a tie keeps the lower seed
        if (r.une, r.k) not in best or r.cost < best[r.une, r.k].cost * (1 - 1e-9):
            best[r.une, r.k] = r
    kept = list(best.values())
    groups = _by_run(sc, blocks, kept, _groups)
    if any((g[0] > 0).sum() < 2 for g in groups.values()):
        raise ValueError("Number of clusters must be greater than one.")
    sil = _silhouettes(sc, blocks, kept, groups)
    rows, chosen = [], {}
    for une, _ in counts:
        mine = [(i, r) for i, r in enumerate(kept) if r.une == une]
        if mine:
            _, top = max(mine, key=lambda t: (sil[t[0]], -t[1].k))
            chosen[une] = top.centres
            rows += [(une, r.k, sil[i], r.cost, r is top) for i, r in mine]
    return rows, chosen


def canonical_labels(assign: DataFrame) -> DataFrame:
    """Renumber clusters 0.. by their smallest member key, so that the same
    partition of clients always gets the same labels. The window runs over
    the k clusters of a unit only."""
    from pyspark.sql import Window as W

    first = assign.groupBy("UNE", "Cluster").agg(F.min("ClienteClave").alias("_m"))
    first = first.withColumn("_c", (F.row_number().over(W.partitionBy("UNE").orderBy("_m")) - 1).cast("int"))
    return assign.join(first, ["UNE", "Cluster"]).select("UNE", "ClienteClave", F.col("_c").alias("Cluster"))


def assigned(blocks: DataFrame, chosen: dict[str, np.ndarray]) -> DataFrame:
    """(UNE, ClienteClave, Cluster) of every row of the blocks: its nearest centre; 0 in a unit without centres."""
    shared = blocks.sparkSession.sparkContext.broadcast(chosen)

    def to(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.to_dict("records"):
                une, _, x = _block(row)
                c = shared.value.get(une)
                near = _distances(x, c).argmin(axis=1) if c is not None else np.zeros(len(x), dtype=np.int64)
                yield pd.DataFrame({"UNE": une, "ClienteClave": list(row["keys"]), "Cluster": near.astype(np.int32)})

    return blocks.mapInPandas(to, "UNE string, ClienteClave string, Cluster int")


def fit_segments(vectors: DataFrame, p: PlanParams, parallelism: int = 8) -> Segments:
    """Segments of the vectors (UNE, ClienteClave, features). ``parallelism``: kept for callers; all runs go together."""
    from ..session import materialize, share_package

    spark, sc = vectors.sparkSession, vectors.sparkSession.sparkContext
    share_package(spark)
    rows = materialize(vectors.select("UNE", "ClienteClave", "features"), "segment_vectors")
    counts = [tuple(r) for r in rows.groupBy("UNE").count().orderBy("UNE").collect()]  # one row per business unit
    # a part for every core where there are rows enough; large ones beyond, as each part sends the sums of all runs
    n = sum(n for _, n in counts)
    parts = max(1, min(sc.defaultParallelism, n // BLOCK), n // (BLOCK * BLOCKS))
    landed = materialize(packed(rows.repartition(parts, F.xxhash64("ClienteClave"))), "segment_blocks")
    blocks = landed.select("UNE", "hashes", "x").rdd.map(lambda r: {"UNE": r["UNE"], "hashes": bytes(r["hashes"]), "x": bytes(r["x"])}).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scored, chosen = _fit_all(blocks, sc, counts, p)
    finally:
        blocks.unpersist()
    scores = spark.createDataFrame(scored, "UNE string, k int, silhouette double, cost double, chosen boolean")
    # pin the assignments (the labels follow from the whole set of clients)
    return Segments(scores, materialize(canonical_labels(assigned(landed, chosen)), "segments"))


def kmeans_segmenter(p: PlanParams, parallelism: int = 8):
    """A ``DemandPlan`` segmenter using per-unit k-means on the mix vectors."""
    from .mix import mix_vectors

    def run(mix_long: DataFrame, sales: DataFrame) -> DataFrame:
        return fit_segments(mix_vectors(mix_long), p, parallelism).assignments

    return run
