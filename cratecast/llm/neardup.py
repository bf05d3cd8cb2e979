"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors are rotated and split into low-dimensional blocks. If two unit
vectors have cosine c or more, their squared distance is at most 2 - 2c, and in
one block at least it is at most that block's proportional share of it. So each
block is range-joined under its own budget: vectors are cut into chunks of the
block's first coordinate (bounds from quantiles, so a chunk has about ``chunk``
rows however the values crowd), chunks within reach of each other meet pair by
pair, and a pair of vectors is verified exactly, on the vectors as given, in
the first block whose budget it meets. A task sees two chunks at most and
returns link counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land, python_workers
from .components import components
from .vectors import matrix, packed_vectors

COSINE = 0.9
BLOCK_DIMS, CHUNK, STRIP, PAIRS = 16, 8192, 512, 100_000
#: Relative slack of a block's budget: far above rounding, far below any budget.
SLACK = 1e-9


def _usable(kind: type):
    def change(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return m.astype(kind), (m != 0).any(axis=1)

    return change


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    """A random orthogonal matrix, the same for a dimension everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return np.ascontiguousarray(q * np.sign(np.diag(r)))


def block_starts(dim: int, block_dims: int) -> np.ndarray:
    return np.array([x[0] for x in np.array_split(np.arange(dim), max(1, dim // block_dims))])


def _units(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def _rotated(units: np.ndarray, seed: int) -> np.ndarray:
    # einsum without BLAS: a row's result does not depend on the other rows
    return np.einsum("ij,jk->ik", units, rotation(units.shape[1], seed))


def _roots(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the trees of i and j (arrays of nodes); every node ends up at its root."""
    while True:
        a, b = parent[i], parent[j]
        if (a == b).all():
            return parent
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def links(cls: DataFrame, kind: type, cosine: float, block_dims: int, chunk: int, seed: int) -> DataFrame:
    """(kind, a, b) rows: kind 0: class a has b more linked rows; kind 1: a and b are in one component.

    cls: rep (long), dim, v (distinct vectors packed as ``kind``), w (rows of the class).
    """
    spark = cls.sparkSession
    radius2 = 2.0 - 2.0 * cosine

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.asarray(b.column("dim"))
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                u = _rotated(_units(matrix(b.column("v").take(pa.array(rows)).to_pylist(), kind).astype(np.float64)), seed)
                c = np.ascontiguousarray(u[:, block_starts(dim, block_dims)])
                part = b.take(pa.array(rows))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, c.size + 1, c.shape[1]), pa.int32()), pa.array(c.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "c"])

    placed = land(cls.select("rep", "dim", "w", "v").mapInArrow(leading, "rep long, dim int, w long, v binary, c array<double>"), "near_placed")
    bounds: dict[int, list[np.ndarray]] = {}
    for row in placed.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect():
        k, m = -(-row["n"] // chunk), len(block_starts(row["dim"], block_dims))
        cuts = [i / k for i in range(1, k)]
        got = placed.where(F.col("dim") == row["dim"]).agg(*[F.percentile_approx(F.col("c")[i], cuts, max(10_000, 20 * k)) for i in range(m)]).first() if cuts else [[]] * m
        bounds[row["dim"]] = [np.unique(np.asarray(x, dtype=np.float64)) for x in got]
    # 8 bytes a chunk and block: the number of distinct vectors / chunk * blocks
    shared = spark.sparkContext.broadcast(bounds)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.asarray(b.column("dim"))
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                n_blocks = len(block_starts(dim, block_dims))
                c = np.array(b.column("c").take(pa.array(rows)).flatten()).reshape(len(rows), n_blocks)
                sizes = np.diff(np.append(block_starts(dim, block_dims), dim))
                for blk in range(n_blocks):
                    reach, cut = np.sqrt(radius2 * sizes[blk] / dim) * (1 + 1e-6) + 1e-9, shared.value[dim][blk]
                    home = np.searchsorted(cut, c[:, blk], side="right")
                    lo, hi = np.searchsorted(cut, c[:, blk] - reach, side="right"), np.searchsorted(cut, c[:, blk] + reach, side="right")
                    n = hi - lo + 1
                    at = np.repeat(np.arange(len(rows)), n)
                    other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[at]
                    for a in range(0, len(at), 20_000):
                        i, o = at[a : a + 20_000], other[a : a + 20_000]
                        pick, h = pa.array(rows[i]), home[i]
                        col = lambda x, t=pa.int32(): pa.array(np.asarray(x), t)
                        yield pa.RecordBatch.from_arrays([col(np.full(len(i), dim)), col(np.full(len(i), blk)), col(np.minimum(h, o)), col(np.maximum(h, o)), col((h > o).astype(np.int32)), b.column("rep").take(pick), b.column("w").take(pick), b.column("v").take(pick)], names=["dim", "blk", "a", "b", "side", "rep", "w", "v"])

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, blk = int(pdf["dim"].iloc[0]), int(pdf["blk"].iloc[0])
        same = bool((pdf["a"] == pdf["b"]).all())
        pdf = pdf.sort_values(["side", "rep"], kind="stable")
        unit = _units(matrix(pdf["v"], kind).astype(np.float64))
        rot = _rotated(unit, seed)
        starts = block_starts(dim, block_dims)
        budget = radius2 * np.diff(np.append(starts, dim)) / dim * (1 + SLACK) + 1e-15
        part = rot[:, starts[blk] : np.append(starts, dim)[blk + 1]].astype(np.float32)
        sq = np.einsum("ij,ij->i", part, part)
        n, w, ids = len(pdf), pdf["w"].to_numpy(), pdf["rep"].to_numpy()
        half = n if same else int((pdf["side"] == 0).sum())
        more, parent = np.zeros(n, dtype=np.int64), np.arange(n)
        for s in range(0, half, STRIP):
            x = np.arange(s, min(s + STRIP, half))
            y0 = s if same else half
            d = sq[x][:, None] + sq[None, y0:] - 2 * (part[x] @ part[y0:].T)
            i, j = np.nonzero(d <= np.float32(budget[blk] * 1.0001 + 1e-5))
            i, j = i + s, j + y0
            if same:
                i, j = i[i < j], j[i < j]
            for p in range(0, len(i), PAIRS):
                a, b = i[p : p + PAIRS], j[p : p + PAIRS]
                within = np.add.reduceat((rot[a] - rot[b]) ** 2, starts, axis=1) <= budget
                first = within.any(axis=1) & (within.argmax(axis=1) == blk)
                a, b = a[first], b[first]
                good = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
                a, b = a[good], b[good]
                if len(a):
                    more += np.bincount(a, w[b], n).astype(np.int64) + np.bincount(b, w[a], n).astype(np.int64)
                    parent = _roots(parent, a, b)
        linked, under = np.flatnonzero(more), np.flatnonzero(parent != np.arange(n))
        return pd.DataFrame({"kind": np.repeat([0, 1], [len(linked), len(under)]).astype("int32"), "a": np.concatenate((ids[linked], ids[under])), "b": np.concatenate((more[linked], ids[parent[under]]))})

    return placed.mapInArrow(dealt, "dim int, blk int, a int, b int, side int, rep long, w long, v binary").groupBy("dim", "blk", "a", "b").applyInPandas(met, "kind int, a long, b long")


def near_duplicates(df: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", block_dims: int = BLOCK_DIMS, chunk: int = CHUNK, seed: int = 0) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Two vectors of one length link when their cosine in double precision is at
    least ``cosine``. Vectors that are null, empty or zero or hold a null or
    non-finite component link with nothing: n_links 0, their own component.
    Equal vectors are one class (cosine 1): a row links with the other rows of
    its class. Rows of one vec_id
    with different vectors all get the most links and the smallest component of
    them. Rows with a null vec_id have component null and are not kept;
    they link with nothing. No rows: no rows.
    """
    python_workers(df.sparkSession)
    rows = df.where(F.col(key).isNotNull())
    kind = np.float32 if df.schema[vector].dataType.elementType.typeName() == "float" else np.float64  # packing loses nothing
    good = land(packed_vectors(rows, key, vector, _usable(kind)), "near_vectors")
    cls = land(good.groupBy("dim", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")), "near_classes")
    found = land(links(cls, kind, cosine, block_dims, chunk, seed), "near_links")
    more = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("more"))
    comp = components(found.where("kind = 1").select("a", "b")).select(F.col("node").alias("rep"), "comp")
    per = cls.join(more, "rep", "left").join(comp, "rep", "left")
    per = land(per.select("dim", "v", (F.coalesce("more", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("comp", "rep").alias("component_id")), "near_result")
    linked = good.join(per, ["dim", "v"]).where("n_links > 0").groupBy(F.col("id").alias(key)).agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = df.select(F.col(key).cast("long").alias(key)).join(linked, key, "left")
    out = out.withColumns({"n_links": F.coalesce("n_links", F.lit(0).cast("long")), "component_id": F.coalesce("component_id", key)})
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False))).select(key, "n_links", "component_id", "kept")
