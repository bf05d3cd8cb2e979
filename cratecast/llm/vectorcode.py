"""Vector code compression (product quantisation) with LAESA pivots.

Vectors become integers and are cut into equal parts; each part position has a
codebook that a few rounds of integer means refine. Every position has fixed
pivots, chosen far apart among the first entries. A part's distances to its
pivots are computed once and landed beside the vector. In a round only the
pivots' distances to the entries are new: the difference of the two distances
is a lower bound of a part's distance to an entry. Entries are tried in the
order of that bound, and exact integer distances are evaluated until the bound
of all that is left exceeds the best one. Tasks send sums and counts per entry;
the driver holds codebooks only (parts x entries rows).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import broadcast_checked, land, python_workers

PARTS, ENTRIES, ROUNDS, PIVOTS, SCALE = 4, 256, 4, 8, 1024
_STRIP = 2048  # rows whose bounds are held at a time
_SLACK = 1e-6  # of the distances: more than what rounding to float32 takes
_LIMB = 40  # bits of a sum that travel in one long


def exact(entries: np.ndarray, limit: int) -> np.ndarray:
    """Integers as int64 if their squared distances fit there, else as Python integers."""
    return entries.astype(np.int64) if entries.size == 0 or max(-int(entries.min()), int(entries.max())) < limit else entries.astype(object)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances (rows, pivots) in double precision."""
    a, b = x.astype(np.float64), pivots.astype(np.float64)
    out = np.empty((len(a), len(b)))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(len(b)):
            out[:, j] = np.sqrt(((a - b[j]) ** 2).sum(axis=1))
    return out


def far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """At most n different rows: the first, then always the one farthest from those chosen."""
    chosen, gap = [0], distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(n, len(entries)):
        j = int(np.argmax(np.nan_to_num(gap, posinf=0.0)))
        if gap[j] <= 0:
            break
        chosen.append(j)
        gap = np.minimum(gap, distances(entries, entries[j : j + 1])[:, 0])
    return entries[chosen]


def nearest(x: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, ties to the lower index; squared distance; exact evaluations made) of each row."""
    n, k = len(x), len(entries)
    kind = object if object in (x.dtype, entries.dtype) else np.int64
    x, entries = x.astype(kind), entries.astype(kind)
    bound = np.zeros((n, k))
    with np.errstate(invalid="ignore"):
        for a, e in zip(to_pivots.T.astype(np.float64), entry_pivots.T):
            np.maximum(bound, np.abs(a[:, None] - e) - _SLACK * (a[:, None] + e), out=bound)
    bound[~np.isfinite(bound)] = 0  # no bound where a distance is too large for a float
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1) ** 2
    most = 1 << 62 if kind is np.int64 else 1 << 2200
    best, index, made = np.full(n, most, kind), np.full(n, k), 0
    rows, at, width = np.arange(n), 0, 1
    while at < k and len(rows):
        to = min(k, at + width)
        r, c = np.nonzero(bound[rows, at:to] <= best[rows][:, None])
        tried = order[rows, at:to]
        diff = entries[tried[r, c]] - x[rows[r]]
        grid = np.full(tried.shape, most, kind)
        grid[r, c] = (diff * diff).sum(axis=1)
        made += len(r)
        low = grid.min(axis=1)
        first = np.where(grid == low[:, None], tried, k).min(axis=1)
        better = ((low < best[rows]) | ((low == best[rows]) & (first < index[rows]))).astype(bool)
        best[rows[better]], index[rows[better]] = low[better], first[better]
        at, width = to, width * 4
        if at < k:
            rows = rows[(bound[rows, at] <= best[rows]).astype(bool)]
    return index, best, made


class _Coder:
    """Codebooks, pivots and what tasks do with them."""

    def __init__(self, books: np.ndarray, pivots: list[np.ndarray], limit: int):
        self.books = [exact(b, limit) for b in books]
        self.pivots, self.limit = pivots, limit
        self.between = [distances(b, p) for b, p in zip(books, pivots)]
        self.starts = np.cumsum([0] + [len(p) for p in pivots])

    def codes(self, b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """(row numbers, integers, per part (entry, squared distance)) of strips of a batch of landed rows."""
        dim = sum(x.shape[1] for x in self.books)
        vectors, near = b.column("v").to_pylist(), b.column("p").to_pylist()
        wide = np.array([len(v) == dim * 8 for v in vectors], bool)
        for kind in (False, True):
            rows = np.flatnonzero(wide == kind)
            for a in range(0, len(rows), _STRIP):
                part = rows[a : a + _STRIP]
                q = np.frombuffer(b"".join(vectors[i] for i in part), np.float64 if kind else np.int32).reshape(len(part), dim)
                q = np.array([[int(x) for x in r] for r in q], object).reshape(q.shape) if kind else q.astype(np.int64)
                p = np.frombuffer(b"".join(near[i] for i in part), np.float32).reshape(len(part), -1)
                cut = np.split(q, len(self.books), axis=1)
                yield part, q, [nearest(x, e, p[:, self.starts[j] : self.starts[j + 1]], self.between[j])[:2] for j, (x, e) in enumerate(zip(cut, self.books))]


def _limbs(values: list[int]) -> Iterator[list[int]]:
    """Signed integers, 40 bits of each at a time, until nothing is left."""
    while True:
        yield [(abs(x) & ((1 << _LIMB) - 1)) * (-1 if x < 0 else 1) for x in values]
        values = [(abs(x) >> _LIMB) * (-1 if x < 0 else 1) for x in values]
        if not any(values):
            return


def encoded(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector.

    Component x becomes floor(scale * x); the codebooks start as the parts of
    the vectors with the smallest ids (rows alike in id by their vector, null
    ids last), at most ``entries`` of them, and are the means, rounded down, of
    the parts nearest to each entry after every round; an unused entry stays.
    Ties go to the lower entry. code has two hex digits a part, so ``entries``
    is at most 256. error sums a row's squared distances, label_error the
    errors of all rows with its label (null labels are one), and the hash is of
    the final codebooks.

    Left out: vectors that are null or empty, that hold a null or non-finite
    component (or one that ``scale`` makes so), and those whose length is not
    that of the smallest id's or not divisible by ``parts``. Components of any
    finite size are exact; an error beyond 64 bits is null. Repeated rows each
    count. Other columns are ignored. No usable vectors: no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits a part: entries must be 1 to 256")
    spark = df.sparkSession
    python_workers(spark)
    finite = F.forall("v", lambda x: F.coalesce((F.abs(x.cast("double") * scale) < F.lit(float("inf"))), F.lit(False)))
    usable = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("y"), F.col(vector).alias("v"))
    usable = usable.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & finite)
    by_id = [F.asc_nulls_last("id"), "v"]
    first = usable.orderBy(*by_id).select(F.size("v")).first()
    columns = StructType([StructField("vec_id", LongType()), StructField("y", usable.schema["y"].dataType), StructField("code", StringType()), StructField("error", LongType())])
    dim = first[0] if first else parts
    limit = math.isqrt((1 << 62) // dim) // 2
    usable = usable.where(F.size("v") == dim)
    start = usable.orderBy(*by_id).limit(entries).select("v").collect()  # 256 vectors at most
    if not start:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = np.array([[math.floor(scale * float(x)) for x in r["v"]] for r in start], object).reshape(len(start), parts, dim // parts).transpose(1, 0, 2)
    fixed = [far_apart(b, pivots) for b in books]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            q = np.floor(scale * np.asarray(b.column("v").flatten().cast(pa.float64())).reshape(b.num_rows, dim))
            wide = (np.abs(q) >= limit).any(axis=1)
            with np.errstate(over="ignore"):
                near = np.hstack([distances(x, p) for x, p in zip(np.split(q, parts, axis=1), fixed)]).astype(np.float32)
            v = [x.tobytes() if w else x.astype(np.int32).tobytes() for x, w in zip(q, wide)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(v, pa.binary()), pa.array([x.tobytes() for x in near], pa.binary())], names=["id", "y", "v", "p"])

    landed = StructType([StructField("id", LongType()), usable.schema["y"], *[StructField(c, BinaryType()) for c in ("v", "p")]])
    rows = land(usable.mapInArrow(measured, landed), "code_vectors")

    sums = [f"s{j}" for j in range(dim // parts)]
    sent = StructType([StructField(c, IntegerType()) for c in ("part", "entry", "limb")] + [StructField(c, LongType()) for c in ("n", *sums)])
    for _ in range(rounds):
        coder = spark.sparkContext.broadcast((books, fixed, limit))

        def totals(batches: Iterator[pa.RecordBatch], coder=coder) -> Iterator[pa.RecordBatch]:
            c = _Coder(*coder.value)
            total, beyond = [np.zeros(b.shape, np.int64) for b in c.books], [np.zeros(b.shape, object) for b in c.books]
            count = [np.zeros(len(b), np.int64) for b in c.books]
            for b in batches:
                for _, q, got in c.codes(b):
                    for j, (x, (at, _)) in enumerate(zip(np.split(q, len(c.books), axis=1), got)):
                        count[j] += np.bincount(at, minlength=len(count[j]))
                        if x.dtype == object:
                            np.add.at(beyond[j], at, x)
                        else:
                            for i, column in enumerate(x.T):  # whole numbers below 2^53, so exact
                                total[j][:, i] += np.bincount(at, weights=column, minlength=len(count[j])).astype(np.int64)
            out = [(j, e, limb, int(count[j][e]) if limb == 0 else 0, *s) for j in range(len(total)) for e in np.flatnonzero(count[j]).tolist() for limb, s in enumerate(_limbs([int(a) + int(b) for a, b in zip(total[j][e], beyond[j][e])]))]
            if out:
                types = [pa.int32()] * 3 + [pa.int64()] * (len(sums) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=sent.names)

        got = rows.mapInArrow(totals, sent).groupBy("part", "entry", "limb").agg(*[F.sum(c).alias(c) for c in ("n", *sums)])
        summed: dict[tuple[int, int], list] = {}
        for r in got.collect():  # parts x entries codebook rows, one more for sums beyond 40 bits
            own = summed.setdefault((r["part"], r["entry"]), [0, [0] * len(sums)])
            own[0] += r["n"]
            own[1] = [a + (r[c] << (_LIMB * r["limb"])) for a, c in zip(own[1], sums)]
        books = books.copy()
        for (j, e), (n, s) in summed.items():
            books[j, e] = [x // n for x in s]
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    coder = spark.sparkContext.broadcast((books, fixed, limit))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _Coder(*coder.value)
        for b in batches:
            code, error = [""] * b.num_rows, [0] * b.num_rows
            for part, _, got in c.codes(b):
                for i, r in enumerate(part.tolist()):
                    code[r] = "".join("%02x" % at[i] for at, _ in got)
                    e = sum(int(d[i]) for _, d in got)
                    error[r] = e if e < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=columns.names)

    out = land(rows.mapInArrow(coded, columns), "code_rows")
    by_label = out.groupBy(F.col("y").alias("z")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("t"), F.count_if(F.col("error").isNull()).alias("beyond"))
    by_label = land(by_label.select("z", F.when(F.col("beyond") == 0, F.expr("try_cast(t as bigint)")).alias("label_error")), "code_labels")
    joined = out.join(broadcast_checked(by_label), F.col("y").eqNullSafe(F.col("z")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
