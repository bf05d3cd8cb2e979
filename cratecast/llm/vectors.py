"""Vectors packed as bytes, so that a shuffle and a worker handle them whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed_vectors(df: DataFrame, key: str, vector: str, change: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], most: int = 100_000) -> DataFrame:
    """(id long, dim int, v binary) of the rows whose vector is usable.

    Null vectors, empty ones and those with a null or non-finite component are
    left out; ``change`` maps a float64 matrix to (matrix to pack, mask of rows to keep).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, col = b.column(0), b.column(1)
            if not len(col):
                continue
            start = np.asarray(col.offsets)
            flat = np.asarray(col.values.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
            size, there = np.diff(start), np.asarray(col.is_valid())
            for dim in np.unique(size[there & (size > 0)]).tolist():
                rows = np.flatnonzero(there & (size == dim))
                m = flat[start[rows][:, None] + np.arange(dim)]
                good = np.isfinite(m).all(axis=1)
                rows, m = rows[good], m[good]
                out, keep = change(m)
                rows, out = rows[keep], np.ascontiguousarray(out[keep])
                if len(rows):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)), pa.array([r.tobytes() for r in out], pa.binary())], names=["id", "dim", "v"])

    return df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(pack, "id long, dim int, v binary")


def matrix(column, dtype) -> np.ndarray:
    """The packed vectors of a column (all of one length) as a matrix."""
    column = list(column)
    return np.frombuffer(b"".join(column), dtype=dtype).reshape(len(column), -1)
