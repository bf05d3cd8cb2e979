"""Quality classifier by nearest-neighbour voting in a latent space.

A text is a bag of terms in two views: its words (hashed, A-Z as a-z) and its
character n-grams (trigrams of byte classes: lower, upper, digit, space, line
feed and kinds of punctuation, and words repeated at short distance). In each
view counts are damped, weighted by inverse document frequency over the
labelled sample and scaled to length 1. Both are projected on the leading
singular vectors of the labelled sample. The labelled latent vectors are
broadcast (at most ``max_labelled`` of them) and every document's exact cosines
to all of them are computed block by block; the nearest ``k`` vote, each
weighted by its cosine (a negative one counts as 0).

Terms stay sparse throughout: tasks send (term, count) pairs of the labelled
texts, and the driver factorises the sparse matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import python_workers
from .words import slices, word_hashes

#: Labelled documents that vote, at most; half of each label. This bounds the
#: model, the broadcast and the rows sent to the driver, not the documents scored.
MAX_LABELLED = 4000
NEIGHBOURS = 15
DIMENSIONS = 48
#: Weight of the word view against the shape view in a text's vector.
WORD_WEIGHT = 0.5
THRESHOLD = 0.3
#: Columns of a product at a time while the driver fits.
NARROW = 8

_KINDS = ["\x00 ", "\n", "\t\x0b\x0c\r", "0123456789", ".", ",;:", "!", "?", "|", "#*$%&@^~+=", "()[]{}<>/\\", "'\"`-_"]
_CLASS = np.full(256, 12, dtype=np.int64)
for _i, _chars in enumerate(_KINDS):
    _CLASS[[ord(x) for x in _chars]] = _i
_CLASS[np.r_[97:123]] = 13
_CLASS[np.r_[65:91]] = 14
_CLASS[np.r_[128:256]] = 13
_N = 15
_GRAMS = _N**3
_REPEATS = (1, 2, 3)
_SHAPES = _GRAMS + len(_REPEATS)
_WORD_BITS = 15
TERMS = _SHAPES + (1 << _WORD_BITS)


@dataclass(frozen=True)
class Bags:
    """Sparse rows of counts: row r has terms[at[r] : at[r + 1]]; shapes come before words."""

    at: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    words: np.ndarray  # number of words of each row

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def term_counts(texts: list[bytes]) -> Bags:
    """The bags of one slice of texts."""
    joined = np.frombuffer(b"  ".join(texts) + b"  ", dtype=np.uint8)
    code = _CLASS[joined]
    gram = code[:-2] * (_N * _N) + code[1:-1] * _N + code[2:]
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    at = np.concatenate(([0], np.cumsum(sizes + 2)))[:-1]
    h, first, _, _ = word_hashes(texts)
    n = np.diff(first)
    of = np.repeat(np.arange(len(texts)), n)
    again = np.stack([np.bincount(of[lag:][(h[lag:] == h[:-lag]) & (of[lag:] == of[:-lag])], minlength=len(texts)) for lag in _REPEATS], axis=1)
    key, times = np.unique((of << _WORD_BITS) | (h >> np.uint64(64 - _WORD_BITS)).astype(np.int64), return_counts=True)
    cut = np.searchsorted(key, np.arange(len(texts) + 1) << _WORD_BITS)
    terms, counts = [], []
    for i, (a, size) in enumerate(zip(at.tolist(), sizes.tolist())):
        shape = np.concatenate((np.bincount(gram[a : a + size], minlength=_GRAMS), again[i]))
        some = np.flatnonzero(shape)
        terms += [some, (key[cut[i] : cut[i + 1]] & ((1 << _WORD_BITS) - 1)) + _SHAPES]
        counts += [shape[some], times[cut[i] : cut[i + 1]]]
    ends = np.cumsum([0] + [len(t) for t in terms])[::2]
    return Bags(ends, np.concatenate(terms).astype(np.int32) if terms else np.empty(0, np.int32), np.concatenate(counts).astype(np.float32) if counts else np.empty(0, np.float32), n)


def _weights(b: Bags, idf: np.ndarray) -> np.ndarray:
    """Damped counts times idf; the shapes of a row are scaled to length 1, its words to ``WORD_WEIGHT``."""
    row, word = b.rows(), b.terms >= _SHAPES
    view = row * 2 + word
    x = np.where(word, 1 + np.log(np.maximum(b.counts, 1)), np.sqrt(b.counts / np.maximum(b.words, 1)[row])) * idf[b.terms]
    norm = np.sqrt(np.bincount(view, weights=x * x, minlength=2 * len(b.words)))
    return (x / np.maximum(norm, 1e-12)[view] * np.where(word, WORD_WEIGHT, 1)).astype(np.float32)


def _times(b: Bags, x: np.ndarray, right: np.ndarray, most: int = 1 << 17, wide: int = 64) -> np.ndarray:
    """The sparse matrix (rows of b) times a dense one, some entries and some columns at a time."""
    out = np.zeros((len(b.at) - 1, right.shape[1]), np.float32)
    row, columns = b.rows(), [(slice(c, c + wide), np.ascontiguousarray(right[:, c : c + wide])) for c in range(0, right.shape[1], wide)]
    for a in range(0, len(x), most):
        part = row[a : a + most]
        start = np.flatnonzero(np.diff(part, prepend=-1))
        if len(start):
            for c, some in columns:
                product = some[b.terms[a : a + most]]
                product *= x[a : a + most, None]
                out[part[start], c] += np.add.reduceat(product, start, axis=0)
    return out


def _transposed(b: Bags, x: np.ndarray) -> tuple[Bags, np.ndarray]:
    order = np.argsort(b.terms, kind="stable")
    at = np.concatenate(([0], np.cumsum(np.bincount(b.terms, minlength=TERMS))))
    return Bags(at, b.rows()[order].astype(np.int32), b.counts[order], b.words), x[order]


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int

    def latent(self, b: Bags, wide: int = 64) -> np.ndarray:
        z = _times(b, _weights(b, self.idf), self.basis, wide=wide)
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, b: Bags) -> np.ndarray:
        """Cosine-weighted share of label 1 among the k nearest; rows without a word: 0."""
        out = np.zeros(len(b.words))
        z = self.latent(b)
        k = min(self.k, len(self.vectors))
        for a in range(0, len(z), 512):
            sims = z[a : a + 512] @ self.vectors.T
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(sims, near, axis=1), 0.0).astype(np.float64)
            out[a : a + 512] = (w * self.labels[near]).sum(axis=1) / np.maximum(w.sum(axis=1), 1e-300)
        return np.where(b.words > 0, out, 0.0)


def fit(b: Bags, labels: np.ndarray, k: int = NEIGHBOURS, dims: int = DIMENSIONS, seed: int = 0) -> Model:
    """Latent vectors of the labelled rows: truncated SVD by a randomised range finder over the sparse rows."""
    n = len(b.words)
    idf = (np.log((1 + n) / (1 + np.bincount(b.terms, minlength=TERMS))) + 0.1).astype(np.float32)
    x = _weights(b, idf)
    t, xt = _transposed(b, x)
    dims = min(dims, n)
    q = np.linalg.qr(_times(t, xt, np.random.default_rng(seed).standard_normal((n, min(n, dims + 8))).astype(np.float32), wide=NARROW))[0]
    for _ in range(3):
        q = np.linalg.qr(_times(t, xt, _times(b, x, q, wide=NARROW), wide=NARROW))[0]
    basis = (q @ np.linalg.svd(_times(b, x, q, wide=NARROW), full_matrices=False)[2].T[:, :dims]).astype(np.float32)
    empty = Model(idf, basis, np.zeros((0, dims), np.float32), labels, k)
    return Model(idf, basis, empty.latent(b, NARROW), labels.astype(np.float64), k)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", max_labelled: int = MAX_LABELLED, k: int = NEIGHBOURS) -> Model | None:
    """The model from at most ``max_labelled`` labelled rows (the smallest MD5s of their ids, half for each label), held-out rows left out.

    None if there is no labelled text. Labels other than 0 and 1, null ids and null or empty texts teach nothing;
    of the texts and labels of a repeated id one row teaches, the smallest by its terms, then its label.
    """
    picked = None
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out()).select("doc_id", F.col(target).cast("int").alias("_y")).distinct()
    for y in (0, 1):
        some = usable.where(F.col("_y") == y).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_labelled // 2)
        picked = some if picked is None else picked.union(some)
    # at most max_labelled rows: a proven bound
    rows = docs.where("text <> ''").select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a, part in slices(b["text"].tolist()):
                c, own = term_counts(part), b.iloc[a : a + len(part)]
                each = [(c.terms[i:j].tobytes(), c.counts[i:j].tobytes()) for i, j in zip(c.at[:-1], c.at[1:])]
                yield pd.DataFrame({"doc_id": own["doc_id"].to_numpy(), "y": own["_y"].to_numpy(), "words": c.words, "terms": [x for x, _ in each], "counts": [x for _, x in each]})

    got = rows.mapInPandas(counted, "doc_id long, y int, words long, terms binary, counts binary")
    # of several texts or labels of one id always the same row
    got = got.groupBy("doc_id").agg(F.min(F.struct("terms", "counts", "words", "y")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").toArrow()
    if not got.num_rows:
        return None
    terms, counts = (got.column(c).to_pylist() for c in ("terms", "counts"))
    at = np.cumsum([0] + [len(x) // 4 for x in terms])
    bags = Bags(at, np.frombuffer(b"".join(terms), np.int32), np.frombuffer(b"".join(counts), np.float32), got.column("words").to_numpy())
    labels = got.column("y").to_numpy()
    del got, terms, counts
    return fit(bags, labels, k)


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED, out: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score (double, 0 to 1) and predicted (int: score >= threshold).

    Whole texts are scored; only the text enters a score. A null or empty text,
    or one of white space only, scores 0. Without any labelled text every other
    document scores 0.5. ``out`` names the two columns; columns with these names
    are replaced, all others stay. Repeated rows stay, rows with equal texts score alike. No rows: no rows.
    """
    python_workers(spark, 1000)
    docs = docs.drop(*out)
    model = train(docs, labels, target, max_labelled)
    parts = spark.sparkContext.broadcast(model and (model.idf, model.basis, model.vectors, model.labels, model.k))
    schema = StructType([*docs.schema.fields]).add(out[0], DoubleType())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*parts.value) if parts.value else None
        for b in batches:
            got = np.empty(b.num_rows)
            for a, part in slices(b.column("text").to_pylist()):
                bags = term_counts(part)
                got[a : a + len(part)] = m.score(bags) if m else np.where(bags.words > 0, 0.5, 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got)], names=[*b.schema.names, out[0]])

    return docs.mapInArrow(score, schema).withColumn(out[1], (F.col(out[0]) >= threshold).cast("int"))
