"""Packing into optimal length buckets.

The global histogram of lengths (grouped with map-side combining) goes through
a dynamic program that chooses the bucket boundaries with the least padding;
inside a bucket every batch holds as many rows as fit the token budget at the
bucket's padded length. Row numbers inside a bucket come from counts per
(bucket, salt) and a row number inside each such cell, so no bucket is sorted
in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land, n_words

#: Boundary candidates that the dynamic program may see. Up to this many
#: different lengths each is one (the optimum); of more, those above half of
#: this many words are taken together in steps of about 0.1 %.
MAX_LENGTHS = 1 << 17


def boundary_step(length, exact: int = 512, per_octave: int = 128):
    """The boundary candidate that covers a length: itself up to ``exact``,
    then the next of ``per_octave`` steps between two powers of two. There are
    at most exact + per_octave * log2(longest / exact) candidates."""
    length = F.col(length) if isinstance(length, str) else length
    step = F.greatest(F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)) - F.lit(0.5)))) / per_octave, F.lit(1.0))
    return F.when(length <= exact, F.greatest(length, F.lit(1))).otherwise((F.ceil(length / step) * step).cast("long")).cast("long")


def _one_more(before: np.ndarray, top: np.ndarray, rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least padding of 0..j when the last bucket begins at the best i, that i) for every j.

    before[i]: least padding of what lies below i. The best i never falls as j
    grows, so the j in the middle of a range halves the i of both its sides; all
    ranges of one depth are looked at together, each i in one range or two."""
    n = len(top)
    base, best, at = before + words[:-1], np.empty(n), np.zeros(n, dtype=np.int64)
    a, b, lo, hi = (np.asarray([v], dtype=np.int64) for v in (0, n, 0, n - 1))
    while len(a):
        j = (a + b) // 2
        size = np.minimum(hi, j) - lo + 1
        start = np.cumsum(size) - size
        i = np.arange(size.sum()) - np.repeat(start - lo, size)
        cost = base[i] - np.repeat(top[j], size) * rows[i]
        least = np.minimum.reduceat(cost, start)
        hits = np.flatnonzero(cost == np.repeat(least, size))
        at[j] = first = i[hits[np.searchsorted(hits, start)]]
        best[j] = least + top[j] * rows[j + 1] - words[j + 1]
        left, right = a < j, j + 1 < b
        a, b, lo, hi = (
            np.concatenate((x[left], y[right]))
            for x, y in ((a, j + 1), (j, b), (lo, first), (first, hi))
        )
    return best, at


def best_boundaries(lengths: list[int], counts: list[int], totals: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    lengths: ascending candidates; counts, totals: rows and summed true lengths
    under each. cost(i, j) = lengths[j] * rows(i..j) - words(i..j).
    """
    n = len(lengths)
    if not n:
        return []
    top = np.asarray(lengths, dtype=np.float64)
    rows = np.concatenate(([0.0], np.cumsum(np.asarray(counts, dtype=np.float64))))
    words = np.concatenate(([0.0], np.cumsum(np.asarray(totals, dtype=np.float64))))
    best = top * rows[1:] - words[1:]
    back = []
    for _ in range(min(buckets, n) - 1):
        best, at = _one_more(np.concatenate(([0.0], best[:-1])), top, rows, words)
        back.append(at)
    out, j = [int(lengths[-1])], n - 1
    for at in reversed(back):
        i = int(at[j])
        if i == 0:
            break
        j = i - 1
        out.append(int(lengths[j]))
    return sorted(out)


def length_histogram(rows: DataFrame, limit: int = MAX_LENGTHS) -> DataFrame:
    """top (a length that occurs, 1 at least), rows, words of each boundary candidate: ``limit`` rows (128 or more) at most.

    More different lengths than that are taken together: lengths up to limit / 2
    stay candidates of their own, above them the longest of each step is one."""
    hist = land(rows.groupBy(F.greatest("n_tokens", F.lit(1)).alias("top")).agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("words")), "pack_hist")
    if hist.count() > limit:
        # 64 octaves at most
        step = boundary_step("top", limit // 2, max(1, limit // 128))
        hist = hist.groupBy(step.alias("_step")).agg(F.max("top").alias("top"), F.sum("rows").alias("rows"), F.sum("words").alias("words")).drop("_step")
    return hist.orderBy("top")


def packed(docs: DataFrame, buckets: int = 16, budget: int = 16_384, cell_rows: int = 50_000, text: str = "text", key: str = "doc_id", max_lengths: int = MAX_LENGTHS) -> DataFrame:
    """Every row with its bucket and batch.

    Columns: doc_id, n_tokens (words of the text; null or empty: 0), bucket
    (int, 0 = shortest), bucket_len (padded length), batch (long, in the
    bucket), place (int, in the batch), padding (bucket_len - n_tokens). A
    batch holds max(1, budget // bucket_len) rows: a row longer than the budget
    is a batch of its own and is not cut. bucket_len is a length that occurs (1,
    if only empty texts are in the bucket), and the padding is the least that
    ``buckets`` buckets allow, up to ``max_lengths`` different lengths. Order inside a bucket: hash of the
    key, then length; repeated rows keep their multiplicity. No rows: no rows.
    """
    rows = land(docs.select(F.col(key).alias("doc_id"), n_words(text).alias("n_tokens")), "pack_len")
    hist = length_histogram(rows, max_lengths).toArrow()
    tops = best_boundaries(*(hist.column(c).to_numpy() for c in ("top", "rows", "words")), buckets)
    if not tops:
        tops = [1]
    total = rows.count()
    salts = max(1, -(-total // cell_rows))
    top, bucket, at = F.lit(tops[-1]), F.lit(len(tops) - 1), F.col("n_tokens")
    for i in range(len(tops) - 2, -1, -1):
        top = F.when(at <= tops[i], F.lit(tops[i])).otherwise(top)
        bucket = F.when(at <= tops[i], F.lit(i)).otherwise(bucket)
    rows = rows.select("doc_id", "n_tokens", bucket.cast("int").alias("bucket"), top.cast("long").alias("bucket_len"), F.xxhash64("doc_id").alias("_h"))
    rows = rows.withColumn("_salt", F.pmod(F.col("_h"), F.lit(salts)).cast("int"))
    cells = rows.groupBy("bucket", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("bucket").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("bucket", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("bucket", "_salt").orderBy("_h", "doc_id", "n_tokens")) - 1
    # at most buckets * salts rows, salts = rows / cell_rows
    rows = rows.withColumn("_nth", nth).join(cells, ["bucket", "_salt"])
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("bucket_len")))
    at = F.col("_before") + F.col("_nth")
    return rows.select(
        "doc_id", "n_tokens", "bucket", "bucket_len",
        F.floor(at / per).cast("long").alias("batch"), F.pmod(at, per).cast("int").alias("place"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
