"""Ranked lexical search by NRA (no random access).

Documents are tokenised once, and what they hold of the items' terms is landed
with their lengths. Document frequencies are summed over all documents. Then
every task takes its documents in blocks: a block has one list a term, sorted
by impact. For an item the lists of its terms are read from the top in
lockstep, and each document met has an interval: its lower score is what was
read for it, its upper score adds the last impact read of every list in which
it has not been met. Reading goes on until no document outside can reach the
k-th lower score, not even as a tie, and the scores of all inside are known in
full. A task carries its k best of an item, and with them the k-th score, from
block to block and sends only those; they are merged in two steps.

Blocks hold a bounded number of documents and postings, so lists of frequent
terms are cut, and memory does not grow with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land, python_workers

#: Distinct terms of a block of items; a longer set of items is searched in several blocks of items.
MAX_TERMS = 200_000
DOCS, POSTINGS, SEEN = 16_384, 4_000_000, 1 << 26
_FIRST_READ = 256

#: 0-9, a-z and all bytes of non-ASCII characters stay, A-Z become a-z, the rest separates.
_TERM_BYTES = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split(b" ") if text else []


def term_counts(text: str | None) -> Counter:
    counts = Counter(terms(text))
    counts.pop(b"", None)
    return counts


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's part of the score for one occurrence in the item; all arrays int64."""
    m = 100 - 25 + (25 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class Block:
    """Lists of a block of documents, sorted by impact."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        some = impact > 0
        doc, term, impact = doc[some], term[some], impact[some]
        order = np.lexsort((-impact, term))
        self.ids, self.doc, self.impact = ids, doc[order], impact[order]
        self.at = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))

    def best(self, item: np.ndarray, repeats: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, postings read): all that may be among the k best, no score below ``least`` among them; the k-th and its ties are.

        item: term numbers, repeats: how often the item has each.
        """
        there = self.at[item + 1] > self.at[item]
        item, repeats = item[there], repeats[there]
        start, end = self.at[item], self.at[item + 1]
        lower, seen = np.zeros(len(self.ids), np.int64), np.zeros((len(self.ids), len(item)), bool)
        alive = np.ones(len(self.ids), bool)  # documents that may still be among the k best
        frontier, depth, step, read = np.zeros(len(item), np.int64), 0, _FIRST_READ, 0
        inside, outside_open = np.empty(0, np.int64), True
        while True:
            for t, (a, b, r) in enumerate(zip(start.tolist(), end.tolist(), repeats.tolist())):
                lo, hi = min(b, a + depth), min(b, a + depth + step)
                if lo == hi:
                    frontier[t] = 0
                    continue
                read += hi - lo
                d, gain = self.doc[lo:hi], self.impact[lo:hi] * r
                frontier[t] = gain[-1] if hi < b else 0
                on = alive[d]
                d = d[on]
                lower[d] += gain[on]
                seen[d, t] = True
            depth, step = depth + step, step * 2
            inside = np.flatnonzero((lower > 0) & alive)
            low = lower[inside]
            if len(low) >= k:
                least = max(least, int(np.partition(low, len(low) - k)[len(low) - k]))
            rest = int(frontier.sum())
            upper = low + rest - seen[inside] @ frontier
            inside = inside[upper >= least]
            resolved = rest == 0 or bool((upper[upper >= least] == lower[inside]).all())
            outside_open = outside_open and rest >= max(least, 1)
            gone = np.ones(len(alive), bool) if not outside_open else lower > 0
            gone[inside] = False
            alive &= ~gone
            if resolved and not outside_open:
                return self.ids[inside], lower[inside], read


def top(docs: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller document."""
    return np.lexsort((docs, -scores))[:k]


def _asked(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term, n) of every item, landed."""
    one = items.where(F.col(item).isNotNull()).groupBy(F.col(item).cast("long").alias("item")).agg(F.min(text).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                c = term_counts(t)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(c), pa.int64()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["item", "term", "n"])

    return land(one.mapInArrow(counted, "item long, term binary, n long"), "ranked_items")


def _blocks_of(asked: DataFrame, most: int) -> int:
    """Number of hash blocks of items, so that one holds ``most`` terms at most or a single item."""
    n = 1
    while True:
        of = asked.groupBy(F.pmod(F.xxhash64("item"), F.lit(n))).agg(F.count(F.lit(1)).alias("rows"), F.min("item").alias("a"), F.max("item").alias("b"))
        if (of.where("a < b").agg(F.max("rows")).first()[0] or 0) <= most:
            return n
        n *= 2


def _search(docs: DataFrame, asked: list, k: int) -> DataFrame:
    """(item, doc, score): what each task found to be its k best of each item."""
    sc = docs.sparkSession.sparkContext
    names: dict[bytes, int] = {}
    of: dict[int, list[tuple[int, int]]] = {}
    for r in asked:
        of.setdefault(r["item"], []).append((names.setdefault(bytes(r["term"]), len(names)), r["n"]))
    held = sc.broadcast(names)
    size = len(names)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        for b in batches:
            out = []
            for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                words = terms(t)
                n = len(words) - words.count(b"")
                if n:
                    c = Counter(map(number, words))
                    c.pop(None, None)
                    out.append((i, n, np.fromiter(c.keys(), np.int32, len(c)).tobytes(), np.fromiter(c.values(), np.int64, len(c)).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["id", "n", "terms", "tfs"])

    landed = land(docs.mapInArrow(postings, "id long, n long, terms binary, tfs binary"), "ranked_postings")
    n_docs, n_terms = landed.agg(F.count(F.lit(1)), F.sum("n")).first()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.int32), minlength=size)
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(df[t])], names=["term", "df"])

    weight = np.zeros(size, np.int64)
    for r in landed.mapInArrow(frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row a term of the block
        weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    lists = [(i, np.array([t for t, _ in x]), np.array([n for _, n in x], np.int64)) for i, x in sorted(of.items())]
    longest = max((len(t) for _, t, _ in lists), default=1)
    most_docs = max(16, min(DOCS, SEEN // longest))
    model = sc.broadcast((weight, lists))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, items = model.value
        found = {i: (np.empty(0, np.int64), np.empty(0, np.int64)) for i, _, _ in items}

        def take(rows: list) -> None:
            ids, n = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
            term, tf = np.frombuffer(b"".join(r[2] for r in rows), np.int32), np.frombuffer(b"".join(r[3] for r in rows), np.int64)
            doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) // 4 for r in rows])
            block = Block(ids, doc, term, impacts(w[term], tf, n[doc], n_docs, n_terms), len(w))
            for i, t, r in items:
                d, s = found[i]
                more, scores, _ = block.best(t, r, k, int(s[-1]) if len(s) == k else 0)
                d, s = np.concatenate((d, more)), np.concatenate((s, scores))
                at = top(d, s, k)
                found[i] = d[at], s[at]

        rows, postings = [], 0
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("id", "n", "terms", "tfs"))):
                rows.append(r)
                postings += len(r[2]) // 4
                if len(rows) >= most_docs or postings >= POSTINGS:
                    take(rows)
                    rows, postings = [], 0
        if rows:
            take(rows)
        item = np.repeat([i for i in found], [len(d) for d, _ in found.values()]).astype(np.int64)
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item)] + [pa.array(np.concatenate([x[j] for x in found.values()])) for j in (0, 1)], names=["item", "doc", "score"])

    ranked = landed.where("id is not null and length(terms) > 0")
    return ranked.mapInArrow(searched, "item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc: str = "doc_id", item: str = "item_id", text: str = "text", max_terms: int = MAX_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's k highest-scoring documents with a score above 0; equal scores by doc_id.

    Whole texts are read. A null or empty text, or one without terms, has none:
    as a document it does not count, as an item it finds nothing. A document
    with a null id counts in the statistics and is not ranked. Rows that share
    a document id are documents of their own; of rows that share an item id the
    smallest text asks, and a null item id asks nothing. Other columns are
    ignored. No documents or no items: no rows.
    """
    spark = docs.sparkSession
    python_workers(spark, 1000)
    docs = docs.select(F.col(doc).cast("long").alias("id"), F.col(text).alias("text")).where("text <> ''")
    asked = _asked(items, item, text)
    found = None
    blocks = _blocks_of(asked, max_terms)
    for b in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # max_terms rows or one item's terms
        if some or b == 0:
            part = _search(docs, some, k)
            found = part if found is None else found.unionByName(part)
    order = [F.desc("score"), F.asc("doc")]
    # two steps, so that no task gets what all tasks have found for an item
    some = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return some.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
