"""Repeated passages by a sparse suffix array.

Only suffixes that start at a minimiser are kept: a position whose hash of
``GRAM`` words is the least of a window of ``WINDOW`` positions. That depends on
content alone, so two texts that share GRAM + WINDOW - 1 words keep a suffix at
the same place of the shared run, fewer than WINDOW words from its start. The
kept suffixes are sorted over the whole cluster by their next words (hashes of
32, 16 and 32 words), ties by document and place, so that one frequent passage
spreads over many partitions. A suffix and its neighbour that agree in the first
32 words match; matches are extended word by word to the left and the right on
whole texts.

A neighbour need not be the text with the longest match on the left. So where
three or more suffixes share 32 words, the windows of min_words words about them
that no match covers yet are looked up by their hashes among the windows at the
same places of the other texts, and what is found is extended alike: no window
of min_words words that occurs again stays uncovered, but for those that one
repeated word fills: a run is no match of itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_checked, python_workers, keep_ids, land
from .words import mix, slices, word_hashes

MIN_WORDS = 50
GRAM, WINDOW = 8, 16
#: Words covered by each part of a suffix's sort key.
BLOCKS = (32, 16, 32)
_U = np.uint64
_K = _U(0xD6E8FEB86659FD93)


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (fewer at the end of h)."""
    g = h.copy()
    for j in range(1, n):
        g *= _K
        g[: len(h) - j] += h[j:]
    return g


def _slide(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i : i + n], n a power of two, for the len(x) - n + 1 windows."""
    size = 1
    while size < n:
        x = pick(x[: len(x) - size], x[size:])
        size *= 2
    return x


def minimisers(h: np.ndarray, gram: int = GRAM, window: int = WINDOW, least: int = MIN_WORDS) -> np.ndarray:
    """Positions of one text's kept suffixes.

    In a run of one repeated gram only the first position competes. Kept beside
    the least hashes are the last position of a run and those whole windows
    before it, so that a match of ``least`` words that begins within a run and
    goes on after it has a suffix in its first window too.
    """
    m = len(h) - gram + 1
    if m < 1:
        return np.empty(0, dtype=np.int64)
    g = mix(_grams(h, gram)[:m])
    same = np.zeros(m, dtype=bool)
    same[1:] = g[1:] == g[:-1]
    starts, lasts = np.flatnonzero(same & ~np.concatenate(([False], same[:-1]))), np.flatnonzero(same & ~np.concatenate((same[1:], [False])))
    back = lasts[:, None] - np.arange(0, max(least - gram, 1), window)
    ends = back[back >= starts[:, None]]
    g = np.where(same, _U(np.iinfo(np.uint64).max), g)
    if m < window:
        kept = np.flatnonzero((g == g.min()) & ~same)
    else:
        low = _slide(g, window, np.minimum)
        pad = np.zeros(window - 1, dtype=_U)
        best = _slide(np.concatenate((pad, low, pad)), window, np.maximum)
        kept = np.flatnonzero((g == best) & ~same)
    return np.union1d(kept, ends) if len(ends) else kept


def suffixes(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(b1, b2, b3, doc, pos) of the kept suffixes. docs: doc, text."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = b["doc"].to_numpy()
            for a, part in slices(b["text"].tolist()):
                h, first, _, _ = word_hashes(part)
                ends = first[1:]
                keep = [minimisers(h[s:e], least=min_words) + s for s, e in zip(first[:-1].tolist(), ends.tolist())]
                of = np.repeat(np.arange(len(part)), [len(k) for k in keep])
                pos = np.concatenate(keep) if keep else np.empty(0, np.int64)
                cols, at = [], 0
                # words beyond the end of a text count as zeros
                for n in BLOCKS:
                    g = np.zeros(len(pos), dtype=_U)
                    for j in range(n):
                        p = pos + at + j
                        inside = p < ends[of]
                        g = g * _K + np.where(inside, h[np.minimum(p, len(h) - 1)] if len(h) else _U(0), _U(0))
                    cols.append(mix(g))
                    at += n
                signed = [c.view(np.int64) for c in cols]
                yield pd.DataFrame({**{f"b{i + 1}": c for i, c in enumerate(signed)}, "doc": ids[a + of], "pos": (pos - first[:-1][of]).astype(np.int32)})

    return docs.mapInPandas(cut, "b1 long, b2 long, b3 long, doc long, pos int")


def neighbours(kept: DataFrame) -> DataFrame:
    """(doc, pos, mdoc, mpos): each suffix with each neighbour in the sorted order whose first block agrees.

    Ranges are cut on all of the order, so a suffix that very many texts share
    is spread; the first and last suffix of each partition are compared across the border.
    """
    order = ["b1", "b2", "b3", "doc", "pos"]
    out = "kind int, part int, b1 long, doc long, pos int, mdoc long, mpos int"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def rows(kind, b1, doc, pos, mdoc, mpos):
            n = len(doc)
            ints = lambda x: pa.array(x, pa.int32())
            return pa.RecordBatch.from_arrays([ints(np.full(n, kind)), ints(np.full(n, part)), pa.array(b1), pa.array(doc), ints(pos), pa.array(mdoc), ints(mpos)], names=["kind", "part", "b1", "doc", "pos", "mdoc", "mpos"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            b1, doc, pos = (np.asarray(b.column(k)) for k in ("b1", "doc", "pos"))
            if held is None:
                yield rows(1, b1[:1], doc[:1], pos[:1], doc[:1], pos[:1])
            else:
                b1, doc, pos = (np.concatenate((x[-1:], y)) for x, y in zip(held, (b1, doc, pos)))
            up = np.flatnonzero(b1[1:] == b1[:-1])
            yield rows(0, b1[up], doc[up], pos[up], doc[up + 1], pos[up + 1])
            yield rows(0, b1[up], doc[up + 1], pos[up + 1], doc[up], pos[up])
            held = (b1, doc, pos)
        if held is not None:
            last = [x[-1:] for x in held]
            yield rows(2, *last, last[1], last[2])

    found = kept.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, out)
    found = land(found, "suffix_pairs")
    # two rows a partition
    w = Window.orderBy("part", "kind")
    ends = found.where("kind > 0").withColumn("_next", F.lead(F.struct("kind", "b1", "doc", "pos")).over(w))
    ends = ends.where("kind = 2 and _next.kind = 1 and _next.b1 = b1")
    here, there = F.struct("doc", "pos"), F.struct(F.col("_next.doc").alias("doc"), F.col("_next.pos").alias("pos"))
    across = ends.select(here.alias("x"), there.alias("y"))
    pair = lambda df, x, y: df.select(F.col(f"{x}.doc").alias("doc"), F.col(f"{x}.pos").alias("pos"), F.col(f"{y}.doc").alias("mdoc"), F.col(f"{y}.pos").alias("mpos"))
    return found.where("kind = 0").select("doc", "pos", "mdoc", "mpos").union(pair(across, "x", "y")).union(pair(across, "y", "x"))


def _extended(h: np.ndarray, g: np.ndarray, at: list[tuple[int, int]], least: int, same_doc: bool) -> list[tuple[int, int, int]]:
    """(start, words, start of the match) of the maximal matches through the given places, longest run per diagonal once."""
    out, done = [], {}
    for p, q in sorted(at):
        if done.get(p - q, -1) > p or p >= len(h) or q >= len(g):
            continue
        n = min(len(h) - p, len(g) - q)
        differ = np.flatnonzero(h[p : p + n] != g[q : q + n])
        right = int(differ[0]) if len(differ) else n
        m = min(p, q)
        differ = np.flatnonzero(h[p - m : p][::-1] != g[q - m : q][::-1])
        left = int(differ[0]) if len(differ) else m
        done[p - q] = p + right
        if left + right >= least and not (same_doc and (p == q or (h[p - left : p + right] == h[p]).all())):
            out.append((p - left, left + right, q - left))
    return out


def _uncovered(pos: np.ndarray, seen: np.ndarray, least: int) -> np.ndarray:
    """For each suffix the offsets o < WINDOW, as bits, whose window [pos - o, pos - o + least) no passage (start, end) holds."""
    a = pos[:, None] - np.arange(WINDOW)
    free = a >= 0
    if len(seen):
        seen = seen[np.argsort(seen[:, 0], kind="stable")]
        reach = np.maximum.accumulate(seen[:, 1])
        k = np.searchsorted(seen[:, 0], a, side="right") - 1
        free &= (k < 0) | (reach[k] < a + least)
    return (free << np.arange(WINDOW)).sum(axis=1)


def _windows(h: np.ndarray, at: list[tuple[int, int, int]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, whether uncovered) of the windows of one text asked for: at has (pos, offsets, uncovered offsets).

    Of windows that one repeated word fills only the first of its run counts.
    """
    if len(h) < least:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, bool)
    g = mix(_grams(h, least)[: len(h) - least + 1])
    x = np.array(at, dtype=np.int64)
    bit = np.arange(WINDOW)
    a, want, free = x[:, :1] - bit, (x[:, 1:2] >> bit) & 1 == 1, (x[:, 2:] >> bit) & 1 == 1
    want &= (a >= 0) & (a < len(g))
    starts, of = np.unique(a[want], return_inverse=True)
    open_ = np.zeros(len(starts), dtype=bool)
    np.logical_or.at(open_, of, free[want])
    first = (starts == 0) | (g[starts] != g[starts - 1])
    return g[starts[first]], starts[first], open_[first]


def _frame(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pd.DataFrame:
    """One frame of the columns that each document of a batch gave."""
    return pd.DataFrame({k: np.concatenate(c) for k, c in zip(names, zip(*parts))} if parts else {k: [] for k in names})


def overlooked(kept: DataFrame, parts: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """(doc, pos, mdoc, mpos): places of the windows of min_words words that occur again and that parts does not cover.

    kept: doc, pos, b1 of the suffixes whose first words three or more share;
    parts: doc, start, n_words; texts: doc, text. The mate is the smallest
    other place of the window. A document's lists are bounded by its own suffixes.
    """
    lists = kept.groupBy("doc").agg(F.collect_list(F.struct("pos", "b1")).alias("at"))
    seen = parts.groupBy("doc").agg(F.collect_list(F.struct("start", (F.col("start") + F.col("n_words")).alias("end"))).alias("seen"))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, at, old in zip(b["doc"], b["at"], b["seen"]):
                pos = np.array([r["pos"] for r in at], dtype=np.int64)
                old = np.array([(r["start"], r["end"]) for r in old] if old is not None else [], dtype=np.int64).reshape(-1, 2)
                out.append((np.full(len(pos), doc), pos, np.array([r["b1"] for r in at], dtype=np.int64), _uncovered(pos, old, min_words)))
            yield _frame(out, ["doc", "pos", "b1", "own"])

    marks = lists.join(seen, "doc", "left").select("doc", "at", "seen").mapInPandas(mark, "doc long, pos int, b1 long, own int")
    marks = land(marks, "suffix_marks")
    asked = land(marks.groupBy("b1").agg(F.bit_or("own").alias("asked")).where("asked <> 0"), "suffix_asked")
    asked = marks.join(asked, "b1").groupBy("doc").agg(F.collect_list(F.struct("pos", "asked", "own")).alias("at"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, at, text in zip(b["doc"], b["at"], b["text"]):
                h = word_hashes([text.encode("utf-8", "surrogatepass")])[0]
                g, starts, open_ = _windows(h, [(r["pos"], r["asked"], r["own"]) for r in at], min_words)
                out.append((g.view(np.int64), np.full(len(g), doc), starts, open_))
            yield _frame(out, ["key", "doc", "pos", "open"])

    found = land(asked.join(texts, "doc").select("doc", "at", "text").mapInPandas(cut, "key long, doc long, pos int, open boolean"), "suffix_windows")
    again = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("open").cast("int")).alias("any")).where("n > 1 and any = 1").select("key")
    found = land(keep_ids(found, land(again, "suffix_again"), "key"), "suffix_found")
    place = F.struct("doc", "pos")
    ends = land(found.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi")), "suffix_ends")
    mates = found.where("open").join(ends, "key").withColumn("mate", F.when(F.col("lo") == place, F.col("hi")).otherwise(F.col("lo")))
    return mates.select("doc", "pos", F.col("mate.doc").alias("mdoc"), F.col("mate.pos").alias("mpos"))


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, n_words, match_doc_id, match_start, n_copies of the passages that occur again.

    Words are as in ``words``; start counts words from 0. A passage has
    ``min_words`` words or more (47 at least: of shorter ones no kept suffix has
    32 words in common) and cannot be extended on either side; its match lies in another
    document, or at another place of the same one (a run of one repeated word is
    no match of itself). Texts that are equal as a
    whole are one class: each copy gets one row with its whole text (match: the
    smallest other id) and n_copies, the number of texts in the class; other
    rows have n_copies 1 or the class's size and are given for its smallest id. Null ids,
    null and empty texts and texts shorter than min_words give no rows; a
    repeated row is a copy like any other, with itself as the match if there is no other id. No rows: no rows.
    """
    if min_words < BLOCKS[0] + WINDOW - 1:
        raise ValueError(f"min_words must be {BLOCKS[0] + WINDOW - 1} at least")
    spark = docs.sparkSession
    python_workers(spark, 1000)
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null and text <> ''")
    sums = rows.select("doc", F.md5("text").alias("d"), F.length("text").alias("n"))
    cls = sums.groupBy("d", "n").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"))
    cls = land(cls, "suffix_classes")
    second = sums.join(cls.where("copies > 1"), ["d", "n"]).where("doc > rep").groupBy("rep").agg(F.min("doc").alias("other"))
    reps = land(cls.join(second, "rep", "left").select("rep", "copies", "other"), "suffix_reps")
    copied = reps.where("copies > 1")
    whole_of = land(sums.join(cls.where("copies > 1"), ["d", "n"]).select("doc", "rep", "copies"), "suffix_copies")
    # each copy's words, counted on the class's text
    length = keep_ids(rows.withColumnRenamed("doc", "rep"), copied.select("rep"), "rep").groupBy("rep").agg(F.max(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("words"))
    # one row a class, so that the copies of a large class need not meet in one task
    classes = land(copied.select("rep", "other").join(length.where(F.col("words") >= min_words), "rep"), "suffix_copied")
    whole = whole_of.join(broadcast_checked(classes), "rep")
    whole = whole.select("doc", F.lit(0).alias("start"), F.col("words").cast("int").alias("n_words"), F.when(F.col("doc") != F.col("rep"), F.col("rep")).otherwise(F.coalesce("other", "rep")).alias("mdoc"), F.lit(0).alias("mstart"), "copies")
    # one row for each class: no other copies, and one row of an id that repeats
    once = keep_ids(rows, whole_of.where("doc <> rep").select("doc").distinct(), "doc", how="left_anti")
    twice = land(sums.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "suffix_twice")
    once = keep_ids(once, twice, "doc", how="left_anti").union(keep_ids(once, twice, "doc").groupBy("doc").agg(F.max("text").alias("text")))

    # suffixes are cut twice: most share their first words with no other, and landing them all would take as much disk as the texts
    often = land(suffixes(once, min_words).groupBy("b1").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix_keys")
    kept = land(keep_ids(suffixes(once, min_words), often.select("b1"), "b1"), "suffix_rows")

    def matches(near: DataFrame, name: str) -> DataFrame:
        """A document's matches with one other, one row: no more than its own kept suffixes, or windows about them."""
        return land(near.groupBy("doc", "mdoc").agg(F.sort_array(F.collect_set(F.struct("pos", "mpos"))).alias("at")), name)

    pairs = matches(neighbours(kept), "suffix_matches")
    ids = land(pairs.select("doc").union(pairs.select("mdoc")).distinct(), "suffix_ids")
    texts = land(keep_ids(once, ids, "doc").groupBy("doc").agg(F.max("text").alias("text")), "suffix_texts")

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, mdoc, at, x, y in zip(b["doc"], b["mdoc"], b["at"], b["text"], b["mtext"]):
                h = word_hashes([x.encode("utf-8", "surrogatepass")])[0]
                g = h if doc == mdoc else word_hashes([y.encode("utf-8", "surrogatepass")])[0]
                places = [(r["pos"], r["mpos"]) for r in at]
                out += [(doc, s, n, mdoc, t) for s, n, t in _extended(h, g, places, min_words, doc == mdoc)]
            if out:
                yield pd.DataFrame(out, columns=["doc", "start", "n_words", "mdoc", "mstart"])

    def extended(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts, "doc").join(texts.select(F.col("doc").alias("mdoc"), F.col("text").alias("mtext")), "mdoc")
        return both.select("doc", "mdoc", "at", "text", "mtext").mapInPandas(extend, "doc long, start int, n_words int, mdoc long, mstart int")

    parts = land(extended(pairs), "suffix_parts")
    many = keep_ids(kept, often.where("n > 2").select("b1"), "b1").select("doc", "pos", "b1")
    parts = parts.union(extended(matches(overlooked(many, parts, texts, min_words), "suffix_overlooked")))
    parts = parts.join(reps.select(F.col("rep").alias("doc"), "copies"), "doc")
    out = whole.select("doc", "start", "n_words", "mdoc", "mstart", "copies").union(parts.select("doc", "start", "n_words", "mdoc", "mstart", "copies"))
    return out.select(F.col("doc").alias("doc_id"), "start", "n_words", F.col("mdoc").alias("match_doc_id"), F.col("mstart").alias("match_start"), F.col("copies").alias("n_copies"))
