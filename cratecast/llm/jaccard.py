"""N-gram Jaccard join by signature trees.

A document is the set of its word n-grams. Equal sets are one class. Two sets
reach the threshold only if they share one of the first
size - ceil(threshold * size) + 1 shingles of each (in the order of their
hashes), so documents meet under these shingles: the top of the tree, dealt out
by Spark. Under a shingle, documents are first linked to the smallest of them,
which settles groups of copies with one comparison a document. Where a
shingle's documents are not all in one component after that, up to ``LEAF`` of
them are a leaf, whose documents are compared if sizes and places allow; over more, a
signature tree is built: nodes hold OR-combined token bitmaps and size ranges, and a
dual traversal prunes pairs of nodes whose largest possible overlap is too
small. Pairs of leaves that stay are verified on their whole texts. Those of trees can
be as many as the square of a group, so that a task returns a spanning forest of them
(fewer rows than documents), never the pairs. The components of these forests are
clusters: a document is in one at most, and two documents that a tree lets pass are in
one cluster. A cluster's documents meet in a tree once more, with their sets of
shingles, and its tasks return a forest of verified links.

A node's bitmap holds a quarter of its documents' shingles. Two documents are
also compared by parity bitmaps of all their shingles (a bit is set if an odd
number of shingles hash to it): each bit that differs needs a shingle that only
one of them has. Both take one to two bits a shingle.
A frequent shingle's documents are dealt by size band and, within a band, into
pairs of chunks of about ``CHUNK`` documents and ``CHUNK * LONG`` shingles: no task holds more.

Most tables between the stages are far smaller than the input. Counts of landed tables bound
their rows, and these the tasks that write them (``gathered``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, python_workers, keep_ids, land
from .components import components
from .neardup import _roots
from .words import mix, text_shingles

N, PERCENT = 4, 85
LEAF, CHUNK, LONG, FAN, FRONTIER = 96, 4096, 1024, 8, 1 << 13
#: Rows a task takes where they carry bitmaps, and where they carry texts.
MAPS, TEXTS = 8192, 1024
_U = np.uint64


def least_overlap(a, b, percent: int):
    """Smallest intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -((-percent * (a + b)) // (100 + percent))


def width(size: int) -> int:
    """Bits of the bitmap of a set: a power of two, its size or more, 64 at least."""
    return max(64, 1 << (int(size) - 1).bit_length())


def bitmap(tokens: np.ndarray) -> bytes:
    """A quarter of the tokens, hashed to half of ``width`` bits, as little-endian words."""
    bits = np.zeros(max(64, width(len(tokens)) // 2), dtype=np.uint8)
    some = tokens[(tokens & _U(3)) == 0]
    bits[((some >> _U(2)) & _U(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def parity(tokens: np.ndarray) -> bytes:
    """The parity of the number of tokens hashed to each of ``width`` bits."""
    bits = np.bincount((mix(tokens) & _U(width(len(tokens)) - 1)).astype(np.int64), minlength=width(len(tokens)))
    return np.packbits((bits & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, words: int, how=np.bitwise_or) -> np.ndarray:
    """A bitmap folded to a smaller power of two: by OR, or by XOR if it is a parity."""
    return how.reduce(np.frombuffer(bits, dtype="<u8").reshape(-1, words), axis=0)


def sketches(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc, size, d1, d2, bits, odd, prefix) of the rows of docs (doc, text)."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in text_shingles(b["text"].tolist(), n):
                d1, d2 = mix(t).sum(dtype=_U), mix(t ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U)
                prefix = t[: len(t) - -(-percent * len(t) // 100) + 1] if len(t) else t
                rows.append((len(t), int(d1) - (1 << 63), int(d2) - (1 << 63), bitmap(t) if len(t) else b"", parity(t) if len(t) else b"", prefix.view(np.int64)))
            yield pd.DataFrame({"doc": b["doc"], "size": [r[0] for r in rows], "d1": [r[1] for r in rows], "d2": [r[2] for r in rows], "bits": [r[3] for r in rows], "odd": [r[4] for r in rows], "prefix": [r[5] for r in rows]})

    return docs.mapInPandas(make, "doc long, size long, d1 long, d2 long, bits binary, odd binary, prefix array<long>")


class Tree:
    """Levels of nodes over documents sorted by size; level 0 is the documents."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, odd: list[bytes], comp: np.ndarray, fan: int = FAN):
        self.fan, self.odd, self.words = fan, odd, np.array([len(x) // 8 for x in odd])
        self.parity: dict[int, np.ndarray] = {}
        self.levels = [(size, size, bits, np.bitwise_count(bits).sum(axis=1, dtype=np.int64), comp, comp)]
        while len(self.levels[-1][0]) > 1:
            lo, hi, b, least, c0, c1 = self.levels[-1]
            cut = np.arange(0, len(lo), fan)
            self.levels.append((np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.bitwise_or.reduceat(b, cut, axis=0), np.minimum.reduceat(least, cut), np.minimum.reduceat(c0, cut), np.maximum.reduceat(c1, cut)))


    def parities(self, words: int, i: np.ndarray) -> np.ndarray:
        """Parities of documents of this many words or twice as many, as documents of this size class see them."""
        if words not in self.parity:
            m = self.parity[words] = np.zeros((len(self.odd), words), dtype=_U)
            for d in np.flatnonzero((self.words == words) | (self.words == 2 * words)).tolist():
                m[d] = folded(self.odd[d], words, np.bitwise_xor)
        return self.parity[words][i]


def apart(x: Tree, y: Tree, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A lower bound of the symmetric difference of documents i of x and j of y, of sizes in ratio 1 : 2 at most."""
    out, words = np.zeros(len(i), dtype=np.int64), np.minimum(x.words[i], y.words[j])
    for w in np.unique(words).tolist():
        at = np.flatnonzero(words == w)
        out[at] = np.bitwise_count(x.parities(w, i[at]) ^ y.parities(w, j[at])).sum(axis=1, dtype=np.int64)
    return out


def possible(x: Tree, y: Tree, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs may hold a pair of documents that reaches the threshold and lies in two components."""
    lx, hx, bx, px, cx, dx = (a[i] for a in x.levels[level])
    ly, hy, by, py, cy, dy = (a[j] for a in y.levels[level])
    ok = (100 * hx >= percent * ly) & (100 * hy >= percent * lx) & ~((cx == dx) & (cy == dy) & (cx == cy))
    at = np.flatnonzero(ok)
    if len(at):
        both = np.bitwise_count(bx[at] & by[at]).sum(axis=1, dtype=np.int64)
        # bits of a document that no document of the other node has are shingles it does not share
        ok[at] = (px[at] - both <= hx[at] - least_overlap(hx[at], ly[at], percent)) & (py[at] - both <= hy[at] - least_overlap(hy[at], lx[at], percent))
        if level == 0:
            at = np.flatnonzero(ok)
            ok[at] = apart(x, y, i[at], j[at]) <= lx[at] + ly[at] - 2 * least_overlap(lx[at], ly[at], percent)
    return ok


def traverse(x: Tree, y: Tree, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of x, j of y; i < j if same) of documents that the bitmaps and sizes allow."""
    top = max(len(x.levels), len(y.levels)) - 1
    for t in (x, y):
        while len(t.levels) <= top:
            t.levels.append(t.levels[-1])
    todo, out = [(top, np.array([0]), np.array([0]))], []
    while todo:
        level, i, j = todo.pop()
        good = possible(x, y, level, i, j, percent)
        i, j = i[good], j[good]
        if not len(i):
            continue
        if level == 0:
            keep = i < j if same else np.ones(len(i), dtype=bool)
            out.append((i[keep], j[keep]))
            continue
        nx, ny = len(x.levels[level - 1][0]), len(y.levels[level - 1][0])
        fx, fy = (1 if n == len(t.levels[level][0]) else t.fan for n, t in ((nx, x), (ny, y)))
        a = (i[:, None, None] * fx + np.arange(fx)[None, :, None] + np.zeros((1, 1, fy), np.int64)).ravel()
        b = (j[:, None, None] * fy + np.arange(fy)[None, None, :] + np.zeros((1, fx, 1), np.int64)).ravel()
        there = (a < nx) & (b < ny) & ((a <= b) if same else True)
        a, b = a[there], b[there]
        for s in range(0, len(a), FRONTIER):
            todo.append((level - 1, a[s : s + FRONTIER], b[s : s + FRONTIER]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p[0] for p in out]), np.concatenate([p[1] for p in out])


def forest(i: np.ndarray, j: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Of the pairs (i, j), those that reach the threshold, less those whose documents others or ``comp`` already connect.

    sets: the shingles of each document. A document's shingles are marked once for all its pairs."""
    out: list[tuple[int, int]] = []
    if not len(i):
        return np.empty((0, 2), dtype=np.int64)
    used, at = np.unique(np.concatenate((i, j)), return_inverse=True)
    sizes = np.array([len(sets[d]) for d in used])
    code = np.split(np.unique(np.concatenate([sets[d] for d in used]), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    mark = np.zeros(max(int(c.max()) for c in code if len(c)) + 1, dtype=bool)
    lab = np.unique(comp[used], return_inverse=True)[1]
    a, b = at[: len(i)], at[len(i) :]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    cuts = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]))
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        x = int(a[s])
        y = b[s:e][lab[b[s:e]] != lab[x]]
        if not len(y):
            continue
        mark[code[x]] = True
        common = np.add.reduceat(mark[np.concatenate([code[d] for d in y])], np.cumsum(sizes[y]) - sizes[y], dtype=np.int64)
        mark[code[x]] = False
        for d in y[100 * common >= percent * (sizes[x] + sizes[y] - common)].tolist():
            if lab[d] != lab[x]:
                lab[lab == lab[d]] = lab[x]
                out.append((used[x], used[d]))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def _verified(pairs: DataFrame, most: int, docs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that reach the threshold on their whole texts. pairs: a, b, distinct, ``most`` of them at most."""
    side = lambda x: sets.select(F.col("doc").alias(x), F.col("size").alias(f"s{x}"), F.col("odd").alias(f"b{x}"))

    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = (100 * p["sa"] >= percent * p["sb"]) & (100 * p["sb"] >= percent * p["sa"])
            p = p[ok]
            keep = []
            for s, t, x, y in zip(p["sa"], p["sb"], p["ba"], p["bb"]):
                words = min(len(x), len(y)) // 8
                u, v = folded(x, words, np.bitwise_xor), folded(y, words, np.bitwise_xor)
                keep.append(int(np.bitwise_count(u ^ v).sum()) <= s + t - 2 * least_overlap(s, t, percent))
            yield p[["a", "b"]][np.array(keep, dtype=bool)]

    pairs = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb", "ba", "bb")
    pairs = land(gathered(pairs, most, MAPS).mapInPandas(likely, "a long, b long"), "jac_likely")
    most = pairs.count()
    ids = land(gathered(pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct(), 2 * most), "jac_ids")
    texts = land(gathered(keep_ids(docs, ids, "doc").groupBy("doc").agg(F.min("text").alias("text")), 2 * most, TEXTS), "jac_texts")
    both = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if not len(p):
                continue
            good = []
            for x, y in zip(text_shingles(p["ta"].tolist(), n), text_shingles(p["tb"].tolist(), n)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield p[["a", "b"]][np.array(good)]

    return land(gathered(both.select("a", "b", "ta", "tb"), most, TEXTS).mapInPandas(verify, "a long, b long"), "jac_links")


def joined(docs: DataFrame, n: int = N, percent: int = PERCENT, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A set: distinct n-word shingles; fewer words: the whole sequence as one;
    no words or a null text: empty, linked with nothing. Two documents link when
    100 * intersection >= percent * union; component_id is the smallest doc_id
    reachable by links. Equal sets are always linked. Rows with a null doc_id
    have component null and link with nothing; rows of one doc_id with different
    texts all get the smallest component of them. No rows: no rows.
    """
    spark = docs.sparkSession
    python_workers(spark, 1000)
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    sets = land(sketches(rows, n, percent), "jac_sets")
    full = sets.where("size > 0 and doc is not null")
    n_rows, n_prefix = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("size") - F.ceil(percent * F.col("size") / 100) + 1), F.lit(0))).first()
    cls = land(gathered(full.groupBy("d1", "d2", "size").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("m")), n_rows), "jac_classes")
    others = full.select("doc", "d1", "d2", "size").join(cls.where("m > 1"), ["d1", "d2", "size"]).where("doc <> rep").select("doc").distinct()
    reps = keep_ids(full, land(gathered(others, n_rows), "jac_others"), "doc", how="left_anti").select("doc", "size", "bits", "odd", "prefix")
    # one row of an id that repeats
    twice = land(gathered(full.groupBy("doc").agg(F.count(F.lit(1)).alias("m")), n_rows).where("m > 1").select("doc"), "jac_twice")
    if not twice.isEmpty():
        once = keep_ids(reps, twice, "doc").groupBy("doc").agg(F.min(F.struct("size", "bits", "odd", "prefix")).alias("o")).select("doc", "o.*")
        reps = land(keep_ids(reps, twice, "doc", how="left_anti").union(once), "jac_reps")
    under = reps.select("doc", F.col("size").cast("int").alias("size"), F.posexplode("prefix").alias("at", "tok"))
    shared = land(gathered(under.groupBy("tok").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("hub")), n_prefix).where("n > 1"), "jac_shared")
    met = land(gathered(under.join(shared, "tok").select("tok", "doc", "size", "at", "hub"), n_prefix), "jac_met")
    n_met = met.count()
    links = _verified(met.where("doc <> hub").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct(), n_met, rows, reps, n, percent)

    comp = land(components(links), "jac_comp").withColumnRenamed("node", "doc")
    met = land(met.join(comp, "doc", "left").select("tok", "doc", "size", "at", F.coalesce("comp", "doc").alias("comp")), "jac_now")
    # shingles with the same documents are one, the first in the (unsigned) order of the prefixes; settled ones need no more, and of two documents one is the hub
    first = F.min(F.col("tok").bitwiseXOR(F.lit(-(1 << 63)))).bitwiseXOR(F.lit(-(1 << 63)))
    same = F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("h1"), F.sum(F.hash("doc").cast("long")).alias("h2")
    open_ = gathered(met.groupBy("tok").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), *same), n_met).where("c0 < c1 and n > 2")
    open_ = land(gathered(open_.groupBy("n", "h1", "h2").agg(first.alias("tok")).select("tok", "n"), n_met), "jac_open")
    in_leaf, size_ = F.col("n") <= LEAF, F.col("n")
    n_pairs, n_inside = open_.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in (F.when(in_leaf, size_ * (size_ - 1) / 2), F.when(~in_leaf, size_)))).first()
    small = met.join(open_.where(F.col("n") <= LEAF).select("tok"), "tok")
    x, y = small.alias("x"), small.alias("y")
    near = (F.col("x.doc") < F.col("y.doc")) & (F.col("x.comp") != F.col("y.comp")) & (100 * F.col("x.size") >= percent * F.col("y.size")) & (100 * F.col("y.size") >= percent * F.col("x.size"))
    # under the first shingle that two documents share, all before it differ, and so does what one has more after it
    before, rest = F.col("x.at") + F.col("y.at"), F.abs((F.col("x.size") - F.col("x.at")) - (F.col("y.size") - F.col("y.at")))
    both = F.col("x.size") + F.col("y.size")
    near &= before + rest <= both - 2 * F.ceil(percent * both / (100 + percent) - 1e-9)
    leaves = x.join(y, (F.col("x.tok") == F.col("y.tok")) & near).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))

    # documents of sizes in ratio percent / 100 lie in one band or two adjacent ones; up to a chunk of documents are one band
    band = F.when(F.col("n") <= chunk, 0).otherwise(F.floor(F.log("size") / float(np.log(100 / percent)) + 1e-9)).cast("int")
    inside = land(gathered(met.join(open_.where(F.col("n") > LEAF), "tok").withColumn("band", band).drop("n", "at"), n_met), "jac_inside")
    carried = ["doc", "comp", "size"]

    def to(df: DataFrame, kind: int, n: str, task) -> DataFrame:
        """A row for each of the n tasks of the other side that a document goes to: task(o) = (i, j, side)."""

        def cell(o):
            i, j, side = task(o)
            return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

        df = df.select("tok", "band", F.lit(kind).alias("kind"), F.explode(F.transform(F.sequence(F.lit(0), F.col(n) - 1), cell)).alias("p"), *carried)
        return df.select("tok", "band", "kind", "p.*", *carried)

    mine = lambda k: F.pmod(F.xxhash64("doc"), F.col(k)).cast("int")

    def dealt(inside: DataFrame, most: int, name: str) -> tuple[DataFrame, int]:
        """The documents of each group (tok) in every task where they meet others of their band or the next, and how many rows that are.

        inside: ``most`` rows at most."""
        chunks = F.ceil(F.greatest(F.count(F.lit(1)) / chunk, F.sum("size") / (chunk * LONG))).cast("int")
        per = land(gathered(inside.groupBy("tok", "band").agg(F.count(F.lit(1)).alias("m"), chunks.alias("k")), most), f"{name}_bands")
        # pairs lie within a band or between a band and the next; chunks of the two sides meet pairwise
        meets = per.join(per.select("tok", (F.col("band") - 1).alias("band"), F.col("k").alias("up"), F.col("m").alias("mu")), ["tok", "band"], "left")
        meets = land(gathered(meets.select("tok", "band", "m", "k", F.coalesce("up", F.lit(0)).alias("ku"), F.coalesce("mu", F.lit(0)).alias("mu")), most), f"{name}_meets")
        n_dealt = meets.agg(F.coalesce(F.sum(F.expr("m * k + m * ku + mu * k")), F.lit(0))).first()[0]
        meets = meets.drop("mu")
        lower = inside.join(meets, ["tok", "band"]).withColumn("c", mine("k"))
        upper = inside.withColumn("band", F.col("band") - 1).join(meets, ["tok", "band"]).withColumn("c", mine("ku"))
        out = to(lower.where("m > 1"), 0, "k", lambda o: (F.least("c", o), F.greatest("c", o), F.col("c") > o))
        out = out.union(to(lower.where("ku > 0"), 1, "ku", lambda o: (F.col("c"), o, F.lit(0))))
        return out.union(to(upper, 1, "k", lambda o: (o, F.col("c"), F.lit(1)))), n_dealt

    def meet(size: np.ndarray, comp: np.ndarray, ids: np.ndarray, side: np.ndarray, same: bool, packed: list[bytes], odd: list[bytes], whole: list[bytes] | None) -> np.ndarray:
        half = int((side == 0).sum())
        if not same and half in (0, len(ids)):
            return np.empty((0, 2), dtype=np.int64)
        words = min(map(len, packed)) // 8
        bits = np.stack([folded(x, words) for x in packed])
        if same:
            x = Tree(size, bits, odd, comp)
            i, j = traverse(x, x, True, percent)
        else:
            i, j = traverse(Tree(size[:half], bits[:half], odd[:half], comp[:half]), Tree(size[half:], bits[half:], odd[half:], comp[half:]), False, percent)
            j = j + half
        if whole is None:
            i, j = i[comp[i] != comp[j]], j[comp[i] != comp[j]]
            parent = _roots(np.arange(len(ids)), i, j)
            under = np.flatnonzero(parent != np.arange(len(ids)))
            return np.sort(np.stack((ids[under], ids[parent[under]]), axis=1), axis=1)
        return np.sort(ids[forest(i, j, comp, [np.frombuffer(t, dtype=_U) for t in whole], percent)], axis=1)

    task = ["tok", "band", "kind", "i", "j"]

    def met_in(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows come sorted by task; a task that goes on in the next batch waits for it."""

        def done(df: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
            size, comp, ids, side = (df[c].to_numpy() for c in ("size", "comp", "doc", "side"))
            packed, odd, kind, i, j = df["bits"].tolist(), df["odd"].tolist(), df["kind"].to_numpy(), df["i"].to_numpy(), df["j"].to_numpy()
            whole = df["whole"].tolist() if "whole" in df else None
            found = [meet(size[a:b], comp[a:b], ids[a:b], side[a:b], kind[a] == 0 and i[a] == j[a], packed[a:b], odd[a:b], whole[a:b] if whole else None) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

        held = None
        for b in batches:
            b = b if held is None else pd.concat((held, b), ignore_index=True)
            if not len(b):
                continue
            keys = b[task].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1))
            if len(cuts) > 1:
                yield done(b, cuts)
            held = b.iloc[cuts[-1] :]
        if held is not None and len(held):
            yield done(held, np.array([0, len(held)]))

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "whole": [t.tobytes() for t in text_shingles(b["text"].tolist(), n)]})

    def found(dealt: DataFrame, most: int, name: str) -> DataFrame:
        by_task = gathered(dealt.repartition(*task), most, chunk).sortWithinPartitions(*task, "side", "size", "doc")
        return land(gathered(by_task.mapInPandas(met_in, "a long, b long").distinct(), most), name)

    maps = reps.select("doc", "bits", "odd")
    at, n_dealt = dealt(inside, n_inside, "jac")
    near = found(at.join(maps, "doc"), n_dealt, "jac_near")
    n_near = near.count()
    cluster = components(near).select(F.col("node").alias("doc"), F.col("comp").alias("tok"))
    cluster = land(gathered(cluster.join(inside.select("doc", "comp", "size").distinct(), "doc"), 2 * n_near), "jac_clusters")
    many = cluster.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    cluster = land(gathered(cluster.join(many, "tok").withColumn("band", band).drop("n"), 2 * n_near), "jac_banded")
    texts = keep_ids(rows, land(cluster.select("doc"), "jac_near_ids"), "doc").groupBy("doc").agg(F.min("text").alias("text"))
    whole = land(gathered(texts, 2 * n_near, TEXTS).mapInPandas(shingled, "doc long, whole binary"), "jac_whole")
    at, n_dealt = dealt(cluster, 2 * n_near, "jac_cluster")
    links = links.union(found(at.join(maps, "doc").join(whole, "doc"), n_dealt, "jac_forest"))
    pairs = land(gathered(leaves.distinct(), int(n_pairs)), "jac_pairs")
    links = links.union(_verified(pairs, pairs.count(), rows, reps, n, percent))
    comp = land(components(links), "jac_comp")

    cls = cls.select("d1", "d2", "size", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("d1", "d2", "size", F.coalesce("comp", "rep").alias("comp"))
    cls = land(gathered(cls, n_rows), "jac_result")
    by = full.select("doc", "d1", "d2", "size").join(cls, ["d1", "d2", "size"]).groupBy("doc").agg(F.min("comp").alias("comp"))
    out = gathered(sets.select("doc", "size").join(by, "doc", "left"), n_rows)
    return out.select(F.col("doc").alias(key), F.col("size").alias("n_shingles"), F.coalesce("comp", "doc").alias("component_id"))
