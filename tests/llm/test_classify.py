"""Votes of the quality classifier against dense NumPy arithmetic over plain Python counts."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cratecast.llm import classify
from cratecast.llm.classify import held_out, scored, term_counts
from cratecast.llm.words import word_hashes

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"
KINDS = ["\x00 ", "\n", "\t\x0b\x0c\r", "0123456789", ".", ",;:", "!", "?", "|", "#*$%&@^~+=", "()[]{}<>/\\", "'\"`-_"]


def kind(c):
    return 13 if c >= 128 or 97 <= c <= 122 else 14 if 65 <= c <= 90 else next((i for i, k in enumerate(KINDS) if chr(c) in k), 12)


def bag(text):
    """({shape or word term: count}, number of words)."""
    data = text.encode()
    code = [kind(c) for c in data] + [0, 0]
    out = Counter(("s", code[i], code[i + 1], code[i + 2]) for i in range(len(data)))
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in data))
    for lag in (1, 2, 3):
        out["s", lag] = sum(a == b for a, b in zip(words, words[lag:]))
    for w in words:
        out["w", int(word_hashes([w])[0][0]) >> 49] += 1
    return {k: n for k, n in out.items() if n}, len(words)


def brute(docs, labels, k=15):
    """Scores with every latent dimension kept: cosines within the span of the labelled rows."""
    taught = [(bag(t), labels[i]) for i, t in docs if t and i in labels]
    terms = sorted({t for (b, _), _ in taught for t in b} | {t for _, x in docs if x for t in bag(x)[0]}, key=str)
    at = {t: j for j, t in enumerate(terms)}
    n = len(taught)
    df = Counter(t for (b, _), _ in taught for t in b)
    idf = np.array([np.float32(math.log((1 + n) / (1 + df[t])) + 0.1) for t in terms], float)

    def vector(b, words):
        x = np.zeros(len(terms))
        for t, c in b.items():
            x[at[t]] = (1 + math.log(c) if t[0] == "w" else math.sqrt(c / max(words, 1))) * idf[at[t]]
        for v in "sw":
            own = np.array([t[0] == v for t in terms])
            x[own] *= (classify.WORD_WEIGHT if v == "w" else 1) / max(np.linalg.norm(x[own]), 1e-12)
        return x

    rows = np.array([vector(*b) for b, _ in taught])
    span = np.linalg.svd(rows, full_matrices=False)[2]
    unit = lambda z: z / np.maximum(np.linalg.norm(z, axis=-1, keepdims=True), 1e-12)
    latent, y = unit(rows @ span.T), np.array([v for _, v in taught])
    out = {}
    for i, t in docs:
        b, words = bag(t or "")
        sims = latent @ unit(vector(b, words) @ span.T)
        near = np.argsort(-sims)[:k]
        w = np.maximum(sims[near], 0)
        out[i] = float((w * y[near]).sum() / max(w.sum(), 1e-300)) if words else 0.0
    return out


def corpus(n=60):
    rng = random.Random(4)
    good, bad = ["river", "stone", "Éclair", "walk", "Bread", "window", "letter"], ["BUY", "$$$", "now!!!", "###", "win", "x9x9"]
    docs = [(i, " ".join(rng.choices(good if i % 2 else bad, k=rng.randrange(3, 30))) + rng.choice([".", "\n", ""])) for i in range(n)]
    return docs + [(500, None), (501, ""), (502, " \t"), (503, "river " * 40_000), (504, "win win win"), (505, "Zebra quilts\x00\x7f(jump)")]


def test_scores_match_dense_arithmetic(spark, frame):
    docs = corpus()
    df = frame(docs, DOCS)
    out = {r["doc_id"] for r in df.where(held_out()).collect()}
    labels = {i: i % 2 for i, _ in docs if i < 40 and i not in out}
    given = [(i, y) for i, y in labels.items()] + [(i, 0) for i in out] + [(None, 1), (1000, 1), (45, None), (46, 7), (502, None)]
    got = {r["doc_id"]: r["score"] for r in scored(spark, df, frame(given, LABELS)).collect()}
    want = brute(docs, labels)
    assert len(labels) < classify.DIMENSIONS and got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-3


def test_texts_of_one_shape_differ_by_their_words():
    a, b = b"The quick brown foxes jump over lazy dogs.", b"Xqz vbnmk plorw tyxas grwq kjhg mnbv cxzl."
    x, y = term_counts([a]), term_counts([b])
    shape = lambda t: t.terms[t.terms < classify._SHAPES].tolist()
    assert shape(x) == shape(y) and x.terms.tolist() != y.terms.tolist()
    words = [b"alpha beta gamma delta", b"omega sigma kappa theta"]
    bags = term_counts([w for w in words for _ in range(4)])
    model = classify.fit(bags, np.array([1] * 4 + [0] * 4), k=3)
    assert model.score(term_counts([b"alpha beta delta gamma", b"sigma kappa omega theta"])).tolist() == [1.0, 0.0]


def test_a_repeated_id_teaches_one_row(spark, frame):
    docs = [(i, t) for i, t in corpus(30) if t] + [(1, "win win ### now!!!"), (1, "river stone"), (3, "BUY")]
    labels = [(i, i % 2) for i in range(30)] + [(1, 0), (3, 1), (3, 1)]
    runs = [sorted((r["doc_id"], r["text"], r["score"]) for r in scored(spark, frame(docs[::s], DOCS).repartition(p), frame(labels[::s], LABELS)).collect()) for s, p in ((1, 1), (-1, 5))]
    assert len(runs[0]) == len(docs) and all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 for a, b in zip(*runs))


def test_clashing_columns_stay(spark, frame):
    df = frame(corpus(20), DOCS).withColumns({c: F.lit("mine") for c in ("y", "_y", "terms", "counts", "words", "score", "quality")})
    rows = scored(spark, df, frame([(i, i % 2) for i in range(20)], LABELS)).collect()
    assert len(rows) == 26 and all(r["y"] == r["_y"] == r["terms"] == r["quality"] == "mine" and 0 <= r["score"] <= 1 for r in rows)
