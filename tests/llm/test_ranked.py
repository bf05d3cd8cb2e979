"""Ranked search against plain integer arithmetic."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.llm import ranked
from cratecast.llm.ranked import Block, search, term_counts

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=20):
    bags = [(d, Counter(words(t))) for d, t in docs if words(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None and t is not None:
            asked[i] = min(t, asked.get(i, t))
    out = []
    for i, t in asked.items():
        scores = []
        for d, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * b[w]) // (1000 * b[w] + 12 * m)) for w in words(t) if w in b)
            if s > 0 and d is not None:
                scores.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(40)] + ["É", "é", "Kelvin\u212a", "x1"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda: "".join(w + rng.choice([" ", "-", "\n", "\x00", "\u00a0", "_"]) for w in rng.choices(vocabulary, weight, k=rng.choice([1, 5, 40, 200])))
    docs = [(i, text()) for i in range(n)]
    docs += [(500 + i, docs[7][1]) for i in range(30)] + [(500, docs[7][1]), (900, None), (901, ""), (902, "-- \t"), (None, docs[3][1]), (903, "w39 " * 60_000), (904, "W39 w38")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 30])))) for i in range(25)] + [(100, docs[7][1]), (101, None), (102, ""), (103, "nowhere"), (104, "w39 W39 w38"), (105, "w0"), (None, "w1"), (105, "w1"), (106, "w0 " * 3)]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_matches_brute_force(frame, monkeypatch, small):
    if small:
        monkeypatch.setattr(ranked, "DOCS", 16)
        monkeypatch.setattr(ranked, "POSTINGS", 60)
        monkeypatch.setattr(ranked, "_FIRST_READ", 1)
    docs, items = corpus()
    df = frame(docs, DOCS).withColumns({"item_id": F.lit(1), "score": F.lit(2), "id": F.lit(3), "terms": F.lit("x")})
    got = search(df, frame(items, ITEMS).withColumns({"doc_id": F.lit(1), "item": F.lit(2), "term": F.lit("w1")}), max_terms=20 if small else ranked.MAX_TERMS)
    assert sorted(map(tuple, got.collect())) == brute(docs, items)


def test_search_of_nothing(frame):
    some, none = frame([(1, "a b")], DOCS), frame([], DOCS)
    items = frame([(1, "a"), (2, "")], ITEMS)
    assert search(none, items).count() == 0 and search(some, frame([], ITEMS)).count() == 0
    assert search(frame([(1, None), (2, "..")], DOCS), items).count() == 0
    assert search(some, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_are_bytes_of_the_lowered_text():
    for t in ("Ab é-c\x01d \u212a", "", None, "::", "A" * 10, "x\x7fy\x80z"):
        assert {k.decode(): n for k, n in term_counts(t).items()} == Counter(words(t))


def test_reading_stops_once_all_is_resolved():
    """Two selective terms settle the best documents before a long list of a frequent term is read."""
    rng = np.random.default_rng(1)
    n = 10_000
    doc = np.concatenate((np.arange(n), np.arange(30))).astype(np.int32)
    term = np.concatenate((np.zeros(n), np.ones(30))).astype(np.int32)
    # the best thirty also lead the long list
    impact = np.concatenate((rng.integers(1, 50, n), 10_000 + rng.integers(0, 1000, 30)))
    impact[:30] = 60
    block = Block(np.arange(n), doc, term, impact, 2)
    ids, scores, read = block.best(np.array([0, 1]), np.array([2, 1]), 20, 0)
    want = sorted(((-(int(impact[n + i]) + 120), i) for i in range(30)))[:20]
    assert sorted(zip((-scores).tolist(), ids.tolist()))[:20] == want and read < n / 2
