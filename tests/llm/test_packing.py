"""Padding of the whole packing query against a plain dynamic program over all lengths."""

import random
from collections import Counter

import numpy as np
import pytest

from cratecast.llm.pack import best_boundaries, packed

DOCS = "doc_id long, text string"


def least_padding(lengths, buckets):
    """Brute force: every begin of every last bucket."""
    n = Counter(max(x, 1) for x in lengths)
    tops = sorted(n)
    cost = [[sum(n[t] * (tops[j] - t) for t in tops[i : j + 1]) for j in range(len(tops))] for i in range(len(tops))]
    best = [cost[0][j] for j in range(len(tops))]
    for _ in range(buckets - 1):
        best = [min([cost[0][j]] + [best[i - 1] + cost[i][j] for i in range(1, j + 1)]) for j in range(len(tops))]
    return best[-1] + sum(x == 0 for x in lengths)


def test_random_histograms_are_packed_best():
    rnd = random.Random(2)
    for _ in range(60):
        lengths = [rnd.choice([rnd.randint(1, 30), rnd.randint(1, 3000)]) for _ in range(rnd.randint(1, 70))]
        n = Counter(lengths)
        tops = sorted(n)
        k = rnd.randint(1, 9)
        got = best_boundaries(tops, [n[t] for t in tops], [n[t] * t for t in tops], k)
        assert len(got) <= k and set(got) <= set(tops) and got[-1] == tops[-1]
        assert sum(min(b for b in got if b >= x) - x for x in lengths) == least_padding(lengths, k)


def test_many_lengths():
    # evenly spread lengths: equal buckets are best, and no step is quadratic in them
    n = 120_000
    got = best_boundaries(np.arange(1, n + 1), np.ones(n, dtype=int), np.arange(1, n + 1), 8)
    assert got == [n * i // 8 for i in range(1, 9)]


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_query_has_the_least_padding(frame, buckets):
    rnd = random.Random(buckets)
    lengths = [0, 0, 1, 511, 512, 513, 514, 777, 40_000] + [rnd.choice([rnd.randint(0, 40), rnd.randint(500, 6000)]) for _ in range(110)]
    out = packed(frame([(i, " ".join(["w"] * n)) for i, n in enumerate(lengths)], DOCS), buckets=buckets, cell_rows=20).collect()
    assert sorted(r["n_tokens"] for r in out) == sorted(lengths)
    assert sum(r["padding"] for r in out) == least_padding(lengths, buckets)
    assert {r["bucket_len"] for r in out} <= set(lengths)


def test_more_lengths_than_the_bound_are_still_covered(frame):
    lengths = list(range(1, 400)) + [5000, 5001, 5003]
    out = packed(frame([(i, "w " * n) for i, n in enumerate(lengths)], DOCS), buckets=4, max_lengths=128).collect()
    assert len(out) == len(lengths) and min(r["padding"] for r in out) >= 0
    assert {r["bucket_len"] for r in out} <= set(lengths) and max(r["bucket_len"] for r in out) == 5003
    assert sum(r["padding"] for r in out) <= 1.1 * least_padding(lengths, 4)


def test_empty_texts_only(frame):
    out = packed(frame([(1, None), (2, ""), (3, " ")], DOCS)).collect()
    assert [(r["n_tokens"], r["bucket_len"], r["padding"]) for r in out] == [(0, 1, 1)] * 3
