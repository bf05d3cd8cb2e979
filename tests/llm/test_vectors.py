"""Embedding near-dedup, top-k and components against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.llm import neardup, topk
from cratecast.llm.components import components
from cratecast.llm.neardup import near_duplicates
from cratecast.llm.topk import top_k

from .conftest import union_find

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=160, dim=32, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    base[n // 2 :] = base[rng.integers(0, 6, n - n // 2)] + rng.standard_normal((n - n // 2, dim)) * 0.3
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(base)]


def odd_rows():
    nan, inf = math.nan, math.inf
    return [(900, None, 0), (901, [], 0), (902, [0.0] * 32, 0), (903, [None] + [1.0] * 31, 0), (904, [nan] * 32, 0), (905, [inf] * 32, 0), (None, [1.0] * 32, 0), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1)]


def brute_links(rows, cosine=0.9):
    good = [(i, np.array(v, dtype=float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    pairs = [(a, b) for n, (a, x) in enumerate(good) for b, y in good[n + 1 :] if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine]
    return pairs


@pytest.mark.parametrize("chunk", [17, 8192])
def test_near_duplicates_match_brute_force(frame, chunk):
    rows = vectors() + odd_rows() + [(500, vectors()[3][1], 9), (501, vectors()[3][1], 9)]
    got = {r["vec_id"]: r for r in near_duplicates(frame(rows, SCHEMA), chunk=chunk, block_dims=8).collect()}
    pairs = brute_links(rows)
    comp = union_find([r[0] for r in rows if r[0] is not None], pairs)
    assert len(pairs) > 100
    for i, c in comp.items():
        n = sum(i in p for p in pairs)
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n, c, i == c), i
    assert got[None]["component_id"] is None and got[None]["n_links"] == 0 and got[None]["kept"] is False


def test_every_block_pair_is_judged_once():
    rot = neardup.rotation(64)
    assert np.allclose(rot @ rot.T, np.eye(64))
    assert list(neardup.block_starts(64, 16)) == [0, 16, 32, 48] and list(neardup.block_starts(3, 16)) == [0]


def test_near_duplicates_of_nothing(frame):
    assert near_duplicates(frame([], SCHEMA)).count() == 0
    assert near_duplicates(frame([(1, None, 0)], SCHEMA)).collect()[0]["component_id"] == 1


def brute_top(rows, k, every=20):
    good = [(i, np.floor(64 * np.array(v, dtype=float)).astype(int)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for q, x in good:
        if q % every == 0:
            scores = sorted((-int(x @ y), i) for i, y in good if i != q and len(x) == len(y))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("small", [True, False])
def test_top_k_matches_brute_force(frame, monkeypatch, small):
    if small:
        monkeypatch.setattr(topk, "CANDIDATES", 37)
        monkeypatch.setattr(topk, "QUERIES", 3)
        monkeypatch.setattr(topk, "BINS", 4)
    rows = vectors() + odd_rows() + [(600 + i, vectors()[0][1], 5) for i in range(30)]  # ties beyond k
    got = sorted(map(tuple, top_k(frame(rows, SCHEMA), F.col("id") % 20 == 0).collect()))
    assert got == brute_top(rows, 20)


def test_top_k_of_few_rows(frame):
    assert top_k(frame([], SCHEMA), F.col("id") % 20 == 0).count() == 0
    assert top_k(frame([(0, [1.0], 0)], SCHEMA), F.col("id") % 20 == 0).count() == 0
    got = top_k(frame([(0, [1.0, 0.5], 0), (1, [-1.0, 0.0], 0)], SCHEMA), F.col("id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, -4096)]


def test_components_of_chains_and_hubs(frame):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(200, 200), (None, 3), (300, 301), (301, 300)]
    rng.shuffle(pairs)
    got = {r["node"]: r["comp"] for r in components(frame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components(frame([], "a long, b long")).count() == 0
