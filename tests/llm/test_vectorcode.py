"""Vector codes with pivots against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.llm import vectorcode
from cratecast.llm.vectorcode import encoded, far_apart, distances, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(n=90, dim=8, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i) * 3 % 97, [float(np.float32(x)) for x in rng.standard_normal(dim) * spread], int(i) % 4 if i % 7 else None) for i in range(n)]


def odd_rows(dim=8):
    return [(1, None, 0), (2, [], 0), (4, [math.nan] * dim, 1), (5, [math.inf] + [0.0] * (dim - 1), 1), (7, [None] + [1.0] * (dim - 1), 2), (90, [1.0, 2.0], 2), (91, [1.0] * 4, 0)]


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    dim = None
    good = sorted(((i is None, i, v, y) for i, v, y in rows if v and None not in v and np.isfinite(v).all() and len(v) % parts == 0), key=lambda r: (r[0], r[1] or 0, r[2]))
    dim = len(good[0][2])
    good = [(i, [math.floor(scale * x) for x in v], y) for _, i, v, y in good if len(v) == dim]
    w = dim // parts
    cut = lambda q, p: q[p * w : (p + 1) * w]
    books = [[cut(q, p) for _, q, _ in good[:entries]] for p in range(parts)]
    near = lambda x, b: min((sum((a - c) ** 2 for a, c in zip(x, e)), k) for k, e in enumerate(b))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, q, _ in good:
                own.setdefault(near(cut(q, p), books[p])[1], []).append(cut(q, p))
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by = [], {}
    for i, q, y in good:
        got = [near(cut(q, p), books[p]) for p in range(parts)]
        out.append((i, "".join("%02x" % k for _, k in got), sum(d for d, _ in got), y))
        by[y] = by.get(y, 0) + out[-1][2]
    fits = lambda x: x if x < 1 << 63 else None
    return [(i, c, fits(e), fits(by[y]), digest) for i, c, e, y in out]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r[:4] if not isinstance(x, str)) + (r[1],))


@pytest.mark.parametrize("entries, strip", [(256, 2048), (7, 5), (1, 2048)])
def test_codes_match_brute_force(frame, monkeypatch, entries, strip):
    monkeypatch.setattr(vectorcode, "_STRIP", strip)
    rows = rows_of() + odd_rows() + [rows_of()[3], (None, rows_of()[5][1], 1)] + [(i, [0.25] * 8, 3) for i in (200, 201, 202)]
    df = frame(rows, SCHEMA).withColumns({"code": F.lit("x"), "error": F.lit(1), "y": F.lit(2), "v": F.lit(3), "id": F.lit(4)})
    assert ordered(encoded(df, entries=entries).collect()) == ordered(brute(rows, entries=entries))


def test_huge_components_stay_exact(frame):
    big = float(np.float32(3e38))
    rows = rows_of(40) + [(300, [big] * 8, 0), (301, [-big, big] * 4, 1), (302, [2e5] * 8, None), (303, [big] * 8, 2), (-1, [4e5] * 8, 3)]
    assert ordered(encoded(frame(rows, SCHEMA), entries=5).collect()) == ordered(brute(rows, entries=5))
    wide = [(i, [1e20 * i, 0.0, 0.0, 1.0], 0) for i in range(4)]
    got = ordered(encoded(frame(wide, "vec_id long, embedding array<double>, label int"), entries=2, rounds=1).collect())
    assert got == ordered(brute(wide, entries=2, rounds=1)) and any(r[2] is None for r in got)


def test_pivots_prune_and_keep_ties_to_the_lower_entry():
    rng = np.random.default_rng(2)
    entries = rng.integers(-1000, 1000, (256, 4))
    entries[200] = entries[3]
    x = np.concatenate((rng.integers(-1000, 1000, (300, 4)), entries[[200, 3, 7]]))
    pivots = far_apart(entries, 8)
    assert len(pivots) == 8 and len(far_apart(entries[:1], 8)) == 1
    index, best, made = nearest(x, entries, distances(x, pivots).astype(np.float32), distances(entries, pivots))
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all() and index[-3] == 3
    assert made < 0.25 * d.size


def test_no_usable_vectors(frame):
    for rows in ([], [(1, None, 0)], odd_rows()[:5]):
        df = encoded(frame(rows, SCHEMA))
        assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and df.count() == 0
    with pytest.raises(ValueError):
        encoded(frame([], SCHEMA), entries=257)
