"""A large group of near copies, most pairs of it just apart: linear rows between stages, the links of brute force."""

import random

from cratecast.llm import jaccard
from cratecast.llm.words import text_shingles


def test_near_copies_leave_their_tasks_as_a_forest(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for d in range(260):
        w = list(base)
        for at in rnd.sample(range(120), 3):
            w[at] = f"x{rnd.randrange(3)}"
        texts.append(" ".join(w))
    rows = {}

    def spy(df, name):
        out = land(df, name)
        rows[name] = out.count()
        return out

    land = jaccard.land
    monkeypatch.setattr(jaccard, "land", spy)
    got = jaccard.joined(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85)
    got = {r.doc_id: r.component_id for r in got.collect()}

    sets = [set(t.tolist()) for t in text_shingles(texts, 4)]
    comp = list(range(len(sets)))
    apart = 0
    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
            else:
                apart += 1
    assert apart > 10_000 and len(set(comp)) < len(comp)
    assert got == dict(enumerate(comp))
    assert rows["jac_inside"] > 260
    assert rows["jac_near"] <= rows["jac_inside"] and rows["jac_forest"] < len(texts)
    assert rows["jac_pairs"] < 10 * len(texts)


def test_forest_keeps_a_link_between_every_two_components():
    import numpy as np

    sets = [np.array(s, dtype=np.uint64) for s in ([1, 2, 3, 4], [1, 2, 3, 5], [9], [1, 2, 3, 4, 5], [7, 8])]
    i, j = np.triu_indices(5, 1)
    got = jaccard.forest(i, j, np.arange(5), sets, 75)
    assert sorted(map(tuple, got.tolist())) == [(0, 3), (1, 3)]
    assert len(jaccard.forest(i, j, np.zeros(5, dtype=np.int64), sets, 75)) == 0
