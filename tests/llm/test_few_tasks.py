"""Small tables between the stages of the n-gram join: as many tasks and files as their rows need, not one a shuffle partition."""

import random
from contextlib import contextmanager

from cratecast.llm import components, jaccard
from cratecast.llm.common import gathered

from .conftest import union_find

PARTITIONS = 67


@contextmanager
def many_partitions(spark):
    """As a session of many shuffle partitions that nothing coalesces."""
    conf = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_landings_follow_their_rows(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for d in range(240):
        w = list(base) if d < 160 else [f"v{rnd.randrange(40)}" for _ in range(60)]
        for at in rnd.sample(range(len(w)), 2):
            w[at] = f"x{rnd.randrange(3)}"
        texts.append(" ".join(w))
    texts += texts[:20]
    files = {}

    def spy(df, name):
        out = land(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    land = jaccard.land
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = [sorted(map(tuple, jaccard.joined(docs).collect()))]
    monkeypatch.setattr(jaccard, "land", spy)
    monkeypatch.setattr(components, "land", spy)
    with many_partitions(spark):
        out = jaccard.joined(docs)
        got.append(sorted(map(tuple, out.collect())))
        parts = out.rdd.getNumPartitions()
    assert got[0] == got[1] and 1 < len({r[2] for r in got[0]}) < len(texts) - 20
    cores = spark.sparkContext.defaultParallelism
    assert 2 * cores < PARTITIONS and files["jac_forest"] and files["cc_large"]
    # a file a core at most; the components are a union of two such tables
    assert {k: v for k, v in files.items() if v > cores * (1 + (k == "jac_comp"))} == {} and parts == cores


def test_components_with_many_partitions(spark, frame):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(400, 430)] + [(7, 7)]
    with many_partitions(spark):
        out = components.components(frame(pairs, "a long, b long"))
        got = {r["node"]: r["comp"] for r in out.collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    want = union_find({x for p in pairs for x in p}, pairs)
    assert got == {x: want[x] for x in nodes}


def test_gathered_grows_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 100, 1, 4 * cores)
    parts = lambda rows, each: gathered(df, rows, each).rdd.getNumPartitions()
    assert [parts(0, 10), parts(100, 100), parts(2 * cores * 10, 10), parts(10**9, 10)] == [cores, cores, 2 * cores, 4 * cores]
    assert gathered(df, 0).count() == 100
