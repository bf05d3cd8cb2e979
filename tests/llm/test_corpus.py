"""Mixing, packing, sharding, classifier, pipeline and the registered queries."""

import itertools
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cratecast.llm import pack
from cratecast.llm.classify import scored
from cratecast.llm.common import keep_ids
from cratecast.llm.mixing import mixed, targets
from cratecast.llm.oracle import ORACLE
from cratecast.llm.pack import best_boundaries, packed
from cratecast.llm.queries import QUERIES
from cratecast.llm.shard import fill_table, place

from .test_texts import brute_lines

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def level(sizes, weights, cap=3):
    """Shares by weight; the excess over the caps is shared again until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w, full = {s: weights[i % len(weights)] for i, s in enumerate(order)}, set()
    total = sum(sizes.values())
    while True:
        rest, still = total - sum(cap * sizes[s] for s in full), sum(w[s] for s in sizes if s not in full)
        out = {s: cap * sizes[s] if s in full else rest * w[s] / still for s in sizes}
        over = {s for s in sizes if s not in full and out[s] >= cap * sizes[s]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1000, None: 50}, {"a": 1, "b": 1, "c": 1000, "d": 3}, {"a": 5}, {"a": 0, "b": 10}, {"é": 10, "z": 900, "Z": 4, None: 0}])
def test_targets(frame, sizes):
    got = {r["source"]: r["target"] for r in targets(frame(list(sizes.items()), "source string, source_size long")).collect()}
    want = level(sizes, (5, 2, 1))
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_mixing(frame):
    rows = [(i, "word " * (i % 7 + 1), "en", ["a", "b", None][i % 3 if i % 9 else 0], 0) for i in range(300)] + [(1000, None, None, "a", 0), (1001, "", None, "empty", 0), (None, "null id here", None, "b", 0)] + [(7, "again", "en", "b", 0)] * 2
    out = mixed(frame(rows, DOCS), cells=8).collect()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, mixed(frame(rows[::-1], DOCS), cells=64).collect()))
    for s in ("a", "b", None):
        mine = [r for r in out if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 7
    assert all(r["taken"] == r["copies"] * r["size"] and r["taken"] <= 3 * r["size"] and r["copies"] - r["epochs"] in (0, 1) for r in out)
    assert mixed(frame([], DOCS)).count() == 0


def test_best_boundaries_are_optimal():
    lengths, counts = [2, 3, 7, 8, 20, 21, 40], [5, 1, 3, 9, 2, 2, 1]
    totals = [n * c for n, c in zip(lengths, counts)]

    def padding(tops):
        return sum(c * (min(t for t in tops if t >= n) - n) for n, c in zip(lengths, counts))

    for k in range(1, 8):
        want = min(padding((*x, 40)) for x in itertools.combinations(lengths[:-1], min(k, 7) - 1))
        assert padding(best_boundaries(lengths, counts, totals, k)) == want
    assert best_boundaries([], [], [], 4) == []


def test_packing(frame):
    rows = [(i, "w " * (i * i % 900), None, None, None) for i in range(400)] + [(9000, "w " * 30000, None, None, None), (9001, None, None, None, None), (None, "x", None, None, None)] + [(5, "same", None, None, None)] * 3
    out = packed(frame(rows, DOCS), buckets=6, budget=2000, cell_rows=50).collect()
    assert len(out) == len(rows) and len({r["bucket"] for r in out}) == 6
    cells = {}
    for r in out:
        assert r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0
        cells.setdefault((r["bucket"], r["batch"]), []).append(r)
    for members in cells.values():
        assert sorted(m["place"] for m in members) == list(range(len(members)))
        assert len(members) * members[0]["bucket_len"] <= 2000 or len(members) == 1
    for b in {k[0] for k in cells}:  # no gaps between batches
        assert sorted(k[1] for k in cells if k[0] == b) == list(range(sum(k[0] == b for k in cells)))
    assert packed(frame([], DOCS)).count() == 0


def test_boundary_step_covers_and_is_bounded(spark):
    got = spark.range(0, 3_000_000, 7).select("id", pack.boundary_step("id").alias("top")).agg(F.min(F.col("top") - F.col("id")), F.count_distinct("top")).first()
    assert got[0] >= 0 and got[1] <= pack.MAX_LENGTHS


def test_shard_table(spark, frame):
    names = [f"s{i}" for i in range(7)]
    table = fill_table(names, 1009)
    counts = [table.count(i) for i in range(7)]
    assert max(counts) - min(counts) <= 1
    less = fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, less) if a != 6)
    assert moved < 0.25 * 1009
    rows = frame([(1, "x", "keep"), (1, "y", "keep"), (None, "z", "keep")], "k long, slot string, v string")
    out = place(spark, rows, "k", names, 1009).collect()
    assert len(out) == 3 and len({r["shard"] for r in out if r["k"] == 1}) == 1
    for bad in (lambda: fill_table([], 7), lambda: fill_table(["a", "a"], 7), lambda: fill_table(["a"], 8)):
        with pytest.raises(ValueError):
            bad()


def test_keep_ids_both_ways(frame):
    df, ids = frame([(i,) for i in range(50)], "k long"), frame([(3,), (4,)], "k long")
    for limit in (1, 10):
        assert keep_ids(df, ids, "k", limit).count() == 2 and keep_ids(df, ids, "k", limit, how="left_anti").count() == 48


def test_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = scored(spark, docs.select("doc_id", "text"), labels).join(labels, "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 50 and sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_classifier_edges(spark, frame):
    labels = frame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    texts = [(i, "Plain words of prose, one after the other." if i % 2 else "JUNK!! JUNK!! JUNK!! " * 3, None, None, None) for i in range(40)]
    odd = [(100, None, None, None, None), (101, "", None, None, None), (102, " \n", None, None, None), (None, "Plain words of prose.", None, None, None)]
    docs = frame(texts + odd + texts[:2], DOCS).withColumn("score", F.lit("old"))
    out = scored(spark, docs, labels).collect()
    assert len(out) == 46
    by = {r["doc_id"]: r["score"] for r in out}
    assert by[100] == by[101] == by[102] == 0 and by[1] > 0.9 and by[0] < 0.1 and by[None] > 0.5
    none = scored(spark, docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0, 0.5}
    assert scored(spark, docs.limit(0), labels).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        n.append(docs.count())
    assert n[0] > n[1] >= n[3] > 0 and n[1] == n[2]
    last = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert last.count() == n[4]
    groups = docs.dropDuplicates(["doc_id"]).count()
    assert groups <= n[3]


def test_pipeline_keeps_one_of_exact_copies(spark, frame, tmp_path):
    rng = random.Random(3)
    texts = ["\n".join(" ".join("w%d" % rng.randrange(10**6) for _ in range(rng.choice([1, 4, 9]))) for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    texts += ["%s\nits own line %d" % (t, i) for i, t in enumerate(texts[:8])]  # parts of them are copies
    lines = ["line %d of a longer text" % i for i in range(40)]
    inner = next(p for k in range(2, 40) for p in ["\n".join(lines[:k])] if brute_lines(["\n".join(lines), p])[1][0] == "")
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(500, "\n".join(lines)), (501, inner), (502, inner)]
    frame([(i, t, "en", "abc"[i % 3], len(t)) for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    frame([(10**6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path)).cache()
    left = [r["doc_id"] for r in docs.collect()]
    # the first of each group stays, text 501 is all in text 500
    assert len(left) == len(set(left)) and set(left) <= {*range(len(texts)), 500} and {*range(40), 500} <= set(left)
    end = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert end and end <= set(left)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want, key=key)


def test_sharding_and_packing_queries_cover_documents(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op6_length_packing", "op9_shard_lookup"):
        assert QUERIES[name](spark, SF).count() == n
