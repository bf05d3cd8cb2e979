"""URL filter against plain Python, with filters that let nearly everything through."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratecast.llm import urlfilter
from cratecast.llm.urlfilter import bloom_words, judged, may_hold, rules_frame

URLS = "page_id long, url string"
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "EXAMPLE.org/fr/x"), ("allow", "a.b.c/"), ("block", "b.c/xyz"), ("block", "/none"), ("block", "host"), ("allow", "example.com/de/"), ("block", "a.net/p/q"), ("allow", "net/p/q/rr")]


def lowered(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    path = rest[n:]
    m = min([path.index(c) for c in "?#" if c in path] + [len(path)])
    return lowered(rest[:n]), path[:m]


def brute(url, rules, otherwise="allow"):
    host, path = parts(url)
    found = []
    for verdict, text in rules:
        h = lowered(text.partition("/")[0])
        p = text[len(h) :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            found.append((len(h + p), len(h), h + p, verdict))
    best = max(found, default=None)
    return host, path, best and best[2], best[3] if best else otherwise


def urls(seed=1, n=400):
    rng = random.Random(seed)
    hosts = ["net", "x.net", "example.net", "m.Example.NET", "example.com", "a.example.com", "org", "q.org", "example.org", "x.a.b.c", "a.b.c", "b.c", "host", "a.net", "xnet", "example.net.", "example.com:80", "é.ORG", ""]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/x", "/fr/xy?z", "/EN/", "?q=/en/", "#/en/", "/p/q/rr", "/p/q", "/xyz", "/none", "/a\nb/", "/é"]
    out = [rng.choice(["http://", "https://", "", "://", "a://b://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(n)]
    return out + [None, "", "://", "http:/", "http://net/" + "a/" * 50_000, "http://" + "a." * 20_000 + "net/x", "http://x.net/\u0130"]


@pytest.mark.parametrize("blocks, broadcast", [(urlfilter.MAX_BLOCKS, 16 << 20), (1, -1)])
def test_verdicts_match_plain_python(spark, frame, monkeypatch, blocks, broadcast):
    monkeypatch.setattr(urlfilter, "BROADCAST_BYTES", broadcast)
    more = [("block", f"h{i}.example.net/d{i}/") for i in range(300)] if blocks == 1 else []  # fills the only block
    texts = urls() + [f"http://s.h{i}.example.net/d{i}/{i}" for i in range(0, 40)] + ["http://x.net/"] * 50
    df = frame(list(enumerate(texts)), URLS)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged(df, rules_frame(spark, RULES + more), most_blocks=blocks).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == brute(t, RULES + more), t


def test_clashing_columns_repeated_rows_and_nothing(spark, frame):
    names = ["host", "rule", "VERDICT", "tail", "_tail", "start", "maybe", "f_tail", "f_rule", "r_host", "n", "best"]
    df = frame([(1, "http://x.net/"), (1, "http://x.net/"), (None, None)], URLS).withColumns({c: F.lit("mine") for c in names})
    rows = judged(df, rules_frame(spark, RULES), otherwise="keep").collect()
    assert sorted((r["page_id"] or 0, r["rule"] or "", r["verdict"], r["tail"], r["_tail"], r["n"]) for r in rows) == [(0, "", "keep", "mine", "mine", "mine"), (1, "net/", "block", "mine", "mine", "mine"), (1, "net/", "block", "mine", "mine", "mine")]
    assert judged(frame([], URLS), rules_frame(spark, RULES)).count() == 0
    nothing = spark.createDataFrame([(None, "/", "block"), ("net", None, "block"), ("net", "/", None)], "host string, path string, verdict string")
    assert [r["verdict"] for r in judged(df, nothing).collect()] == ["allow"] * 3


def test_filter_never_misses_and_rejects_most(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    words = bloom_words(keys)
    ours = np.array([r["h"] for r in keys.collect()])
    others = np.array([r["h"] for r in spark.range(10**6, 10**6 + 20_000).select(F.xxhash64("id").alias("h")).collect()])
    assert may_hold(words, ours).all() and may_hold(words, others).mean() < 0.02
    assert not may_hold(bloom_words(keys.limit(0)), others).any()
