"""URL filter: a blocked Bloom filter before an exact hash join.

Listed canonical URLs (host and start of the path) and their hosts are keys of
a blocked Bloom filter: a key sets ``PROBES`` bits within one block of 512
bits. The filter is built by a bitwise aggregation and has at most
``MAX_BLOCKS`` blocks (8 MB), however long the list is; a longer list only
lets more false positives through. A url is probed in the scan under its host
and parent domains; only possible hits go on, shortened to what rules can tell
apart and made distinct, to hash joins with the listed hosts and the rules,
which remove the false positives.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, land, python_workers

BITS_PER_KEY, BLOCK_BITS, PROBES = 16, 512, 4
#: 512 bits each: 8 MB at most.
MAX_BLOCKS = 1 << 17
#: A landed table of up to this many bytes is broadcast; a longer one is joined by a shuffle.
BROADCAST_BYTES = 16 << 20
_CHUNK = 1 << 13  # words of 64 bits in a collected row
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """(host, path): the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    goes on up to ``?``, ``#`` or the end. Null urls and those without ``://``: both empty."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(host, path, verdict) of rules given as (verdict, "host/path")."""
    rows = [(t.partition("/")[0], t[len(t.partition("/")[0]) :], v) for v, t in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def bloom_words(keys: DataFrame, most_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """The filter of 64-bit keys (column ``h``) as words of 64 bits, eight to a block."""
    blocks = min(most_blocks, max(1, -(-keys.count() * BITS_PER_KEY // BLOCK_BITS)))
    bits = keys.select(F.pmod(F.shiftrightunsigned("h", 36), F.lit(blocks)).alias("b"), F.explode(F.array(*[F.shiftright("h", 9 * i).bitwiseAND(511) for i in range(PROBES)])).alias("i"))
    words = bits.groupBy((F.col("b") * 8 + F.shiftright("i", 6)).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(i & 63 as int))")).alias("x"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(_CHUNK, np.int64)
        out[pdf["w"].to_numpy() % _CHUNK] = pdf["x"].to_numpy()
        return pd.DataFrame({"c": [int(pdf["w"].iloc[0]) // _CHUNK], "v": [out.tobytes()]})

    out = np.zeros(-(-blocks * 8 // _CHUNK) * _CHUNK, np.uint64)
    for r in words.groupBy(F.floor(F.col("w") / _CHUNK).alias("c")).applyInPandas(packed, "c long, v binary").collect():
        out[r["c"] * _CHUNK : (r["c"] + 1) * _CHUNK] = np.frombuffer(r["v"], np.uint64)
    return out[: blocks * 8]


def may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each 64-bit key; never False for a key it holds."""
    h = np.ascontiguousarray(h, np.int64).view(np.uint64)
    block = (h >> np.uint64(36)) % np.uint64(len(words) // 8) * np.uint64(8)
    found = np.ones(len(h), bool)
    for i in range(PROBES):
        bit = (h >> np.uint64(9 * i)) & np.uint64(511)
        found &= (words[(block + (bit >> np.uint64(6))).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return found


def _light(df: DataFrame) -> DataFrame:
    """A landed table, marked for broadcast if a count of its bytes allows that."""
    size = [F.coalesce(F.octet_length(c) if t == "string" else F.size(c) * 4 if t.startswith("array") else F.lit(8), F.lit(0)) for c, t in df.dtypes]
    total = df.agg(F.sum(sum(size, F.lit(64)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def judged(urls: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", most_blocks: int = MAX_BLOCKS) -> DataFrame:
    """urls with host, path, rule ("host/path" of the rule that decides, else null) and verdict.

    rules: columns host, path, verdict. A rule fits its host and all subdomains
    if the url's path starts with the rule's path. The longest rule that fits
    decides, of equally long ones the one with the longer host; without one the
    verdict is ``otherwise``, for urls on no list. Rows of rules with a null are
    left out; of rules alike in host and path the verdict last in order counts
    ("block" before "allow"). Hosts of rules are lower-cased, A-Z only.

    A null url, an empty one or one without ``://`` has an empty host and path
    and fits only rules for the empty host. Whole urls of any length are judged.
    Repeated rows stay and are judged alike; columns named host, path, rule or
    verdict are replaced, all others kept. No urls: no rows; no rules: every
    verdict is ``otherwise``.
    """
    spark = urls.sparkSession
    python_workers(spark)
    urls = urls.drop("host", "path", "rule", "verdict") if url not in ("host", "path", "rule", "verdict") else urls
    listed = rules.where("host is not null and path is not null and verdict is not null").groupBy(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"))
    listed = land(listed.agg(F.max("verdict").alias("r_verdict")), "url_rules")
    by_host = listed.groupBy("r_host").agg(F.sort_array(F.collect_set(F.length("r_path"))).alias("r_lengths"))  # at most the longest path's length of them
    by_host = land(by_host, "url_hosts")
    words = bloom_words(by_host.select(F.xxhash64("r_host").alias("h")).union(listed.select(F.xxhash64("r_host", "r_path").alias("h"))), most_blocks)
    filled = spark.sparkContext.broadcast(words)
    deepest, longest = listed.agg(F.max(F.size(F.split("r_host", r"\."))), F.max(F.length("r_path"))).first()
    deepest, longest = deepest or 1, longest or 0

    @F.arrow_udf("boolean")
    def any_listed(h: pa.Array) -> pa.Array:
        hits = np.concatenate(([0], np.cumsum(may_hold(filled.value, np.asarray(h.values)))))
        at = np.asarray(h.offsets)
        return pa.array(hits[at[1:]] > hits[at[:-1]])

    @F.arrow_udf("boolean")
    def one_listed(h: pa.Array) -> pa.Array:
        return pa.array(may_hold(filled.value, np.asarray(h)))

    tail, start, maybe, f_tail, f_start, f_rule, f_verdict = free_names(urls.columns, "tail", "start", "maybe", "f_tail", "f_start", "f_rule", "f_verdict")
    host, path = url_parts(url)
    rows = urls.withColumns({"host": host, "path": path})
    # no rule can tell apart what lies before the deepest listed host's labels or behind the longest listed path
    labels = F.split("host", r"\.")
    rows = rows.withColumns({tail: F.slice(labels, F.greatest(F.lit(1), F.size(labels) - (deepest - 1)), F.lit(deepest)), start: F.substring("path", 1, longest)})
    parents = lambda c: F.transform(F.sequence(F.lit(1), F.size(c)), lambda i: F.array_join(F.slice(c, i, F.size(c)), "."))
    rows = rows.withColumn(maybe, any_listed(F.transform(parents(F.col(tail)), lambda x: F.xxhash64(x)))).withColumn(tail, F.array_join(tail, "."))
    possible = rows.where(maybe).select(F.col(tail).alias("f_tail"), F.col(start).alias("f_start")).distinct()
    under = possible.select("f_tail", "f_start", F.explode(parents(F.split("f_tail", r"\."))).alias("r_host")).join(_light(by_host), "r_host")
    under = under.select("f_tail", "f_start", "r_host", F.explode(F.filter("r_lengths", lambda n: n <= F.length("f_start"))).alias("n"))
    under = under.select("f_tail", "f_start", "r_host", F.expr("substring(f_start, 1, n)").alias("r_path"))
    under = under.where(one_listed(F.xxhash64("r_host", "r_path"))).join(_light(listed), ["r_host", "r_path"])
    rule = F.concat("r_host", "r_path")
    found = under.groupBy("f_tail", "f_start").agg(F.max(F.struct(F.length(rule).alias("n"), F.length("r_host").alias("m"), rule.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    found = land(found.select(F.col("f_tail").alias(f_tail), F.col("f_start").alias(f_start), F.col("best.rule").alias(f_rule), F.col("best.verdict").alias(f_verdict)), "url_found")
    small = _light(found)
    on = (F.col(tail) == F.col(f_tail)) & (F.col(start) == F.col(f_start))
    if small is found:  # too long a table to broadcast: only possible hits are shuffled
        rest = rows.where(~F.col(maybe)).withColumns({f_rule: F.lit(None).cast("string"), f_verdict: F.lit(None).cast("string")})
        out = rows.where(maybe).join(found, on, "left").drop(f_tail, f_start).unionByName(rest)
    else:
        out = rows.join(small, on, "left")
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    return out.select(*[F.col(f"`{c}`") for c in kept], "host", "path", F.col(f_rule).alias("rule"), F.coalesce(f_verdict, F.lit(otherwise)).alias("verdict"))
