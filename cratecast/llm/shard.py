"""Sharding by a permutation-filled lookup table.

Shards take turns claiming slots of a prime-sized table, each in its own
preference order (offset + turn * skip mod size); the finished table is
broadcast and places a key by one hash and one lookup. Adding or removing one
shard moves few keys. The table has ``size`` rows whatever the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Index of the owning shard of each slot. Every shard gets size // n or one more slots."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime no smaller than the number of shards")
    at = [_number(s, "offset") % size for s in shards]
    skip = [_number(s, "skip") % (size - 1) + 1 for s in shards]
    table, left = [-1] * size, size
    while left:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def place(spark: SparkSession, df: DataFrame, key: str, shards: Sequence[str], size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """df with the slot (long) and shard (string) of each row.

    A null key goes to the slot of its hash like any other; equal keys go to
    one shard. Columns of df named like ``slot`` or ``shard`` are replaced.
    An empty table stays empty.
    """
    table = fill_table(shards, size)
    lookup = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], f"`{slot}` long, `{shard}` string")
    df = df.drop(slot, shard).withColumn(slot, F.pmod(F.xxhash64(F.col(key)), F.lit(size)).cast("long"))
    return df.join(F.broadcast(lookup), slot)


def sharded(spark: SparkSession, docs: DataFrame, n_shards: int = 64) -> DataFrame:
    """doc_id, slot, shard of every row of documents."""
    names = [f"shard-{i:04d}" for i in range(n_shards)]
    return place(spark, docs.select("doc_id"), "doc_id", names)
