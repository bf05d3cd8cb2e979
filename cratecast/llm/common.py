"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, share_package

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: a Parquet table in the shared checkpoint folder."""
    return materialize(df, name)


#: Rows of a few numbers that one task takes where their number is known before.
TASK_ROWS = 250_000


def gathered(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """df, of ``rows`` rows at most, in no more tasks than they need: one for each ``each`` rows, but one a core.

    A session with hundreds of shuffle partitions else pays a task and a file for each of them, whatever the rows."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def python_workers(spark: SparkSession, rows: int = 10_000) -> None:
    """Let Python workers find this package, and hand them ``rows`` rows at a
    time, so that a batch of long texts fits a worker."""
    share_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores before them where a column (in any case) has such a name."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def n_words(text: str | Column) -> Column:
    """Number of words of a text; null text: 0."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


#: Landed tables of an id and a number up to this many rows (16 bytes each) are broadcast; longer ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def broadcast_checked(small: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """A landed table of narrow rows, marked for broadcast if a count shows ``limit`` rows or fewer."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def keep_ids(df: DataFrame, ids: DataFrame, key: str, limit: int = BROADCAST_IDS, how: str = "left_semi") -> DataFrame:
    """Rows of df whose key is in ids (one landed column of that name), or not
    in it (how="left_anti"), by a broadcast of a checked size or a shuffle."""
    return df.join(broadcast_checked(ids, limit), key, how)
