"""Session helpers: runtime settings and lineage cuts.

Nothing here creates a global session; functions take the session they are
given. ``tune`` only sets runtime SQL options that are safe to change on a
live session.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot client may hold a third of all rows: split such partitions early
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on some deployments
            pass
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cratecast") -> SparkSession:
    """Session for tests and the bench (local mode, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


#: Folder that holds the package.
_HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package, wherever they are started."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _HOME not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, _HOME) if x)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session (or a checkpoint dir already set on the context).
    A local-mode session without one (tests) gets a fresh folder under the
    system temp dir; a cluster session without one is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master or ""):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before cutting lineage")
        d = tempfile.mkdtemp(prefix="cratecast-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write the stage as a Parquet table in the shared
    checkpoint folder and read it back.

    One job (``Dataset.checkpoint`` computes the plan twice unless it is also
    cached; the schema is known, so that no job infers it from the files),
    columnar on re-read, and the files survive the loss of any executor. Each
    call writes a fresh folder.
    """
    import uuid

    d = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{d}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _database(spark: SparkSession) -> str:
    """A catalog database whose folder is in the shared checkpoint folder, so that its tables are dropped with their files."""
    import hashlib

    d = checkpoint_dir(spark).rstrip("/")
    name = "cratecast_" + hashlib.md5(d.encode()).hexdigest()[:12]
    location = (d + "/" + name).replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def land_table(df: DataFrame, name: str, by: Sequence[str] = (), then: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, str]:
    """(the stage read back, its table): as ``materialize``, but a table that ``drop_tables`` removes again.

    ``by``: the rows are dealt once by these columns and stored in that many
    buckets as the session has shuffle partitions. Aggregates, windows and joins
    whose keys include them then need no exchange of this side.
    ``then``: what is done with the dealt rows before they are stored."""
    import uuid

    spark = df.sparkSession
    table = f"{_database(spark)}.{name}_{uuid.uuid4().hex}"
    if by:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # dealt as the buckets are, so that each bucket is one file
        x = df.repartition(n, *by)
        (then(x) if then else x).write.format("parquet").bucketBy(n, *by).saveAsTable(table)
    else:
        df.write.format("parquet").saveAsTable(table)
    return spark.table(table), table


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """The session's number of shuffle partitions, and of buckets, is n inside."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


@contextmanager
def joins_where_stored(spark: SparkSession) -> Iterator[None]:
    """Inside, sides of a join that are both dealt by some of its keys, as stored tables are by client, meet without an exchange."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def drop_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    """Drop landed tables with their files."""
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
