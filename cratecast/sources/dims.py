"""Reference tables (S11) and result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import check


def read_crates(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Pieces per crate by material, from the user's own file.

    Expected columns: ``Material`` (int) and ``Unidad de Carga`` or
    ``Unidad_de_Carga`` (double). The table is one row per material of the
    catalogue; AQE broadcasts it when it is small and shuffles otherwise.
    """
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.load(path)
    if "Unidad de Carga" in df.columns:
        df = df.withColumnRenamed("Unidad de Carga", "Unidad_de_Carga")
    df = df.select(F.col("Material").cast("int"), F.col("Unidad_de_Carga").cast("double"))
    return check("dim_crates", df)


def write_plan(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("UNE",)) -> None:
    """Write a plan result (e.g. the route load) partitioned by unit.

    Replaces the original spreadsheet export: each unit's rows land in their
    own folder, written in parallel by the executors."""
    # a run for one unit replaces that unit's folder and no other
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_series(df: DataFrame, path: str) -> None:
    """A (week, litres) series as CSV with a header (S14). The series has
    one row per week; it is shuffled into one file, so the stages before it keep their tasks."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
