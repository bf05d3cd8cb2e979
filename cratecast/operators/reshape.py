"""Reshape operators (R1, R3, R6) and the cumulative share cut (T4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import running_share


def pivot_days(df: DataFrame, keys: Sequence[str], col: str, days: Sequence[tuple[int, str]], day_col: str = "Dia",
               extra: Sequence = ()) -> DataFrame:
    """Sum of ``col`` per key with one column per named weekday (R1), plus
    any ``extra`` aggregate columns computed in the same pass.

    A single conditional aggregation over the explicit weekday list: no
    scan for pivot values, and a weekday without rows is 0 (``fillna(0)``)."""
    return df.groupBy(*keys).agg(
        *extra,
        *[F.coalesce(F.sum(F.when(F.col(day_col) == d, F.col(col))), F.lit(0.0)).alias(name) for d, name in days],
    )


def melt_days(df: DataFrame, keys: Sequence[str], days: Sequence[str], name: str = "Dia", value: str = "Total") -> DataFrame:
    """Weekday columns back to rows."""
    return df.unpivot(list(keys), list(days), name, value)


def complete_grid(df: DataFrame, keys: Sequence[str], col: str, lo: int, hi: int) -> DataFrame:
    """Every distinct ``keys`` combination of ``df`` x ``col`` in lo..hi (R6),
    built with ``sequence`` + ``explode`` (no row loop, no cross join)."""
    combos = df.select(*keys).distinct()
    return combos.select(*keys, F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias(col))


def cut_share(df: DataFrame, key: str, col: str, limit: float, tie: str, decimals: int = 9) -> tuple[DataFrame, DataFrame]:
    """Keep rows while the running share per ``key`` (largest first, ties by
    ``tie``), rounded to ``decimals``, stays below ``limit`` (T4).

    Returns (kept rows, rows of keys with nothing kept). Rounding first makes
    a share that reaches ``limit`` up to float noise count as reaching it."""
    r = running_share(df, key, col, tie, "_agg")
    kept = r.filter(F.round("_agg", decimals) < F.lit(limit)).drop("_agg")
    lost = df.join(kept.select(key).distinct(), key, "left_anti")
    return kept, lost
