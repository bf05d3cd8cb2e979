"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import BANDS


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_round(x: Column | str, t: float) -> Column:
    """Round up when the fractional part is at least ``t``, else down."""
    x = _c(x)
    fl = F.floor(x)
    return F.when(x - fl >= F.lit(t), F.ceil(x)).otherwise(fl).cast("double")


def band(x: Column | str, q1: Column | float, q2: Column | float, q3: Column | float) -> Column:
    """Band label by three cut-points: <= q1, <= q2, <= q3, above."""
    x = _c(x)
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return (
        F.when(x <= lit(q1), F.lit(BANDS[0]))
        .when(x <= lit(q2), F.lit(BANDS[1]))
        .when(x <= lit(q3), F.lit(BANDS[2]))
        .when(x.isNotNull(), F.lit(BANDS[3]))
    )


def safe_div(a: Column | str, b: Column | str) -> Column:
    """Division that yields NULL instead of an error or +-inf for a zero divisor."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))


def clamp_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end`` with fractions; <= 0 becomes 0."""
    secs = F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000.0)
    return F.when(secs <= 0, F.lit(0.0)).otherwise(secs)


def half_even(x: Column | str, scale: int = 0, snap: int | None = 9) -> Column:
    """NumPy's ``round``: half to even on the binary value scaled by
    10^scale (``rint``), after snapping float noise at ``snap`` decimals.

    Snapping first makes the result independent of summation order: a mean
    that two engines compute 1 ulp apart rounds the same way. ``bround``
    is not used because it rounds the decimal text of the double, which
    differs from NumPy on binary near-ties."""
    v = _c(x) if snap is None else F.round(_c(x), snap)
    if scale == 0:
        return F.rint(v)
    m = F.lit(float(10**scale))
    return F.rint(v * m) / m


def code_to_int(c: Column | str) -> Column:
    """Numeric-looking code to int ('001' -> 1); bad codes become NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c).try_cast("int")
