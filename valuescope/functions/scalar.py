"""Scalar Column expressions shared by the operators.

All of these are compositions of ``pyspark.sql.functions`` so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal (matches timestamp_ntz input columns)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end``, floored (pandas ``.dt.days``).

    Uses the exact microsecond difference, so 10:00 the day before a
    midnight cutoff is 0 days, not 1 as ``datediff`` would say.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(micros / F.lit(float(MICROS_PER_DAY)))


def money(x) -> Column:
    """Money value as DECIMAL(30,10): sums are order-free and keep parts of a cent (rounding is left to reports)."""
    return _c(x).cast("decimal(30,10)")


def money_sum(x) -> Column:
    """Exact sum of a money column, returned as DOUBLE (NULL when no rows)."""
    return F.sum(money(x)).cast("double")


def safe_ratio(num, den, fill: float = 0.0) -> Column:
    """num / den with 0 or NULL denominators mapped to ``fill``."""
    den = _c(den)
    return F.coalesce(_c(num) / F.when(den != 0, den), F.lit(fill))


def clamp(x, lower=None, upper=None) -> Column:
    """``clip``: NULL stays NULL (``greatest``/``least`` would skip it)."""
    x = _c(x)
    out = x
    if lower is not None:
        out = F.when(out < F.lit(lower), F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(out > F.lit(upper), F.lit(upper)).otherwise(out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def qbin(rn, n, q: int) -> Column:
    """Equal-count bin (1..q) of 1-based rank ``rn`` among ``n`` rows.

    Reproduces quantile-cut over ranks 1..n: bin k holds ranks in
    (1+(n-1)(k-1)/q, 1+(n-1)k/q]; evaluated in integer arithmetic.
    """
    rn, n = _c(rn).cast("long"), _c(n).cast("long")
    b = F.floor(((rn - 1) * q + n - 2) / (n - 1))
    return F.when(n <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), b.cast("int"))).cast("int")


def risk_band(p) -> Column:
    """low [0, .33], medium (.33, .66], high (.66, 1]; input clipped to [0,1]."""
    p = clamp(p, 0.0, 1.0)
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(p <= 0.33, "low")
        .when(p <= 0.66, "medium")
        .otherwise("high")
    )


# Segment names and rule order (first match wins).
SEGMENT_ORDER = [
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "New Customers",
    "At Risk",
    "Cant Lose Them",
    "Hibernating",
    "Lost",
]


def rfm_segment(r, f) -> Column:
    r, f = _c(r), _c(f)
    return (
        F.when((r == 4) & (f == 4), "Champions")
        .when((r == 1) & (f == 4), "Cant Lose Them")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 3) & (f == 2), "Potential Loyalists")
        .when((r == 4) & (f == 1), "New Customers")
        .when((r == 1) & (f <= 2), "Lost")
        .otherwise("Hibernating")
    )


def md5_uniform(*parts) -> Column:
    """Uniform [0,1) from md5 of 'p1|p2|...'; portable (same value in DuckDB)."""
    s = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
