"""Column-expression helpers (JVM-side built-ins only; no Python UDFs)."""

from valuescope.functions.scalar import (  # noqa: F401
    SEGMENT_ORDER,
    clamp,
    days_between,
    md5_uniform,
    money,
    money_sum,
    qbin,
    risk_band,
    rfm_segment,
    safe_ratio,
    ts_lit,
)
