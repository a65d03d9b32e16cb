"""Seeded samples without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuescope.functions import md5_uniform

#: Parts of a stratum that are cut to k rows by themselves before they meet.
PARTS = 256


def bottom_k(df: DataFrame, k: int, seed: int, key: str = "customer_id", strata: list[str] | None = None) -> DataFrame:
    """At most ``k`` rows of each stratum (or of all rows): those of the least md5 of (seed, key).

    The choice depends on seed and keys alone, not on partitioning, and bottom-k sets merge: the k
    least of a whole are among the k least of its parts. Each stratum is cut in ``PARTS`` parts by
    hash, which keep k rows each, then their rows in one, so a stratum of a third of
    all rows is no hot group: at most ``PARTS`` * k rows of a stratum meet. NULL strata are a
    stratum; ties (repeated keys) go by key, then by the row's hash; rows without a key count too.
    """
    if k < 0:
        raise ValueError("the sample size can't be negative")
    strata = strata or []
    draw = df.withColumn("_u", md5_uniform(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))).withColumn("_h", F.xxhash64(*df.columns))
    order = ["_u", key, "_h"]
    part = F.pmod("_h", F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy(*strata, part).orderBy(*order))
    last = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    cut = draw.withColumn("_r", first).filter(F.col("_r") <= k)
    return cut.withColumn("_r", last).filter(F.col("_r") <= k).drop("_u", "_h", "_r")
