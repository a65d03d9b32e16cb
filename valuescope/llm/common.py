"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.session import checkpoint_dir, let_workers_import

#: One of so many parts of the hash space; sampling fractions are multiples of it.
HASH_PARTS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key's text modulo ``n``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def give_back() -> None:
    """Hands unused memory of a Python worker back to the system, where it can be."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow, which gives memory back when a task is done: workers outlive their tasks."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def keep_rows(df: DataFrame, needed: list[str], make: Callable) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which the mask of their batch is true.

    ``make()`` runs once a task and returns a function from the needed columns, as lists, to a mask.
    """

    def run(batches):
        import pyarrow as pa

        mask = make()
        for batch in batches:
            yield batch.filter(pa.array(mask(*(batch.column(c).to_pylist() for c in needed)), pa.bool_()))

    let_workers_import(df.sparkSession)
    return df.mapInArrow(tidy(run), df.schema)


def bounded_sample(df: DataFrame, key: str, group: str, most: int) -> DataFrame:
    """At most ``most`` rows of each ``group`` value, chosen by the hash of ``key``.

    The first pass reads only ``group``. Rows are then thinned by hash to about
    1.5 * ``most`` a group before the exact cut, so that no task sees more.
    Groups are few (labels, languages). Repeated keys count once.
    """
    let_workers_import(df.sparkSession)
    sizes = {r[0]: r[1] for r in df.groupBy(group).count().collect() if r[0] is not None}
    if not sizes:
        return df.limit(0)
    pairs = [F.lit(x) for k, n in sizes.items() for x in (k, min(HASH_PARTS, int(HASH_PARTS * 1.5 * most / n) + 1))]
    part = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(HASH_PARTS))
    thinned = df.filter(part < F.create_map(*pairs)[F.col(group)]).dropDuplicates([key])
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.xxhash64(F.col(key), F.lit("sample")), F.col(key)))
    return thinned.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")
