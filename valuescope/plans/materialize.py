"""Lineage cuts for reused intermediate tables.

Customer- and invoice-level tables are read by several ordered passes
(each distributed rank runs a sampling pass and a final pass).  Writing
them once with ``checkpoint`` (into the shared ``spark.checkpoint.dir``)
means later passes read the materialised rows instead of recomputing the
upstream plan, and a lost executor is recovered from those files rather
than from the whole lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from valuescope.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
