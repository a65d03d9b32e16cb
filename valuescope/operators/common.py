"""Small plan helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a global (un-grouped) aggregate to every row.

    ``one_row`` must be an aggregate without grouping keys, which has exactly
    one row by construction; it is broadcast, so no shuffle of ``df`` occurs.
    """
    return df.join(F.broadcast(one_row), how="inner")


def require_single_key(df: DataFrame, key: str, name: str) -> None:
    """Raise when ``key`` is not unique in ``df`` (J5 cardinality check).

    Runs a distributed aggregate and fetches at most one offending key.
    """
    dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{name}: duplicate {key} values (e.g. {dup[0][key]})")
