"""Registry of named queries: a DataFrame builder plus (when SQL can state
it) an equivalent DuckDB oracle text.  ``__spark_entry__`` exposes these.

Every query reads the supplied tables at ``sf_dir`` in full.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str  # SURVEY inventory ids


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, covers: str):
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from valuescope.plans import (  # noqa: F401
        queries_churn,
        queries_clv,
        queries_cohorts,
        queries_core,
        queries_exact,
        queries_extra,
        queries_ingest,
        queries_ordered,
        queries_policy,
        queries_segments,
    )

    return REGISTRY
