"""Acquisition cohorts.

Line items are read once: they collapse to one row per (customer, purchase
month) -- an aggregate with map-side combine, so a customer holding a third of
all rows becomes a few dozen rows before any shuffle. The cohort month is the
least month of the customer's rows, taken by a window over those; every later
table is an aggregate of them, without joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuescope.functions import money


def _months(txn: DataFrame, *aggs) -> DataFrame:
    """One row per (customer, purchase month) with the customer's first month and ``aggs`` of the month's lines."""
    month = F.trunc(F.col("invoice_dt").cast("date"), "month").alias("purchase_month")
    known = txn.filter(F.col("customer_id").isNotNull())
    by = known.groupBy("customer_id", month)
    pairs = by.agg(*aggs) if aggs else known.select("customer_id", month).distinct()
    return pairs.withColumn("cohort_month", F.min("purchase_month").over(Window.partitionBy("customer_id")))


def cohort_frame(txn: DataFrame, calendar: bool = False) -> DataFrame:
    """(customer_id, purchase_month, cohort_month, months_since_acquisition).

    Default months = floor(days between month starts / 30) (Jan->Mar is 1);
    ``calendar=True`` uses true calendar months instead.
    """
    if calendar:
        m = F.months_between("purchase_month", "cohort_month").cast("int")
    else:
        m = F.floor(F.datediff("purchase_month", "cohort_month") / 30).cast("int")
    return _months(txn).withColumn("months_since_acquisition", m)


def retention_matrix(txn: DataFrame, max_months: int = 12, min_cohort_size: int = 10,
                     calendar: bool = False) -> DataFrame:
    """Percent of each cohort active k months after acquisition, pivoted
    to columns m0..m{max_months} (fixed domain; missing -> NULL).

    Every customer is active in the month of acquisition, so a cohort's size is
    its count at k = 0 and needs no table of its own (J10, F15).
    """
    active = (
        cohort_frame(txn, calendar)
        .filter(F.col("cohort_month").isNotNull())
        .groupBy("cohort_month", "months_since_acquisition")
        .agg(F.count_distinct("customer_id").alias("active"))
    )
    piv = (
        active.groupBy("cohort_month")
        .pivot("months_since_acquisition", list(range(max_months + 1)))
        .agg(F.first("active"))
        .filter(F.col("0") >= min_cohort_size)
    )
    pct = [F.bround(F.col(str(k)) / F.col("0") * 100.0, 1).alias(f"m{k}") for k in range(max_months + 1)]
    return piv.select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"), *pct)


def cohort_revenue(txn: DataFrame, min_cohort_size: int = 10) -> DataFrame:
    """Revenue, customers, line count and revenue per customer by cohort."""
    months = _months(txn, F.sum(money("revenue")).alias("_rev"), F.count("invoice_dt").alias("_lines"))
    g = (
        months.filter(F.col("cohort_month").isNotNull())
        .groupBy("cohort_month")
        .agg(
            F.sum("_rev").alias("_rev"),
            # each customer has one row of its first month
            F.count_if(F.col("purchase_month") == F.col("cohort_month")).alias("n_customers"),
            F.sum("_lines").alias("n_transactions"),
        )
        .filter(F.col("n_customers") >= min_cohort_size)
    )
    return g.select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"),
        F.col("_rev").cast("double").alias("total_revenue"),
        F.col("n_customers").cast("bigint"),
        F.col("n_transactions").cast("bigint"),
        F.bround(F.col("_rev").cast("double") / F.col("n_customers"), 2).alias("avg_revenue_per_customer"),
    )


def retention_curves(matrix: DataFrame, last_month: int = 9, min_points: int = 3) -> DataFrame:
    """G4 + F16: long (cohort_month, month, retention_pct) for months <= last_month,
    only cohorts with at least ``min_points`` non-NULL values there."""
    cols = [f"m{k}" for k in range(last_month + 1)]
    kept = matrix.na.drop(thresh=min_points, subset=cols)
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("month"), F.col(c).alias("retention_pct"))
                                  for k, c in enumerate(cols)]))
    return (
        kept.select("cohort_month", stacked.alias("p"))
        .select("cohort_month", "p.month", "p.retention_pct")
        .filter(F.col("retention_pct").isNotNull())
    )


def latest_cohorts(matrix: DataFrame, k: int = 15) -> DataFrame:
    """The k most recent cohorts (tail of the ordered matrix)."""
    return matrix.orderBy(F.col("cohort_month").desc()).limit(k)
