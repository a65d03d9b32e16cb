"""Invoice events and customer features.

Customer features are ONE aggregate over line items (one shuffle on
customer_id with map-side partial aggregation, so a customer holding a
third of all rows is pre-combined in every map task before the shuffle).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.functions import days_between, money, money_sum, safe_ratio, ts_lit
from valuescope.schemas import require_columns

INVOICE_INPUT = ["customer_id", "invoice", "invoice_dt", "revenue"]


def invoice_amounts(txn: DataFrame) -> DataFrame:
    """Line items summed to (customer, invoice, timestamp), as far as ``invoices`` and ``customer_features`` tell them apart.

    The exact sums of both are the same from these rows, which are fewer and narrower.
    """
    require_columns(txn, INVOICE_INPUT, "transactions")
    return txn.groupBy("customer_id", "invoice", "invoice_dt").agg(F.sum(money("revenue")).alias("revenue"))


def invoices(txn: DataFrame) -> DataFrame:
    """A1: one event per (customer, invoice): first timestamp, exact revenue sum."""
    require_columns(txn, INVOICE_INPUT, "transactions")
    return txn.groupBy("customer_id", "invoice").agg(
        F.min("invoice_dt").alias("invoice_dt"),
        money_sum("revenue").alias("revenue"),
    )


def holdout_end(inv: DataFrame, cutoff: dt.datetime, holdout_days: int) -> DataFrame:
    """A10: min(cutoff + days, max timestamp) as a 1-row table (with validity flag)."""
    desired = cutoff + dt.timedelta(days=holdout_days)
    m = inv.agg(F.max("invoice_dt").alias("max_dt"))
    end = F.least(ts_lit(desired), F.col("max_dt"))
    return m.select(
        end.alias("holdout_end"),
        (end > ts_lit(cutoff)).alias("valid"),
        days_between(ts_lit(cutoff), end).cast("bigint").alias("holdout_days"),
    )


def resolve_holdout_end(inv: DataFrame, cutoff: dt.datetime, holdout_days: int) -> dt.datetime:
    """Driver value of A10 (one scalar); raises when the window would be empty."""
    row = holdout_end(inv, cutoff, holdout_days).first()
    if row is None or row["holdout_end"] is None or not row["valid"]:
        raise ValueError("Holdout end is not after cutoff; choose an earlier cutoff")
    return row["holdout_end"]


def customer_features(txn: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """RFM, tenure, trailing 30/90-day revenue and momentum per customer.

    Only rows strictly before the cutoff are used (F7).  Day counts are
    floored elapsed days (a purchase at 10:00 the day before a midnight
    cutoff has recency 0).  The 30-day window keeps whole-days <= 30 (F10).
    """
    require_columns(txn, INVOICE_INPUT, "transactions")
    c = ts_lit(cutoff)
    d = days_between("invoice_dt", c)
    cal = txn.filter(F.col("invoice_dt") < c).select(
        "customer_id", "invoice", "revenue", d.alias("d")
    )
    agg = cal.groupBy("customer_id").agg(
        F.min("d").alias("recency_days"),
        F.max("d").alias("tenure_days"),
        F.count_distinct("invoice").alias("n_invoices"),
        F.sum(money("revenue")).alias("_total"),
        F.sum(F.when(F.col("d") <= 30, money("revenue"))).alias("_r30"),
        F.sum(F.when(F.col("d") <= 90, money("revenue"))).alias("_r90"),
    )
    total = F.col("_total").cast("double")
    r30 = F.coalesce(F.col("_r30").cast("double"), F.lit(0.0))
    r90 = F.coalesce(F.col("_r90").cast("double"), F.lit(0.0))
    return agg.select(
        F.col("customer_id").cast("bigint"),
        F.col("recency_days").cast("bigint"),
        F.col("tenure_days").cast("bigint"),
        F.col("n_invoices").cast("bigint"),
        total.alias("total_revenue"),
        safe_ratio(total, F.col("n_invoices")).alias("avg_order_value"),
        r30.alias("revenue_last_30d"),
        r90.alias("revenue_last_90d"),
        safe_ratio(r30, r90).alias("rev_30_to_90_ratio"),
    )


def feature_contracts(features: DataFrame) -> DataFrame:
    """counts of contract violations in one aggregate (all must be 0)."""
    return features.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum((F.col("recency_days") < 0).cast("int")).cast("bigint").alias("negative_recency"),
        F.sum((F.col("n_invoices") <= 0).cast("int")).cast("bigint").alias("non_positive_invoices"),
        F.sum((F.col("total_revenue") < 0).cast("int")).cast("bigint").alias("negative_revenue"),
        F.sum((F.col("tenure_days") < F.col("recency_days")).cast("int")).cast("bigint")
        .alias("tenure_below_recency"),
    )


def assert_feature_contracts(features: DataFrame) -> None:
    row = feature_contracts(features).first()
    bad = {k: v for k, v in row.asDict().items() if k != "rows" and v}
    if bad:
        raise ValueError(f"feature contract violated: {bad}")


def feature_profile(features: DataFrame) -> DataFrame:
    """One-row profile of the feature table."""
    return features.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_distinct("customer_id").cast("bigint").alias("unique_customers"),
        F.round(F.avg("recency_days"), 6).alias("avg_recency_days"),
        F.round(F.avg("n_invoices"), 6).alias("avg_n_invoices"),
        F.round(F.sum(money("total_revenue")).cast("double") / F.count(F.lit(1)), 6).alias(
            "avg_total_revenue"
        ),
        F.round(F.avg((F.col("revenue_last_30d") == 0).cast("double")), 6).alias(
            "pct_zero_revenue_last_30d"
        ),
    )
