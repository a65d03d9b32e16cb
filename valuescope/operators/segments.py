"""RFM scoring and segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.functions import money, money_sum, rfm_segment
from valuescope.operators.ordered import exact_quantiles, quantile_bins
from valuescope.schemas import require_columns

# Recency band labels, most recent first.
RECENCY_BANDS = ["very_recent", "recent", "mid", "old", "very_old"]


def quantile_scores(df: DataFrame, values: dict[str, str], descending=(), n: int = 4) -> DataFrame:
    """Equal-count scores 1..n (rank ties by customer_id); ``values`` maps new columns
    to values, and those in ``descending`` are flipped so that small values score high."""
    b = quantile_bins(df, values, n)
    return b.withColumns({out: (F.lit(n + 1) - F.col(out)).cast("int") for out in descending})


def rfm_scores(features: DataFrame) -> DataFrame:
    """R (recent = 4), F, M quartile scores from one pass, and their sum."""
    require_columns(features, ["customer_id", "recency_days", "n_invoices", "total_revenue"], "features")
    df = features.select("customer_id", "recency_days", "n_invoices", "total_revenue")
    df = quantile_scores(df, {"R": "recency_days", "F": "n_invoices", "M": "total_revenue"}, descending=["R"])
    return df.withColumn("rfm_score", (F.col("R") + F.col("F") + F.col("M")).cast("int"))


def build_segments(features: DataFrame, clv: DataFrame | None = None, churn: DataFrame | None = None) -> DataFrame:
    """G1: RFM + named segment, left-joined with CLV and churn scores."""
    seg = rfm_scores(features).withColumn("segment", rfm_segment("R", "F"))
    if clv is not None:
        seg = seg.join(
            clv.select("customer_id", F.col("clv_horizon").alias("clv_score"),
                       F.col("p_alive").alias("probability_alive")),
            "customer_id", "left",
        )
    else:
        seg = seg.withColumn("clv_score", F.lit(None).cast("double")).withColumn(
            "probability_alive", F.lit(None).cast("double"))
    if churn is not None:
        seg = seg.join(churn.select("customer_id", "churn_probability", "risk_band"), "customer_id", "left")
    else:
        seg = seg.withColumn("churn_probability", F.lit(None).cast("double")).withColumn(
            "risk_band", F.lit(None).cast("string"))
    return seg


def segment_summary(seg: DataFrame) -> DataFrame:
    """Per-segment counts, shares, means and median CLV (rounded half-even to 2)."""
    totals = seg.agg(F.count(F.lit(1)).alias("_all_n"), F.sum(money("total_revenue")).alias("_all_rev"))
    med = exact_quantiles(seg.filter(F.col("clv_score").isNotNull()), "clv_score", [0.5],
                          group="segment", prefix="_med")
    g = seg.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg("clv_score").alias("avg_clv"),
        F.avg("churn_probability").alias("avg_churn_prob"),
        F.avg("recency_days").alias("avg_recency_days"),
        F.avg("n_invoices").alias("avg_n_invoices"),
        F.sum(money("total_revenue")).alias("_rev"),
    )
    g = g.join(F.broadcast(totals), how="inner").join(med, "segment", "left")  # totals: 1 row
    r = lambda c: F.bround(c, 2)
    return g.select(
        "segment",
        F.col("n_customers").cast("bigint"),
        r(100.0 * F.col("n_customers") / F.col("_all_n")).alias("pct_customers"),
        r(F.col("avg_clv")).alias("avg_clv"),
        r(F.col("_med50")).alias("median_clv"),
        r(F.col("avg_churn_prob")).alias("avg_churn_prob"),
        r(F.col("avg_recency_days")).alias("avg_recency_days"),
        r(F.col("avg_n_invoices")).alias("avg_n_invoices"),
        r(F.col("_rev").cast("double") / F.col("n_customers")).alias("avg_revenue"),
        r(F.col("_rev").cast("double")).alias("total_revenue"),
        r(100.0 * F.col("_rev").cast("double") / F.col("_all_rev").cast("double")).alias("pct_revenue"),
    )


def clv_risk_points(seg: DataFrame) -> DataFrame:
    """One point per customer with both scores (churn probability by CLV, told by segment), with the overall median CLV."""
    med = exact_quantiles(seg, "clv_score", [0.5], prefix="_med")
    points = seg.filter(F.col("clv_score").isNotNull() & F.col("churn_probability").isNotNull())
    return points.join(F.broadcast(med), how="inner").select(  # med: 1 row
        "customer_id", "segment", "churn_probability", "clv_score", F.col("_med50").alias("median_clv"))


def recency_band_profile(features: DataFrame) -> DataFrame:
    """Five equal-count recency bands with average value metrics."""
    b = quantile_bins(features, {"_band": "recency_days"}, 5)
    g = b.groupBy("_band").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.sum(money("total_revenue")).alias("_rev"),
        F.count(F.lit(1)).alias("_n"),
        F.avg("n_invoices").alias("avg_n_invoices"),
        F.sum(money("revenue_last_30d")).alias("_r30"),
        F.sum(money("revenue_last_90d")).alias("_r90"),
    )
    return g.select(
        F.col("_band").alias("band"),
        F.element_at(F.array(*[F.lit(x) for x in RECENCY_BANDS]), F.col("_band")).alias("recency_band"),
        F.col("customers").cast("bigint"),
        F.round(F.col("_rev").cast("double") / F.col("_n"), 6).alias("avg_total_revenue"),
        F.round("avg_n_invoices", 6).alias("avg_n_invoices"),
        F.round(F.col("_r30").cast("double") / F.col("_n"), 6).alias("avg_rev_last_30d"),
        F.round(F.col("_r90").cast("double") / F.col("_n"), 6).alias("avg_rev_last_90d"),
    )


def value_risk_quadrants(scores: DataFrame) -> DataFrame:
    """Customers tagged high/lower value and risk by the 75th percentiles.

    Input: customer_id, clv_horizon, churn_probability.
    """
    q_clv = exact_quantiles(scores, "clv_horizon", [0.75], prefix="_cq")
    q_p = exact_quantiles(scores, "churn_probability", [0.75], prefix="_pq")
    j = scores.join(F.broadcast(q_clv), how="inner").join(F.broadcast(q_p), how="inner")  # 1-row each
    vs = F.when(F.col("clv_horizon") >= F.col("_cq75"), "high_value").otherwise("lower_value")
    rs = F.when(F.col("churn_probability") >= F.col("_pq75"), "high_risk").otherwise("lower_risk")
    return j.select(
        "customer_id", "clv_horizon", "churn_probability",
        vs.alias("value_segment"), rs.alias("risk_segment"),
        F.concat(vs, F.lit(" & "), rs).alias("priority_quadrant"),
    )


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Value counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def top_k(df: DataFrame, k: int, *order_desc: str) -> DataFrame:
    """K rows with the highest keys (descending; ties by customer_id)."""
    return df.orderBy(*[F.col(c).desc() for c in order_desc], F.col("customer_id").asc()).limit(k)


def segment_total(seg: DataFrame) -> DataFrame:
    return seg.agg(money_sum("total_revenue").alias("total_revenue"))
