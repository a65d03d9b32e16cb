"""Revenue concentration, monthly trend and value distribution
(W7-W13, A18, A20-A22, P16, G5).

All prefix quantities come from one distributed ordered pass
(``global_order``); the money prefix sums are exact DECIMAL sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuescope.functions import clamp, money
from valuescope.operators.ordered import exact_quantiles, global_order

# Metric names and their interpretation texts.
PARETO_METRICS = [
    ("pct_customers_for_80pct_revenue", "% of customers who generate 80% of total revenue"),
    ("pct_revenue_top_10pct_customers", "% of revenue generated by the top 10% of customers"),
    ("gini_coefficient", "Revenue inequality (0=equal, 1=fully concentrated)"),
    ("n_customers", "Total unique customers analyzed"),
    ("total_revenue_gbp", "Total revenue across all customers"),
    ("pct_top_customers_for_80pct_revenue", "% of customers, counted from the top, holding 80% of revenue"),
]


def lorenz(features: DataFrame) -> DataFrame:
    """Customers in ascending revenue order with cumulative shares (percent)."""
    o = global_order(
        features.select("customer_id", "total_revenue"), "total_revenue",
        sums={"cum_revenue": money("total_revenue")},
    )
    tot = features.agg(F.sum(money("total_revenue")).alias("_S"))
    o = o.join(F.broadcast(tot), how="inner")  # 1-row total
    return o.select(
        "customer_id", "total_revenue", "rn", "n",
        (F.col("cum_revenue").cast("double") / F.col("_S").cast("double") * 100.0).alias("cum_revenue_pct"),
        (F.col("rn") / F.col("n") * 100.0).alias("cum_customer_pct"),
        "_S",
    )


def pareto_summary(features: DataFrame) -> DataFrame:
    """Concentration metrics as (metric, value, interpretation) rows.

    Gini follows the trapezoid rule over the Lorenz points (x starting at
    1/n); with shares y_j it equals 1 - 2 * (sum(y) - (y_1 + 1)/2) / n, and
    sum(y) = sum_j (n - j + 1) r_j / S needs only each row's rank.
    """
    lz = lorenz(features)
    n = F.first("n")
    s = F.first("_S").cast("double")
    one = lz.agg(
        n.alias("n"),
        s.alias("S"),
        F.min(F.when(F.col("cum_revenue_pct") >= 80.0, F.col("rn"))).alias("rn80"),
        F.max(F.when(F.col("rn") == F.floor(F.col("n") * 0.9) + 1, F.col("cum_revenue_pct"))).alias("y90"),
        F.max(F.when(F.col("rn") == 1, F.col("total_revenue"))).alias("r1"),
        F.sum(F.col("total_revenue").cast("decimal(24,10)") * (F.col("n") - F.col("rn") + 1).cast("decimal(13,0)")).cast("double").alias("sum_wr"),
    )
    pct80 = F.col("rn80") / F.col("n") * 100.0
    sum_y = F.col("sum_wr") / F.col("S")
    y1 = F.col("r1") / F.col("S")
    gini = 1.0 - 2.0 * ((sum_y - (y1 + 1.0) / 2.0) / F.col("n"))
    vals = {
        "pct_customers_for_80pct_revenue": F.bround(pct80, 1),
        "pct_revenue_top_10pct_customers": F.bround(100.0 - F.col("y90"), 1),
        "gini_coefficient": F.bround(gini, 4),
        "n_customers": F.col("n").cast("double"),
        "total_revenue_gbp": F.bround(F.col("S"), 2),
        "pct_top_customers_for_80pct_revenue": F.bround(100.0 - pct80, 1),
    }
    rows = [F.struct(F.lit(m).alias("metric"), vals[m].cast("double").alias("value"),
                     F.lit(txt).alias("interpretation")) for m, txt in PARETO_METRICS]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def revenue_bands(features: DataFrame) -> DataFrame:
    """Revenue share of the bottom 50%, 50-80%, 80-90% and top 10% of customers."""
    lz = lorenz(features)
    at = lambda f: F.max(F.when(F.col("rn") == F.floor(F.col("n") * f) + 1, F.col("cum_revenue_pct")))  # noqa
    one = lz.agg(at(0.5).alias("y50"), at(0.8).alias("y80"), at(0.9).alias("y90"))
    bands = [
        ("Bottom 50%", 1, F.col("y50")),
        ("50-80%", 2, F.col("y80") - F.col("y50")),
        ("80-90%", 3, F.col("y90") - F.col("y80")),
        ("Top 10%", 4, 100.0 - F.col("y90")),
    ]
    rows = [F.struct(F.lit(i).alias("band_order"), F.lit(b).alias("band"),
                     F.round(v, 6).alias("revenue_share_pct")) for b, i, v in bands]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def monthly_revenue(txn: DataFrame) -> DataFrame:
    """A21 + W13: revenue and active customers per calendar month, 3-month moving average.

    The month table is bounded by the calendar, so the moving-average
    window runs on a few hundred rows.
    """
    m = txn.groupBy(F.trunc(F.col("invoice_dt").cast("date"), "month").alias("month")).agg(
        F.sum(money("revenue")).alias("_rev"),
        F.count_distinct("customer_id").alias("active_customers"),
    )
    w = Window.orderBy("month").rowsBetween(-2, 0)
    return m.select(
        "month",
        F.date_format("month", "yyyy-MM").alias("month_label"),
        F.col("_rev").cast("double").alias("revenue"),
        F.col("active_customers").cast("bigint"),
        F.round(F.avg(F.col("_rev").cast("double")).over(w), 6).alias("revenue_3m_ma"),
    )


def rows_per_day(txn: DataFrame) -> DataFrame:
    """A20."""
    return (
        txn.filter(F.col("invoice_dt").isNotNull())
        .groupBy(F.col("invoice_dt").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    )


def value_distribution(features: DataFrame) -> DataFrame:
    """Mean, median, p90, p99 and share above 1000 of revenue clipped at 1."""
    rev = features.select("customer_id", clamp("total_revenue", lower=1.0).alias("rev"))
    q = exact_quantiles(rev, "rev", [0.5, 0.9, 0.99], prefix="p")
    agg = rev.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        (F.sum(money("rev")).cast("double") / F.count(F.lit(1))).alias("mean"),
        F.avg((F.col("rev") > 1000).cast("double")).alias("share_gt_1000"),
    )
    j = agg.join(F.broadcast(q), how="inner")  # both 1 row
    return j.select(
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("p50", 6).alias("median"),
        F.round("p90", 6).alias("p90"),
        F.round("p99", 6).alias("p99"),
        F.round(F.col("share_gt_1000") * 100.0, 6).alias("pct_gt_1000"),
    )


def histogram(df: DataFrame, col: str, bins: int, log10: bool = False,
              lower_clip: float | None = None, upper_quantile: float | None = None) -> DataFrame:
    """Equal-width histogram between min and max; last bin right-closed.

    Options: clip below (``lower_clip``), clip above at an exact quantile,
    or bin ``log10`` of the value (P16).
    """
    x = F.col(col).cast("double")
    if lower_clip is not None:
        x = clamp(x, lower=lower_clip)
    v = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    if upper_quantile is not None:
        q = exact_quantiles(v, "_x", [upper_quantile], prefix="_u")
        qn = q.columns[0]
        v = v.join(F.broadcast(q), how="inner").select(
            F.when(F.col("_x") > F.col(qn), F.col(qn)).otherwise(F.col("_x")).alias("_x"))
    if log10:
        v = v.select(F.log10("_x").alias("_x"))
    mm = v.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    j = v.join(F.broadcast(mm), how="inner")  # 1-row bounds
    width = F.col("_mx") - F.col("_mn")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_mn")) * bins / width), F.lit(bins - 1))).cast("int")
    counts = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    all_bins = v.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = all_bins.join(counts, "bin", "left").join(F.broadcast(mm), how="inner")
    return out.select(
        "bin",
        F.round(F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("bin") / bins, 6).alias("lower"),
        F.round(F.col("_mn") + (F.col("_mx") - F.col("_mn")) * (F.col("bin") + 1) / bins, 6).alias("upper"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def describe(df: DataFrame, col: str, percentiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample std, min, exact percentiles, max (one row)."""
    v = df.select(F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    q = exact_quantiles(v, "_v", list(percentiles), prefix="p")
    a = v.agg(
        F.count(F.lit(1)).cast("bigint").alias("count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    j = a.join(F.broadcast(q), how="inner")
    pcols = [c for c in q.columns]
    return j.select(
        "count",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        F.round("min", 6).alias("min"),
        *[F.round(c, 6).alias(c) for c in pcols],
        F.round("max", 6).alias("max"),
    )
