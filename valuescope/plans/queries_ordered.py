"""Phase 2-3 queries: distributed ranks, RFM, concentration, trends, distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuescope.functions import money
from valuescope.operators import concentration as C
from valuescope.operators import features as FE
from valuescope.operators import segments as SG
from valuescope.operators.ordered import global_order, qbin
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.plans.materialize import materialize
from valuescope.plans.queries_core import txn_orders
from valuescope.sources import dirty_transactions

P = TESTDATA_PARAMS
FEAT = S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff))


def feats(spark, sf_dir):
    return materialize(FE.customer_features(txn_orders(spark, sf_dir), P.cutoff))


# ---------------------------------------------------------------- W1, W2, W6
@register(
    "customer_revenue_rank",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff), S.LORENZ.split("),\nlz AS")[0] + ")")
    + f"""SELECT customer_id, total_revenue, CAST(rn AS BIGINT) AS rn,
  CAST(cum_dec AS DOUBLE) AS cum_revenue, {S.qbin('rn', 'n', 10)} AS decile
FROM lz0""",
    "W1 W2 W6",
)
def q_customer_revenue_rank(spark, sf_dir):
    f = feats(spark, sf_dir).select("customer_id", "total_revenue")
    o = global_order(f, "total_revenue", sums={"cum_revenue": money("total_revenue")})
    return o.select("customer_id", "total_revenue", "rn",
                    F.col("cum_revenue").cast("double").alias("cum_revenue"),
                    qbin("rn", "n", 10).alias("decile"))


# ---------------------------------------------------------------- W3, W4, P13
@register(
    "rfm_segments",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff), S.RFM)
    + "SELECT customer_id, recency_days, n_invoices, total_revenue, R, F, M, rfm_score, segment FROM rfm",
    "W3 W4 P13",
)
def q_rfm_segments(spark, sf_dir):
    return SG.rfm_scores(feats(spark, sf_dir)).withColumn("segment", SG.rfm_segment("R", "F"))


@register(
    "segment_counts",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff), S.RFM)
    + "SELECT segment, CAST(count(*) AS BIGINT) AS count FROM rfm GROUP BY segment",
    "A23",
)
def q_segment_counts(spark, sf_dir):
    seg = SG.rfm_scores(feats(spark, sf_dir)).withColumn("segment", SG.rfm_segment("R", "F"))
    return SG.category_counts(seg, "segment")


@register(
    "recency_bands",
    FEAT[:-1] + f""",
rb AS (
  SELECT *, {S.qbin('row_number() OVER (ORDER BY recency_days, customer_id)', 'count(*) OVER ()', 5)} AS band
  FROM features
)
SELECT band, (['very_recent', 'recent', 'mid', 'old', 'very_old'])[band] AS recency_band,
  CAST(count(DISTINCT customer_id) AS BIGINT) AS customers,
  round(CAST(sum({S.money('total_revenue')}) AS DOUBLE) / count(*), 6) AS avg_total_revenue,
  round(avg(n_invoices), 6) AS avg_n_invoices,
  round(CAST(sum({S.money('revenue_last_30d')}) AS DOUBLE) / count(*), 6) AS avg_rev_last_30d,
  round(CAST(sum({S.money('revenue_last_90d')}) AS DOUBLE) / count(*), 6) AS avg_rev_last_90d
FROM rb GROUP BY band""",
    "A32 W2",
)
def q_recency_bands(spark, sf_dir):
    return SG.recency_band_profile(feats(spark, sf_dir))


# ---------------------------------------------------------------- W7-W12, G5
_PARETO_ROWS = ",\n".join(
    f"  ({i}, '{m}', '{t}')" for i, (m, t) in enumerate(C.PARETO_METRICS)
)


@register(
    "pareto_summary",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff), S.LORENZ)
    + f""", one AS (
  SELECT max(n) AS n, CAST(max(s_dec) AS DOUBLE) AS S,
    min(CASE WHEN cum_revenue_pct >= 80.0 THEN rn END) AS rn80,
    max(CASE WHEN rn = floor(n * 0.9) + 1 THEN cum_revenue_pct END) AS y90,
    max(CASE WHEN rn = 1 THEN total_revenue END) AS r1,
    CAST(sum({S.money('total_revenue')} * (n - rn + 1)) AS DOUBLE) AS sum_wr
  FROM lz
),
vals AS (
  SELECT round_even(rn80 / n * 100.0, 1) AS v0, round_even(100.0 - y90, 1) AS v1,
    round_even(1.0 - 2.0 * (((sum_wr / S) - ((r1 / S) + 1.0) / 2.0) / n), 4) AS v2,
    CAST(n AS DOUBLE) AS v3, round_even(S, 2) AS v4, round_even(100.0 - rn80 / n * 100.0, 1) AS v5
  FROM one
),
m(i, metric, interpretation) AS (VALUES
{_PARETO_ROWS})
SELECT metric, CAST(CASE i WHEN 0 THEN v0 WHEN 1 THEN v1 WHEN 2 THEN v2 WHEN 3 THEN v3 WHEN 4 THEN v4 ELSE v5 END AS DOUBLE) AS value,
  interpretation
FROM m, vals""",
    "W7 W8 W9 W10 W11 G5",
)
def q_pareto_summary(spark, sf_dir):
    return C.pareto_summary(feats(spark, sf_dir))


@register(
    "revenue_bands",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff), S.LORENZ)
    + """, one AS (
  SELECT max(CASE WHEN rn = floor(n * 0.5) + 1 THEN cum_revenue_pct END) AS y50,
         max(CASE WHEN rn = floor(n * 0.8) + 1 THEN cum_revenue_pct END) AS y80,
         max(CASE WHEN rn = floor(n * 0.9) + 1 THEN cum_revenue_pct END) AS y90
  FROM lz
)
SELECT 1 AS band_order, 'Bottom 50%' AS band, round(y50, 6) AS revenue_share_pct FROM one
UNION ALL SELECT 2, '50-80%', round(y80 - y50, 6) FROM one
UNION ALL SELECT 3, '80-90%', round(y90 - y80, 6) FROM one
UNION ALL SELECT 4, 'Top 10%', round(100.0 - y90, 6) FROM one""",
    "W12",
)
def q_revenue_bands(spark, sf_dir):
    return C.revenue_bands(feats(spark, sf_dir))


# ---------------------------------------------------------------- A21, W13, A20
@register(
    "monthly_revenue",
    S.with_(S.txn_cte("orders"))
    + f""", m AS (
  SELECT CAST(date_trunc('month', invoice_dt) AS DATE) AS month,
    CAST(sum({S.money('revenue')}) AS DOUBLE) AS revenue,
    CAST(count(DISTINCT customer_id) AS BIGINT) AS active_customers
  FROM txn GROUP BY 1
)
SELECT month, strftime(month, '%Y-%m') AS month_label, revenue, active_customers,
  round(avg(revenue) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS revenue_3m_ma
FROM m""",
    "A21 W13 P10",
)
def q_monthly_revenue(spark, sf_dir):
    return C.monthly_revenue(txn_orders(spark, sf_dir))


@register(
    "rows_per_day",
    S.with_(S.DIRTY)
    + "SELECT CAST(invoice_dt AS DATE) AS date, CAST(count(*) AS BIGINT) AS rows FROM raw "
    "WHERE invoice_dt IS NOT NULL GROUP BY 1",
    "A20",
)
def q_rows_per_day(spark, sf_dir):
    return C.rows_per_day(dirty_transactions(spark, sf_dir, descriptive=False))


# ---------------------------------------------------------------- A18, A22, P16, A17, A19
@register(
    "value_distribution",
    FEAT[:-1] + f""",
rv AS (SELECT CASE WHEN total_revenue < 1.0 THEN 1.0 ELSE total_revenue END AS rev FROM features)
SELECT CAST(count(*) AS BIGINT) AS n,
  round(CAST(sum({S.money('rev')}) AS DOUBLE) / count(*), 6) AS mean,
  round(quantile_cont(rev, 0.5), 6) AS median, round(quantile_cont(rev, 0.9), 6) AS p90,
  round(quantile_cont(rev, 0.99), 6) AS p99,
  round(avg(CASE WHEN rev > 1000 THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS pct_gt_1000
FROM rv""",
    "A18",
)
def q_value_distribution(spark, sf_dir):
    return C.value_distribution(feats(spark, sf_dir))


def _hist_sql(expr: str, bins: int) -> str:
    return FEAT[:-1] + f""",
x AS (SELECT {expr} AS x FROM features),
mm AS (SELECT min(x) AS mn, max(x) AS mx FROM x),
b AS (
  SELECT CAST(CASE WHEN mx - mn = 0 THEN 0 ELSE least(floor((x - mn) * {bins} / (mx - mn)), {bins - 1}) END AS INTEGER) AS bin
  FROM x, mm
),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin)
SELECT CAST(r.bin AS INTEGER) AS bin, round(mn + (mx - mn) * r.bin / {bins}, 6) AS lower,
  round(mn + (mx - mn) * (r.bin + 1) / {bins}, 6) AS upper, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM range({bins}) r(bin) CROSS JOIN mm LEFT JOIN c ON c.bin = r.bin"""


@register(
    "revenue_histogram_log10",
    _hist_sql("log10(CASE WHEN total_revenue < 1.0 THEN 1.0 ELSE total_revenue END)", 50),
    "A22 P16",
)
def q_revenue_histogram_log10(spark, sf_dir):
    return C.histogram(feats(spark, sf_dir), "total_revenue", 50, log10=True, lower_clip=1.0)


@register(
    "revenue_histogram_p99",
    _hist_sql("least(total_revenue, (SELECT quantile_cont(total_revenue, 0.99) FROM features))", 60),
    "A22",
)
def q_revenue_histogram_p99(spark, sf_dir):
    return C.histogram(feats(spark, sf_dir), "total_revenue", 60, upper_quantile=0.99)


@register("recency_histogram", _hist_sql("CAST(recency_days AS DOUBLE)", 30), "A22")
def q_recency_histogram(spark, sf_dir):
    return C.histogram(feats(spark, sf_dir), "recency_days", 30)


@register(
    "invoice_value_describe",
    S.with_(S.DIRTY)
    + f""", iv AS (
  SELECT customer_id, invoice, {S.money_sum('CAST(quantity AS DOUBLE) * unit_price')} AS v
  FROM raw WHERE customer_id IS NOT NULL AND invoice_dt IS NOT NULL AND unit_price IS NOT NULL
  GROUP BY customer_id, invoice
)
SELECT CAST(count(*) AS BIGINT) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  round(min(v), 6) AS min, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90,
  round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99, round(max(v), 6) AS max
FROM iv""",
    "A17 A19",
)
def q_invoice_value_describe(spark, sf_dir):
    raw = dirty_transactions(spark, sf_dir, descriptive=False)
    iv = (
        raw.filter(F.col("customer_id").isNotNull() & F.col("invoice_dt").isNotNull()
                   & F.col("unit_price").isNotNull())
        .groupBy("customer_id", "invoice")
        .agg(F.sum(money(F.col("quantity").cast("double") * F.col("unit_price"))).cast("double").alias("v"))
    )
    return C.describe(iv, "v", (0.5, 0.9, 0.95, 0.99))
