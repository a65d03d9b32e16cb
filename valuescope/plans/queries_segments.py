"""RFM segments joined with CLV and churn risk, and the segment summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuescope.operators import segments as SG
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.plans.materialize import materialize
from valuescope.plans.queries_clv import dbl, fixed_scores
from valuescope.plans.queries_ordered import feats
from valuescope.plans.queries_policy import INPUTS

P = TESTDATA_PARAMS


def scored_segments(spark, sf_dir):
    s = fixed_scores(spark, sf_dir)
    clv = s.select("customer_id", F.round("clv_horizon", 6).alias("clv_horizon"), F.round("p_alive", 9).alias("p_alive"))
    p = F.round(1.0 - F.col("p_alive"), 9)
    from valuescope.functions import risk_band

    churn = s.select("customer_id", p.alias("churn_probability"), risk_band(p).alias("risk_band"))
    return SG.build_segments(feats(spark, sf_dir), clv, churn)


SEG_SQL = INPUTS[:-1] + ",\n" + ",\n".join([S.features_cte(P.cutoff), S.RFM]) + """,
seg AS (
  SELECT r.*, c.clv_score, c.probability_alive, i.churn_probability, i.risk_band
  FROM rfm r
  LEFT JOIN (SELECT customer_id, round(clv_horizon, 6) AS clv_score, round(p_alive, 9) AS probability_alive FROM clv2) c
    ON r.customer_id = c.customer_id
  LEFT JOIN inputs i ON r.customer_id = i.customer_id
)
"""


@register(
    "customer_segments",
    SEG_SQL + """SELECT customer_id, recency_days, n_invoices, total_revenue, R, F, M, rfm_score, segment, clv_score,
  probability_alive, churn_probability, risk_band FROM seg""",
    "G1 J7 W4 P13",
)
def q_customer_segments(spark, sf_dir):
    return scored_segments(spark, sf_dir)


@register(
    "segment_summary",
    SEG_SQL + f""", tot AS (SELECT count(*) AS n_all, CAST(sum({S.money('total_revenue')}) AS DOUBLE) AS rev_all FROM seg)
SELECT segment, CAST(count(*) AS BIGINT) AS n_customers,
  round_even({dbl(100.0)} * count(*) / max(tot.n_all), 2) AS pct_customers,
  round_even(avg(clv_score), 2) AS avg_clv, round_even(quantile_cont(clv_score, 0.5), 2) AS median_clv,
  round_even(avg(churn_probability), 2) AS avg_churn_prob, round_even(avg(recency_days), 2) AS avg_recency_days,
  round_even(avg(n_invoices), 2) AS avg_n_invoices,
  round_even(CAST(sum({S.money('total_revenue')}) AS DOUBLE) / count(*), 2) AS avg_revenue,
  round_even(CAST(sum({S.money('total_revenue')}) AS DOUBLE), 2) AS total_revenue,
  round_even({dbl(100.0)} * CAST(sum({S.money('total_revenue')}) AS DOUBLE) / max(tot.rev_all), 2) AS pct_revenue
FROM seg CROSS JOIN tot GROUP BY segment""",
    "A24 G2",
)
def q_segment_summary(spark, sf_dir):
    return SG.segment_summary(materialize(scored_segments(spark, sf_dir)))  # medians and sums read it


@register(
    "segment_points",
    SEG_SQL + """SELECT customer_id, segment, churn_probability, clv_score,
  round((SELECT quantile_cont(clv_score, 0.5) FROM seg), 6) AS median_clv
FROM seg WHERE clv_score IS NOT NULL AND churn_probability IS NOT NULL""",
    "G2",
)
def q_segment_points(spark, sf_dir):
    return SG.clv_risk_points(materialize(scored_segments(spark, sf_dir))).withColumn("median_clv", F.round("median_clv", 6))
