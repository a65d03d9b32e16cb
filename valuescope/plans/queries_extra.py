"""Remaining inventory entries: executive summary, ordered writes and picks,
seeded samples, min-max scaling, tree importance, the whole batch run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from valuescope.operators import churn as CH
from valuescope.operators import metrics as ME
from valuescope.operators.sampling import bottom_k
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.plans.queries_churn import snapshot
from valuescope.plans.queries_clv import _EVAL, eval_frame, fixed_scores
from valuescope.plans.queries_ordered import FEAT, feats
from valuescope.plans.queries_segments import SEG_SQL, scored_segments
from valuescope.plans.queries_policy import _SCEN_T, _BUD_T, _scenario_sql, _sens_inputs
from valuescope.operators import scenarios as SC
from valuescope.session import checkpoint_dir

P = TESTDATA_PARAMS


@register(
    "executive_summary",
    _EVAL + f""", rx AS (SELECT customer_id, s, y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r1 FROM ev),
ry AS (SELECT customer_id, r1, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS r2 FROM rx),
sp AS (SELECT round(CASE WHEN (SELECT count(DISTINCT s) FROM ev) > 1 AND (SELECT count(DISTINCT y) FROM ev) > 1
                    THEN corr(r1, r2) END, 4) AS sp FROM ry)
SELECT DATE '{P.cutoff.date().isoformat()}' AS cutoff_date, CAST({P.holdout_days} AS BIGINT) AS holdout_days,
  sp.sp AS spearman_clv_vs_holdout_revenue, (SELECT CAST(count(*) AS BIGINT) FROM clv2) AS customers_scored_clv,
  (SELECT CAST(count(*) AS BIGINT) FROM clv2 WHERE p_alive IS NOT NULL) AS customers_scored_risk,
  CAST('{float(P.unit_cost)!r}' AS DOUBLE) AS unit_cost_assumed,
  CAST('{float(P.retention_effectiveness)!r}' AS DOUBLE) AS retention_effectiveness_assumed
FROM sp""",
    "A30 C9",
)
def q_executive_summary(spark, sf_dir):
    ev = eval_frame(spark, sf_dir)
    scores = fixed_scores(spark, sf_dir)
    sp = ME.spearman(ev, "clv_horizon", "holdout_revenue")
    n = scores.agg(F.count(F.lit(1)).cast("bigint").alias("customers_scored_clv"),
                   F.count("p_alive").cast("bigint").alias("customers_scored_risk"))
    return sp.join(n, how="inner").select(  # both one row
        F.lit(P.cutoff.date()).alias("cutoff_date"), F.lit(P.holdout_days).cast("bigint").alias("holdout_days"),
        F.round("spearman", 4).alias("spearman_clv_vs_holdout_revenue"), "customers_scored_clv",
        "customers_scored_risk", F.lit(float(P.unit_cost)).alias("unit_cost_assumed"),
        F.lit(float(P.retention_effectiveness)).alias("retention_effectiveness_assumed"))


@register(
    "transactions_sorted",
    S.with_(S.txn_cte("orders")) + f"SELECT {S.TXN_COLS}, revenue FROM txn ORDER BY customer_id, invoice_dt, invoice",
    "O1",
)
def q_transactions_sorted(spark, sf_dir):
    # global sort = range-partitioned shuffle (sampled bounds), not a single task
    from valuescope.operators.cleaning import clean_transactions
    from valuescope.sources import transactions_from_orders

    full = clean_transactions(transactions_from_orders(spark, sf_dir, descriptive=True))
    return full.orderBy("customer_id", "invoice_dt", "invoice")


@register(
    "transactions_written",
    S.with_(S.txn_cte("orders")) + "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS violations FROM txn",
    "O1 S5 (the clean table's files, read back, are in order)",
)
def q_transactions_written(spark, sf_dir):
    from valuescope.operators.cleaning import clean_transactions
    from valuescope.sources import order_violations, transactions_from_orders, write_ordered

    keys = ["customer_id", "invoice_dt", "invoice"]
    path = f"{checkpoint_dir(spark).rstrip('/')}/transactions-{uuid.uuid4().hex}"
    write_ordered(clean_transactions(transactions_from_orders(spark, sf_dir, descriptive=False)), path, keys, max_file_rows=5000)
    return order_violations(spark, path, keys).select("rows", "violations")


@register(
    "tornado_top_driver",
    _scenario_sql(_SCEN_T, _BUD_T) + """, rr AS (SELECT scenario_id, roi FROM roi),
sw AS (
  SELECT 'retention_effectiveness' AS parameter,
    round(abs((SELECT roi FROM rr WHERE scenario_id = 2) - (SELECT roi FROM rr WHERE scenario_id = 1)), 6) AS roi_swing
  UNION ALL
  SELECT 'unit_cost', round(abs((SELECT roi FROM rr WHERE scenario_id = 4) - (SELECT roi FROM rr WHERE scenario_id = 3)), 6)
)
SELECT parameter, roi_swing FROM sw ORDER BY roi_swing DESC, parameter LIMIT 1""",
    "O3",
)
def q_tornado_top_driver(spark, sf_dir):
    base, _ = _sens_inputs(spark, sf_dir)
    t = SC.tornado(base, P.reference_budget, P.retention_effectiveness, P.unit_cost, P.variation)
    return t.orderBy(F.col("roi_swing").desc(), F.col("parameter")).limit(1).select("parameter", "roi_swing")


_MD5 = "CAST(('0x' || substr(md5(concat_ws('|', {seed}, customer_id)), 1, 8)) AS BIGINT) / CAST('4294967296.0' AS DOUBLE)"


@register(
    "sample_customers",
    FEAT + f"SELECT customer_id, total_revenue FROM features ORDER BY {_MD5.format(seed=P.seed)}, customer_id LIMIT 10",
    "O6",
)
def q_sample_customers(spark, sf_dir):
    """Seeded sample of 10 customers without replacement (md5 order), portable across engines."""
    return bottom_k(feats(spark, sf_dir).select("customer_id", "total_revenue"), 10, P.seed)


@register(
    "sample_by_segment",
    SEG_SQL + f"""SELECT customer_id, segment, total_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY {_MD5.format(seed=P.seed)}, customer_id) AS k FROM seg) t WHERE k <= 5""",
    "O6",
)
def q_sample_by_segment(spark, sf_dir):
    """Five customers of each segment."""
    rows = scored_segments(spark, sf_dir).select("customer_id", "segment", "total_revenue")
    return bottom_k(rows, 5, P.seed, strata=["segment"])


_MM = ["recency_days", "n_invoices", "total_revenue"]


@register(
    "feature_minmax",
    FEAT[:-1] + ", mm AS (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in _MM)
    + " FROM features)\nSELECT customer_id, " + ", ".join(
        f"round((CAST({c} AS DOUBLE) - mn_{c}) / (mx_{c} - mn_{c} + CAST('1e-09' AS DOUBLE)), 9) AS {c}_scaled"
        for c in _MM) + " FROM features CROSS JOIN mm",
    "P20",
)
def q_feature_minmax(spark, sf_dir):
    f = feats(spark, sf_dir)
    mm = f.agg(*[F.min(c).alias(f"mn_{c}") for c in _MM], *[F.max(c).alias(f"mx_{c}") for c in _MM])
    j = f.join(F.broadcast(mm), how="inner")  # one row of bounds
    return j.select("customer_id", *[
        F.round((F.col(c).cast("double") - F.col(f"mn_{c}")) / (F.col(f"mx_{c}") - F.col(f"mn_{c}") + F.lit(1e-9)), 9)
        .alias(f"{c}_scaled") for c in _MM])


@register("churn_tree_importance", None, "M6 M19 (random forest; rows-only)")
def q_churn_tree_importance(spark, sf_dir):
    snap = snapshot(spark, sf_dir)
    model, _, score = CH.fit_model(snap, "random_forest", P.seed)
    scored = snap.join(score(snap).select("customer_id", "churn_probability"), "customer_id")
    return CH.tree_importance(model.stages[-1], scored)


@register("pipeline_run", None, "G6 S5 S6 S7 S8 A30 (whole batch; rows-only)")
def q_pipeline_run(spark, sf_dir):
    """Runs the whole batch, comparison of the four churn models included, with outputs under
    the shared checkpoint folder; returns the executive summary."""
    from valuescope.plans.pipeline import run_all
    from valuescope.sources import transactions_from_orders

    out_dir = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    res = run_all(spark, transactions_from_orders(spark, sf_dir, descriptive=True), P, out_dir,
                  churn_model="auto")
    return res["executive_summary"]
