"""Cohort queries."""

from __future__ import annotations

from valuescope.operators import cohorts as CO
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.plans.queries_core import txn_orders

P = TESTDATA_PARAMS

_FRAME = f"""pairs AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', invoice_dt) AS DATE) AS pm FROM txn),
coh AS (SELECT customer_id, min(pm) AS cm FROM pairs GROUP BY customer_id),
cf AS (
  SELECT p.customer_id, c.cm, p.pm, CAST(floor(date_diff('day', c.cm, p.pm) / 30) AS INTEGER) AS m
  FROM pairs p JOIN coh c ON p.customer_id = c.customer_id
),
valid AS (SELECT cm, count(DISTINCT customer_id) AS size FROM coh GROUP BY cm HAVING count(DISTINCT customer_id) >= {P.min_cohort_size}),
act AS (SELECT cm, m, count(DISTINCT customer_id) AS active FROM cf WHERE cm IN (SELECT cm FROM valid) GROUP BY cm, m),
matrix AS (
  SELECT strftime(v.cm, '%Y-%m') AS cohort_month,
  {", ".join(f"round_even(max(CASE WHEN a.m = {k} THEN a.active END) / v.size * 100.0, 1) AS m{k}" for k in range(P.max_months + 1))}
  FROM valid v JOIN act a ON a.cm = v.cm GROUP BY v.cm, v.size
)"""

_MCOLS = ", ".join(f"m{k}" for k in range(P.max_months + 1))


@register("cohort_retention", S.with_(S.txn_cte("orders"), _FRAME) + f"SELECT cohort_month, {_MCOLS} FROM matrix",
          "W14 J8 A25 A26 A27 F15 J10 G3 P10 P15")
def q_cohort_retention(spark, sf_dir):
    return CO.retention_matrix(txn_orders(spark, sf_dir), P.max_months, P.min_cohort_size)


@register(
    "cohort_revenue",
    S.with_(S.txn_cte("orders"), _FRAME)
    + f""", rev AS (
  SELECT c.cm, CAST(sum({S.money('t.revenue')}) AS DOUBLE) AS total_revenue,
    CAST(count(DISTINCT t.customer_id) AS BIGINT) AS n_customers, CAST(count(t.invoice_dt) AS BIGINT) AS n_transactions
  FROM txn t JOIN coh c ON t.customer_id = c.customer_id
  WHERE c.cm IN (SELECT cm FROM valid) GROUP BY c.cm
)
SELECT strftime(cm, '%Y-%m') AS cohort_month, total_revenue, n_customers, n_transactions,
  round_even(total_revenue / n_customers, 2) AS avg_revenue_per_customer FROM rev""",
    "A28 F15",
)
def q_cohort_revenue(spark, sf_dir):
    return CO.cohort_revenue(txn_orders(spark, sf_dir), P.min_cohort_size)


_CURVE_COLS = [f"m{k}" for k in range(10)]


@register(
    "retention_curves",
    S.with_(S.txn_cte("orders"), _FRAME)
    + f""", kept AS (
  SELECT * FROM matrix WHERE ({' + '.join(f'CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END' for c in _CURVE_COLS)}) >= 3
)
{' UNION ALL '.join(f"SELECT cohort_month, {k} AS month, m{k} AS retention_pct FROM kept WHERE m{k} IS NOT NULL" for k in range(10))}""",
    "G4 F16",
)
def q_retention_curves(spark, sf_dir):
    return CO.retention_curves(CO.retention_matrix(txn_orders(spark, sf_dir), P.max_months, P.min_cohort_size))


@register(
    "latest_cohorts",
    S.with_(S.txn_cte("orders"), _FRAME) + f"SELECT cohort_month, {_MCOLS} FROM matrix ORDER BY cohort_month DESC LIMIT 15",
    "O5",
)
def q_latest_cohorts(spark, sf_dir):
    return CO.latest_cohorts(CO.retention_matrix(txn_orders(spark, sf_dir), P.max_months, P.min_cohort_size))
