"""Phase 0-2 queries: sources, cleaning, invoices, features, profiles."""

from __future__ import annotations


from valuescope.operators import cleaning, features
from valuescope.params import EVENTS_PARAMS, TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.sources import dirty_transactions, transactions_from_events, transactions_from_orders

P = TESTDATA_PARAMS
EP = EVENTS_PARAMS


# ---------------------------------------------------------------- inputs
def txn_orders(spark, sf_dir):
    """Cleaned line items from the order tables (lean: no descriptive joins)."""
    # the invoice names the order, so equal rows share its key, by which the join has dealt them
    raw = transactions_from_orders(spark, sf_dir, descriptive=False, keys=("l_orderkey",))
    return cleaning.clean_transactions(raw, shared=("l_orderkey",))


def txn_events(spark, sf_dir):
    return cleaning.clean_transactions(transactions_from_events(spark, sf_dir))


def txn_dirty(spark, sf_dir):
    return cleaning.clean_transactions(dirty_transactions(spark, sf_dir, descriptive=True))


# ---------------------------------------------------------------- S1-S4, P1-P4
@register(
    "transactions_raw",
    S.with_(S.RAW) + f"SELECT {S.TXN_COLS} FROM raw",
    "S1 S3 S4 P1 P2 P3 P4",
)
def q_transactions_raw(spark, sf_dir):
    # production ingestion path: untyped text columns -> standardize
    return transactions_from_orders(spark, sf_dir, descriptive=True, as_raw_text=True)


# ---------------------------------------------------------------- F1-F6, D1, P5
@register(
    "clean_transactions",
    S.with_(S.txn_cte("dirty")) + f"SELECT {S.TXN_COLS}, revenue FROM txn",
    "F1 F2 F3 F4 F5 F6 D1 P5",
)
def q_clean_transactions(spark, sf_dir):
    return txn_dirty(spark, sf_dir)


_WATERFALL_SQL = S.with_(
    S.DIRTY,
    f"""tagged AS (
  SELECT {S.TXN_COLS},
    CASE WHEN coalesce(starts_with(invoice, 'C'), false) THEN 'cancelled_invoice'
         WHEN NOT coalesce(quantity > 0 AND quantity <= 1000000000, false) THEN 'non_positive_quantity'
         WHEN NOT coalesce(unit_price > 0 AND unit_price <= 1e9, false) THEN 'invalid_unit_price'
         WHEN customer_id IS NULL THEN 'missing_customer_id'
         WHEN invoice_dt IS NULL THEN 'missing_invoice_dt' END AS rule
  FROM raw
)""",
    """counts AS (
  SELECT rule, count(*) AS n FROM tagged WHERE rule IS NOT NULL GROUP BY rule
  UNION ALL
  SELECT 'exact_duplicate', (SELECT count(*) FROM tagged WHERE rule IS NULL)
         - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (rule) FROM tagged WHERE rule IS NULL))
)""",
    """steps(step, rule) AS (VALUES (1, 'cancelled_invoice'), (2, 'non_positive_quantity'),
  (3, 'invalid_unit_price'), (4, 'missing_customer_id'), (5, 'missing_invoice_dt'), (6, 'exact_duplicate'))""",
    """j AS (
  SELECT s.step, s.rule, CAST(coalesce(c.n, 0) AS BIGINT) AS rows_removed
  FROM steps s LEFT JOIN counts c ON s.rule = c.rule
)""",
) + """SELECT CAST(step AS INTEGER) AS step, rule, rows_removed,
  CAST((SELECT count(*) FROM tagged) - sum(rows_removed) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_remaining
FROM j"""


@register("cleaning_waterfall", _WATERFALL_SQL, "A15 D2")
def q_cleaning_waterfall(spark, sf_dir):
    return cleaning.cleaning_waterfall(dirty_transactions(spark, sf_dir, descriptive=True))


_RATE = "round(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END), 6)"


@register(
    "basic_profile",
    S.with_(S.DIRTY)
    + f"""SELECT CAST(count(*) AS BIGINT) AS rows,
  {_RATE.format(c='customer_id IS NULL')} AS missing_customer_id_rate,
  {_RATE.format(c='invoice_dt IS NULL')} AS missing_invoice_dt_rate,
  {_RATE.format(c='coalesce(unit_price, 0.0) <= 0')} AS nonpositive_price_rate,
  {_RATE.format(c='coalesce(quantity, 0) < 0')} AS negative_quantity_rate,
  round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))) / count(*), 6) AS duplicate_row_rate
FROM raw""",
    "A12 D2",
)
def q_basic_profile(spark, sf_dir):
    return cleaning.basic_profile(dirty_transactions(spark, sf_dir, descriptive=True))


@register(
    "dataset_profile",
    S.with_(S.DIRTY)
    + f"""SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
  {_RATE.format(c='customer_id IS NULL')} AS missing_customer_id_rate,
  {_RATE.format(c='invoice_dt IS NULL')} AS missing_invoice_dt_rate,
  {_RATE.format(c='coalesce(unit_price, 0.0) <= 0')} AS nonpositive_price_rate,
  {_RATE.format(c='coalesce(quantity, 0) <= 0')} AS nonpositive_quantity_rate,
  {_RATE.format(c="coalesce(starts_with(invoice, 'C'), false)")} AS cancellation_rate,
  round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))) / count(*), 6) AS duplicate_row_rate
FROM raw""",
    "A13 D3",
)
def q_dataset_profile(spark, sf_dir):
    return cleaning.profile_dataset(dirty_transactions(spark, sf_dir, descriptive=True))


@register(
    "cleaning_impact",
    S.with_(S.txn_cte("dirty"))
    + f"""SELECT CAST(b.rows_before AS BIGINT) AS rows_before, CAST(a.rows_after AS BIGINT) AS rows_after,
  CAST(b.rows_before - a.rows_after AS BIGINT) AS rows_removed,
  round((b.rows_before - a.rows_after) / greatest(b.rows_before, 1), 6) AS pct_removed,
  CAST(b.customers_before AS BIGINT) AS customers_before, CAST(a.customers_after AS BIGINT) AS customers_after,
  round(a.revenue_after_sum, 2) AS revenue_after_sum
FROM (SELECT count(*) AS rows_before, count(DISTINCT customer_id) AS customers_before FROM raw) b,
     (SELECT count(*) AS rows_after, count(DISTINCT customer_id) AS customers_after,
             {S.money_sum('revenue')} AS revenue_after_sum FROM txn) a""",
    "A14",
)
def q_cleaning_impact(spark, sf_dir):
    raw = dirty_transactions(spark, sf_dir, descriptive=True)
    return cleaning.cleaning_impact(raw, cleaning.clean_transactions(raw))


# ---------------------------------------------------------------- A1, A10
@register(
    "invoices",
    S.with_(S.txn_cte("orders"), S.INVOICES) + "SELECT customer_id, invoice, invoice_dt, revenue FROM inv",
    "A1",
)
def q_invoices(spark, sf_dir):
    return features.invoices(txn_orders(spark, sf_dir))


def _holdout_end_sql(source, p):
    desired = S.ts(p.cutoff + __import__("datetime").timedelta(days=p.holdout_days))
    c = S.ts(p.cutoff)
    return S.with_(S.txn_cte(source), S.INVOICES) + f"""SELECT least({desired}, max(invoice_dt)) AS holdout_end,
  least({desired}, max(invoice_dt)) > {c} AS valid,
  {S.days(c, f'least({desired}, max(invoice_dt))')} AS holdout_days
FROM inv"""


@register("holdout_end", _holdout_end_sql("orders", P), "A10 P11")
def q_holdout_end(spark, sf_dir):
    return features.holdout_end(features.invoices(txn_orders(spark, sf_dir)), P.cutoff, P.holdout_days)


# ---------------------------------------------------------------- A2-A6
_FEATURE_SELECT = """SELECT customer_id, recency_days, tenure_days, n_invoices, total_revenue, avg_order_value,
  revenue_last_30d, revenue_last_90d, rev_30_to_90_ratio FROM features"""


@register(
    "customer_features",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff)) + _FEATURE_SELECT,
    "A2 A3 A4 A5 A6 F7 F10 P6 P7 P9",
)
def q_customer_features(spark, sf_dir):
    return features.customer_features(txn_orders(spark, sf_dir), P.cutoff)


@register(
    "customer_features_events",
    S.with_(S.txn_cte("events"), S.features_cte(EP.cutoff)) + _FEATURE_SELECT,
    "A6 P9 (time of day)",
)
def q_customer_features_events(spark, sf_dir):
    return features.customer_features(txn_events(spark, sf_dir), EP.cutoff)


@register(
    "feature_profile",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff))
    + f"""SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
  round(avg(recency_days), 6) AS avg_recency_days, round(avg(n_invoices), 6) AS avg_n_invoices,
  round(CAST(sum({S.money('total_revenue')}) AS DOUBLE) / count(*), 6) AS avg_total_revenue,
  round(avg(CASE WHEN revenue_last_30d = 0 THEN 1.0 ELSE 0.0 END), 6) AS pct_zero_revenue_last_30d
FROM features""",
    "A16",
)
def q_feature_profile(spark, sf_dir):
    return features.feature_profile(features.customer_features(txn_orders(spark, sf_dir), P.cutoff))


@register(
    "feature_contracts",
    S.with_(S.txn_cte("orders"), S.features_cte(P.cutoff))
    + """SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(sum(CASE WHEN recency_days < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_recency,
  CAST(sum(CASE WHEN n_invoices <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_positive_invoices,
  CAST(sum(CASE WHEN total_revenue < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_revenue,
  CAST(sum(CASE WHEN tenure_days < recency_days THEN 1 ELSE 0 END) AS BIGINT) AS tenure_below_recency
FROM features""",
    "F17",
)
def q_feature_contracts(spark, sf_dir):
    return features.feature_contracts(features.customer_features(txn_orders(spark, sf_dir), P.cutoff))
