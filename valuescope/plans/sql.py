"""ANSI-SQL (DuckDB dialect) building blocks for the oracle queries.

Each registered query has an equivalent SQL text built from these common
table expressions over the pre-registered source views.  They state the
semantics independently of the DataFrame code, so the two can be
compared row for row.
"""

from __future__ import annotations

import datetime as dt

MICROS_PER_DAY = 86_400_000_000


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def days(start: str, end: str) -> str:
    """Floored whole days from start to end."""
    return f"CAST(floor(date_diff('microsecond', {start}, {end}) / {float(MICROS_PER_DAY)}) AS BIGINT)"


def money(x: str) -> str:
    """Exact decimal of the shortest text of a DOUBLE (a direct cast scales in floating point)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))"


def money_sum(x: str) -> str:
    return f"CAST(sum({money(x)}) AS DOUBLE)"


TXN_COLS = "invoice, stock_code, description, quantity, invoice_dt, unit_price, customer_id, country, source_sheet"

RAW_KEYED = """raw_keyed AS (
  SELECT (CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END) || CAST(o.o_orderkey AS VARCHAR) AS invoice,
         CAST(l.l_partkey AS VARCHAR) AS stock_code,
         p.p_name AS description,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         o.o_orderdate AS invoice_dt,
         l.l_extendedprice / l.l_quantity AS unit_price,
         o.o_custkey AS customer_id,
         n.n_name AS country,
         'Year ' || CAST(year(o.o_orderdate) AS VARCHAR) AS source_sheet,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RAW = f"""{RAW_KEYED},
raw AS (SELECT {TXN_COLS} FROM raw_keyed)"""

DIRTY = f"""{RAW_KEYED},
dirty_base AS (
  SELECT invoice, stock_code, description,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 = 0 THEN -quantity ELSE quantity END AS quantity,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 79 = 0 THEN NULL ELSE invoice_dt END AS invoice_dt,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 89 = 0 THEN 0.0 ELSE unit_price END AS unit_price,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 83 = 0 THEN NULL ELSE customer_id END AS customer_id,
         country, source_sheet, l_orderkey
  FROM raw_keyed
),
raw AS (
  SELECT {TXN_COLS} FROM dirty_base
  UNION ALL
  SELECT {TXN_COLS} FROM dirty_base WHERE l_orderkey % 101 = 0
)"""

KEEP = """NOT coalesce(starts_with(invoice, 'C'), false)
    AND coalesce(quantity > 0 AND quantity <= 1000000000, false)
    AND coalesce(unit_price > 0 AND unit_price <= 1e9, false)
    AND customer_id IS NOT NULL
    AND invoice_dt IS NOT NULL"""

CLEAN = f"""clean AS (
  SELECT DISTINCT {TXN_COLS} FROM raw WHERE {KEEP}
),
txn AS (SELECT *, CAST(quantity AS DOUBLE) * unit_price AS revenue FROM clean)"""

EVENTS_TXN = """txn AS (
  SELECT CAST(event_id AS VARCHAR) AS invoice, CAST(NULL AS VARCHAR) AS stock_code,
         CAST(NULL AS VARCHAR) AS description, CAST(1 AS BIGINT) AS quantity, ts AS invoice_dt,
         value AS unit_price, user_id AS customer_id, CAST(NULL AS VARCHAR) AS country,
         'events' AS source_sheet, value AS revenue
  FROM events WHERE event_type = 'purchase' AND value > 0
)"""


def txn_cte(source: str = "orders") -> str:
    """CTEs ending in ``txn`` (cleaned line items with revenue)."""
    if source == "orders":
        return f"{RAW},\n{CLEAN}"
    if source == "dirty":
        return f"{DIRTY},\n{CLEAN}"
    if source == "events":
        return EVENTS_TXN
    raise ValueError(source)


INVOICES = f"""inv AS (
  SELECT customer_id, invoice, min(invoice_dt) AS invoice_dt, {money_sum('revenue')} AS revenue
  FROM txn GROUP BY customer_id, invoice
)"""


def features_cte(cutoff: dt.datetime) -> str:
    c = ts(cutoff)
    return f"""cal_lines AS (
  SELECT customer_id, invoice, revenue, {days('invoice_dt', c)} AS d
  FROM txn WHERE invoice_dt < {c}
),
feat_agg AS (
  SELECT customer_id, min(d) AS recency_days, max(d) AS tenure_days,
         count(DISTINCT invoice) AS n_invoices,
         {money_sum('revenue')} AS total_revenue,
         coalesce(CAST(sum(CASE WHEN d <= 30 THEN {money('revenue')} END) AS DOUBLE), 0.0) AS r30,
         coalesce(CAST(sum(CASE WHEN d <= 90 THEN {money('revenue')} END) AS DOUBLE), 0.0) AS r90
  FROM cal_lines GROUP BY customer_id
),
features AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_id,
         CAST(recency_days AS BIGINT) AS recency_days,
         CAST(tenure_days AS BIGINT) AS tenure_days,
         CAST(n_invoices AS BIGINT) AS n_invoices,
         total_revenue,
         coalesce(total_revenue / nullif(CAST(n_invoices AS DOUBLE), 0), 0.0) AS avg_order_value,
         r30 AS revenue_last_30d,
         r90 AS revenue_last_90d,
         coalesce(r30 / nullif(r90, 0.0), 0.0) AS rev_30_to_90_ratio
  FROM feat_agg
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def qbin(rn: str, n: str, q: int) -> str:
    return (f"(CASE WHEN {n} <= 1 THEN 1 ELSE greatest(1, CAST(floor((({rn} - 1) * {q} + {n} - 2) / ({n} - 1)) AS INTEGER)) END)")


SEGMENT = """(CASE WHEN R = 4 AND F = 4 THEN 'Champions'
  WHEN R = 1 AND F = 4 THEN 'Cant Lose Them'
  WHEN R <= 2 AND F >= 3 THEN 'At Risk'
  WHEN R >= 3 AND F >= 3 THEN 'Loyal Customers'
  WHEN R >= 3 AND F = 2 THEN 'Potential Loyalists'
  WHEN R = 4 AND F = 1 THEN 'New Customers'
  WHEN R = 1 AND F <= 2 THEN 'Lost'
  ELSE 'Hibernating' END)"""

RFM = f"""rfm_rank AS (
  SELECT customer_id, recency_days, n_invoices, total_revenue,
    row_number() OVER (ORDER BY recency_days, customer_id) AS rn_r,
    row_number() OVER (ORDER BY n_invoices, customer_id) AS rn_f,
    row_number() OVER (ORDER BY total_revenue, customer_id) AS rn_m,
    count(*) OVER () AS n
  FROM features
),
rfm_s AS (
  SELECT customer_id, recency_days, n_invoices, total_revenue,
    CAST(least(greatest(5 - {qbin('rn_r', 'n', 4)}, 1), 4) AS INTEGER) AS R,
    CAST({qbin('rn_f', 'n', 4)} AS INTEGER) AS F,
    CAST({qbin('rn_m', 'n', 4)} AS INTEGER) AS M
  FROM rfm_rank
),
rfm AS (
  SELECT *, CAST(R + F + M AS INTEGER) AS rfm_score, {SEGMENT} AS segment FROM rfm_s
)"""

LORENZ = f"""lz0 AS (
  SELECT customer_id, total_revenue,
    row_number() OVER (ORDER BY total_revenue, customer_id) AS rn,
    count(*) OVER () AS n,
    sum({money('total_revenue')}) OVER (ORDER BY total_revenue, customer_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_dec,
    sum({money('total_revenue')}) OVER () AS s_dec
  FROM features
),
lz AS (
  SELECT *, CAST(cum_dec AS DOUBLE) / CAST(s_dec AS DOUBLE) * 100.0 AS cum_revenue_pct FROM lz0
)"""
