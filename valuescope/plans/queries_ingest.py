"""Text ingestion: untyped sources of different column order, told by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuescope.plans.catalog import register
from valuescope.sources import ingest, ingest_rejects
from valuescope.sources.transactions import read_table

#: Added to the customer ids of one source: their sums need more than 53 bits.
WIDE_ID = 9007199254740993


def lines_as_text(spark, sf_dir):
    """Order lines as an untyped sheet: ISO texts and month/day/year texts, some values invalid."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    t = li.join(o, li.l_orderkey == o.o_orderkey).withColumn("k", F.col("l_orderkey") * 7 + F.col("l_linenumber"))
    k, when = F.col("k"), F.col("o_orderdate")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    return t.select(
        F.col("o_orderkey").cast("string").alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.lit(None).cast("string").alias("Description"),
        F.when(k % 11 == 0, "n/a").when(k % 13 == 0, F.concat(whole, F.lit(".5"))).when(k % 3 == 0, F.concat(whole, F.lit(".0")))
        .otherwise(whole).alias("Quantity"),
        F.when(k % 17 == 0, "not a date").when(k % 5 == 0, F.date_format(when, "M/d/yyyy H:mm")).when(k % 7 == 0, F.date_format(when, "yyyy-MM-dd"))
        .when(k % 13 == 0, F.date_format(when, "M/d/yy H:mm")).when(k % 11 == 0, F.date_format(when, "MM/dd/yyyy HH:mm:ss"))
        .when(k % 19 == 0, F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).when(k % 23 == 0, F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .otherwise(F.date_format(when, "yyyy-MM-dd HH:mm:ss")).alias("InvoiceDate"),
        F.when(k % 19 == 0, "").when(k % 29 == 0, "Infinity").when(k % 31 == 0, "1e30").when(k % 37 == 0, "NaN").when(k % 41 == 0, "free")
        .otherwise(F.col("l_extendedprice").cast("string")).alias("Price"),
        F.when(k % 23 == 0, "guest").when(k % 43 == 0, "99999999999999999999").otherwise((F.col("o_custkey") + F.lit(WIDE_ID)).cast("string")).alias("Customer ID"),
        F.lit("unknown").alias("Country"),
    )


def purchases_as_text(spark, sf_dir):
    """Purchase events as an untyped sheet with its columns in another order and a column of its own."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    k = F.col("event_id")
    return ev.select(
        F.col("user_id").cast("string").alias("Customer ID"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("InvoiceDate"),
        F.when(k % 7 == 0, F.lit(" 1 ")).otherwise(F.lit("1")).alias("Quantity"),
        F.col("props").alias("Note"),
        F.col("event_type").alias("StockCode"),
        F.when(k % 5 == 0, F.concat(F.lit("EUR "), F.col("value").cast("string"))).otherwise(F.col("value").cast("string")).alias("Price"),
        F.lit(None).cast("string").alias("Country"),
        F.concat(F.lit("C"), k.cast("string")).alias("Invoice"),
        F.col("event_type").alias("Description"),
    )


@register(
    "ingest_text",
    f"""WITH t AS (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS invoice, CAST(l_partkey AS VARCHAR) AS stock_code, CAST(NULL AS VARCHAR) AS description,
  CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 5 = 0 THEN date_trunc('minute', o_orderdate)
       WHEN k % 7 = 0 THEN date_trunc('day', o_orderdate) WHEN k % 13 = 0 THEN date_trunc('minute', o_orderdate)
       WHEN k % 11 <> 0 AND k % 19 = 0 THEN date_trunc('second', o_orderdate) - INTERVAL 2 HOUR
       ELSE date_trunc('second', o_orderdate) END AS invoice_dt,
  CASE WHEN k % 19 = 0 OR k % 29 = 0 OR k % 31 = 0 OR k % 37 = 0 OR k % 41 = 0 THEN NULL ELSE l_extendedprice END AS unit_price,
  CASE WHEN k % 23 = 0 OR k % 43 = 0 THEN NULL ELSE o_custkey + {WIDE_ID} END AS customer_id,
  'unknown' AS country, 'lines' AS source_sheet
FROM t
UNION ALL
SELECT 'C' || CAST(event_id AS VARCHAR), event_type, event_type, CAST(1 AS BIGINT), ts,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END, CAST(user_id AS BIGINT), NULL, 'purchases'
FROM events WHERE event_type = 'purchase'""",
    "S1 S2 S3 P1 P2 P3 P4",
)
def q_ingest_text(spark, sf_dir):
    return ingest({"lines": lines_as_text(spark, sf_dir), "purchases": purchases_as_text(spark, sf_dir)})


def _reason_sql(source: str, table: str, column: str, cases: list[tuple[str, str]]) -> str:
    case = " ".join(f"WHEN {condition} THEN '{reason}'" for condition, reason in cases)
    return f"SELECT '{source}' AS source_sheet, '{column}' AS \"column\", CASE {case} END AS reason FROM {table}"


_REJECTS = " UNION ALL ".join([
    _reason_sql("lines", "t", "quantity", [("k % 11 = 0", "not_a_number"), ("k % 13 = 0", "not_whole")]),
    _reason_sql("lines", "t", "invoice_dt", [("k % 17 = 0", "not_a_time")]),
    _reason_sql("lines", "t", "unit_price", [("k % 19 = 0", ""), ("k % 29 = 0", "not_finite"), ("k % 31 = 0", "out_of_range"), ("k % 37 = 0", "not_finite"), ("k % 41 = 0", "not_a_number")]),
    _reason_sql("lines", "t", "customer_id", [("k % 23 = 0", "not_a_number"), ("k % 43 = 0", "out_of_range")]),
    _reason_sql("purchases", "events", "unit_price", [("event_type = 'purchase' AND event_id % 5 = 0", "not_a_number")]),
])


@register(
    "ingest_rejects",
    f"""WITH t AS (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS ({_REJECTS})
SELECT source_sheet, "column", reason, CAST(count(*) AS BIGINT) AS n FROM r WHERE reason <> '' GROUP BY ALL""",
    "P3 P4 S1",
)
def q_ingest_rejects(spark, sf_dir):
    """Texts that became NULL, by source, column and reason (blank texts are missing values, not rejects)."""
    found = ingest_rejects({"lines": lines_as_text(spark, sf_dir), "purchases": purchases_as_text(spark, sf_dir)})
    return found.groupBy("source_sheet", "column", "reason").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
