"""Queries on amounts below a cent."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuescope.functions import money_sum
from valuescope.plans import sql as S
from valuescope.plans.catalog import register


@register(
    "fractional_cents",
    f"""WITH txn AS (
  SELECT o.o_custkey AS customer_id, l.l_extendedprice / CAST(9000 AS DOUBLE) AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)
SELECT customer_id, CAST(count(*) AS BIGINT) AS lines, {S.money_sum('revenue')} AS revenue
FROM txn GROUP BY customer_id""",
    "A1 A2 P5 P7",
)
def q_fractional_cents(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    txn = lines.select("l_orderkey", (F.col("l_extendedprice") / F.lit(9000.0)).alias("revenue")).join(
        orders.select("o_orderkey", F.col("o_custkey").alias("customer_id")), F.col("l_orderkey") == F.col("o_orderkey"))
    return txn.groupBy("customer_id").agg(F.count(F.lit(1)).alias("lines"), money_sum("revenue").alias("revenue"))
