"""Cleaning rules, duplicate handling and data-quality profiles.

F1-F6, D1-D2, A12-A15.  The rules are row-local predicates, so Catalyst
pushes them into the Parquet scan; exact-duplicate removal is the only
shuffle and runs after the filters so less data moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuescope.functions import money_sum
from valuescope.operators.common import attach_one_row
from valuescope.schemas import TXN_COLUMNS, require_columns
from valuescope.sources.transactions import MAX_PRICE, MAX_QUANTITY

# Rule names in the order the rules are applied.
RULES = [
    "cancelled_invoice",
    "non_positive_quantity",
    "invalid_unit_price",
    "missing_customer_id",
    "missing_invoice_dt",
]
DEDUP_RULE = "exact_duplicate"


def rule_predicates() -> list[tuple[str, Column]]:
    """(rule, keep-predicate) pairs; a row passes when every predicate is true."""
    return [
        ("cancelled_invoice", ~F.coalesce(F.col("invoice").startswith("C"), F.lit(False))),
        ("non_positive_quantity", F.coalesce((F.col("quantity") > 0) & (F.col("quantity") <= MAX_QUANTITY), F.lit(False))),
        # NaN is above every number; infinite and absurd prices would overflow the exact money type
        ("invalid_unit_price", F.coalesce((F.col("unit_price") > 0) & (F.col("unit_price") <= MAX_PRICE), F.lit(False))),
        ("missing_customer_id", F.col("customer_id").isNotNull()),
        ("missing_invoice_dt", F.col("invoice_dt").isNotNull()),
    ]


def compute_revenue(df: DataFrame) -> Column:
    """P5: revenue = quantity * unit_price (double)."""
    return (F.col("quantity").cast("double") * F.col("unit_price")).alias("revenue")


def clean_transactions(raw: DataFrame, dedup: bool = True, shared: tuple = ()) -> DataFrame:
    """F1-F5 filters, exact-duplicate removal (D1), revenue (P5).

    Output order is left to the writer (O1 is ``orderBy`` at write time). ``shared``: further
    columns of ``raw`` that equal rows are known to share, such as the key of the order that the
    invoice is named after; rows that are dealt by it already aren't shuffled again.
    """
    require_columns(raw, TXN_COLUMNS, "transactions_raw")
    keep = None
    for _, pred in rule_predicates():
        keep = pred if keep is None else keep & pred
    df = raw.select(*TXN_COLUMNS, *shared).filter(keep)
    if dedup:
        df = df.dropDuplicates()
    return df.select(*TXN_COLUMNS, compute_revenue(df))


def first_failing_rule(df: DataFrame) -> Column:
    """Name of the first rule (in code order) that removes the row, else NULL."""
    expr = F.lit(None).cast("string")
    for name, pred in reversed(rule_predicates()):
        expr = F.when(~pred, F.lit(name)).otherwise(expr)
    return expr


def counted_rows(df: DataFrame, cols: list[str], *more: Column) -> DataFrame:
    """Distinct rows (NULLs equal) and ``_n``, how often each occurs: one grouping by all columns.

    Rows, duplicates, rates and distinct values all follow from it, so the table is read and shuffled
    once. Equal rows are combined before the shuffle.
    """
    rows = df.select(*cols, *more)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))


def cleaning_waterfall(raw: DataFrame) -> DataFrame:
    """Rows removed by each rule in order, from one grouping of the rows.

    Columns: step, rule, rows_removed, rows_remaining.
    """
    require_columns(raw, TXN_COLUMNS, "transactions_raw")
    spark = raw.sparkSession
    rows = counted_rows(raw, TXN_COLUMNS, first_failing_rule(raw).alias("rule"))
    by_rule = rows.groupBy("rule").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("distinct"))  # at most 6 rows
    # rows that pass all rules: what is beyond the first of equal ones
    counts = by_rule.select(
        F.coalesce("rule", F.lit(DEDUP_RULE)).alias("rule"),
        F.when(F.col("rule").isNull(), F.col("n") - F.col("distinct")).otherwise(F.col("n")).alias("n"), F.col("n").alias("_rows"))
    # 6-row rule-order table (fixed, not data-dependent)
    order = spark.createDataFrame(
        [(i + 1, r) for i, r in enumerate(RULES + [DEDUP_RULE])], "step int, rule string"
    )
    from pyspark.sql import Window

    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # 6 rows
    total = F.coalesce(F.sum("_rows").over(Window.partitionBy()), F.lit(0))
    removed = F.coalesce("n", F.lit(0))
    return F.broadcast(order).join(counts, "rule", "left").select(
        "step", "rule", removed.cast("bigint").alias("rows_removed"), (total - F.sum(removed).over(w)).cast("bigint").alias("rows_remaining"))


def _profile(counted: DataFrame, rates: dict[str, Column], by_customer: bool) -> DataFrame:
    """One row from ``counted_rows``: rows, unique_customers (if asked), the rates and duplicate_row_rate.

    Customers are grouped after the rows, so that no distinct count has to expand them.
    """
    sums = [F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"), *[F.sum(F.when(c, F.col("_n")).otherwise(0)).alias(name) for name, c in rates.items()]]
    customers = []
    if by_customer:
        counted = counted.groupBy("customer_id").agg(*sums)
        sums = [F.sum(c).alias(c) for c in ("_n", "_distinct", *rates)]
        customers = [F.col("unique_customers").cast("bigint")]
        sums.append(F.count("customer_id").alias("unique_customers"))
    one = counted.agg(*sums)
    n = F.nullif(F.col("_n"), F.lit(0))
    return one.select(F.coalesce("_n", F.lit(0)).cast("bigint").alias("rows"), *customers, *[F.round(F.col(name) / n, 6).alias(name) for name in rates],
                      F.round((F.col("_n") - F.col("_distinct")) / n, 6).alias("duplicate_row_rate"))


def basic_profile(raw: DataFrame) -> DataFrame:
    """Ingestion-time quality indicators, one row."""
    return _profile(counted_rows(raw, TXN_COLUMNS), {
        "missing_customer_id_rate": F.col("customer_id").isNull(),
        "missing_invoice_dt_rate": F.col("invoice_dt").isNull(),
        "nonpositive_price_rate": F.coalesce("unit_price", F.lit(0.0)) <= 0,
        "negative_quantity_rate": F.coalesce("quantity", F.lit(0)) < 0,
    }, by_customer=False)


def profile_dataset(df: DataFrame) -> DataFrame:
    """Profile of any transaction table (adds distinct customers, D3)."""
    return _profile(counted_rows(df, df.columns), {
        "missing_customer_id_rate": F.col("customer_id").isNull(),
        "missing_invoice_dt_rate": F.col("invoice_dt").isNull(),
        "nonpositive_price_rate": F.coalesce("unit_price", F.lit(0.0)) <= 0,
        "nonpositive_quantity_rate": F.coalesce("quantity", F.lit(0)) <= 0,
        "cancellation_rate": F.coalesce(F.col("invoice").startswith("C"), F.lit(False)),
    }, by_customer=True)


def cleaning_impact(before: DataFrame, after: DataFrame) -> DataFrame:
    """before/after summary, one row (two 1-row aggregates joined)."""
    b = before.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct("customer_id").alias("customers_before"),
    )
    a = after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_distinct("customer_id").alias("customers_after"),
        money_sum("revenue").alias("revenue_after_sum"),
    )
    j = attach_one_row(b, a)
    return j.select(
        F.col("rows_before").cast("bigint"),
        F.col("rows_after").cast("bigint"),
        (F.col("rows_before") - F.col("rows_after")).cast("bigint").alias("rows_removed"),
        F.round((F.col("rows_before") - F.col("rows_after")) / F.greatest(F.col("rows_before"), F.lit(1)), 6)
        .alias("pct_removed"),
        F.col("customers_before").cast("bigint"),
        F.col("customers_after").cast("bigint"),
        F.round("revenue_after_sum", 2).alias("revenue_after_sum"),
    )
