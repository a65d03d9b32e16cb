"""Fixed table schemas (the contract between steps) and column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Canonical line-item columns, in output order.
TXN_COLUMNS = [
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_dt",
    "unit_price",
    "customer_id",
    "country",
    "source_sheet",
]

TRANSACTIONS_RAW = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("invoice_dt", T.TimestampNTZType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("source_sheet", T.StringType()),
    ]
)

TRANSACTIONS_CLEAN = T.StructType(TRANSACTIONS_RAW.fields + [T.StructField("revenue", T.DoubleType())])

# Raw workbook header names -> canonical names.
RAW_TO_CANONICAL = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_dt",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

FEATURE_COLUMNS = [
    "recency_days",
    "tenure_days",
    "n_invoices",
    "total_revenue",
    "avg_order_value",
    "revenue_last_30d",
    "revenue_last_90d",
    "rev_30_to_90_ratio",
]


def require_columns(df: DataFrame, required, name: str) -> DataFrame:
    """Raise ``ValueError`` naming the table when columns are missing (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing required columns {sorted(missing)}")
    return df
