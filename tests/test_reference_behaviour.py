"""Behaviours pinned by the original unit tests, on local Spark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from valuescope.operators import btyd, churn, cleaning, features, spend

TXN_SCHEMA = ("invoice string, stock_code string, description string, quantity long, invoice_dt timestamp_ntz, "
              "unit_price double, customer_id long, country string, source_sheet string")
CUTOFF = dt.datetime(2011, 6, 1)


def _txn(spark, rows):
    return spark.createDataFrame(rows, TXN_SCHEMA)


def test_cleaning_removes_bad_rows(spark):
    d = dt.datetime(2011, 1, 1)
    raw = _txn(spark, [
        ("C1", "A", "x", -1, d, 10.0, 1, "UK", "s"),
        ("2", "A", "x", 1, d, 0.0, 1, "UK", "s"),
        ("3", "A", "x", 1, None, 5.0, 1, "UK", "s"),
    ])
    assert cleaning.clean_transactions(raw).count() == 0


def test_revenue_is_quantity_times_price(spark):
    d = dt.datetime(2011, 1, 1)
    raw = _txn(spark, [("1", "A", "x", 2, d, 10.0, 1, "UK", "s"), ("2", "B", "y", 3, d, 5.0, 2, "UK", "s")])
    out = cleaning.clean_transactions(raw).orderBy("invoice").collect()
    assert [r["revenue"] for r in out] == [20.0, 15.0]
    assert all(r["customer_id"] is not None and r["invoice_dt"] is not None for r in out)


def test_null_invoice_is_not_a_cancellation(spark):
    d = dt.datetime(2011, 1, 1)
    raw = _txn(spark, [(None, "A", "x", 2, d, 10.0, 1, "UK", "s")])
    assert cleaning.clean_transactions(raw).count() == 1


def _inv(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, invoice string, invoice_dt timestamp_ntz, revenue double")


def test_features_one_row_per_customer(spark):
    rows = [(1, "A1", dt.datetime(2011, 1, 5), 10.0), (1, "A2", dt.datetime(2011, 5, 20), 20.0),
            (2, "B1", dt.datetime(2011, 2, 1), 5.0), (2, "B2", dt.datetime(2011, 3, 1), 7.0),
            (2, "B3", dt.datetime(2011, 5, 30), 8.0)]
    f = features.customer_features(_inv(spark, rows), CUTOFF)
    out = {r["customer_id"]: r for r in f.collect()}
    assert set(out) == {1, 2}
    assert len(f.columns) == 9
    for r in out.values():
        assert r["recency_days"] >= 0 and r["n_invoices"] > 0 and r["total_revenue"] >= 0
    assert out[2]["n_invoices"] == 3 and out[2]["recency_days"] == 2


def test_features_ignore_post_cutoff(spark):
    rows = [(1, "A1", dt.datetime(2011, 5, 1), 10.0), (1, "A2", dt.datetime(2011, 7, 1), 9999.0)]
    f = features.customer_features(_inv(spark, rows), CUTOFF).first()
    assert f["total_revenue"] == 10.0


def test_recency_floors_partial_days(spark):
    rows = [(1, "A1", dt.datetime(2011, 5, 31, 10, 0), 10.0)]
    f = features.customer_features(_inv(spark, rows), CUTOFF).first()
    assert f["recency_days"] == 0  # datediff would say 1


def test_invoice_rollup(spark):
    d = dt.datetime(2011, 1, 1)
    rows = [(1, "A1", d, 10.0), (1, "A1", d, 5.0), (1, "A2", d, 7.0)]
    inv = {r["invoice"]: r["revenue"] for r in features.invoices(_inv(spark, rows)).collect()}
    assert inv == {"A1": 15.0, "A2": 7.0}


def test_daily_discount_rate():
    r = spend.annual_to_daily_rate(0.10)
    assert 0 < r < 0.001
    assert spend.annual_to_daily_rate(0.0) == 0.0
    with pytest.raises(ValueError):
        spend.annual_to_daily_rate(-0.1)


def test_churn_labels(spark):
    cutoff = dt.datetime(2011, 6, 1)
    rows = [(1, "a", dt.datetime(2011, 6, 10), 1.0), (2, "b", dt.datetime(2011, 9, 15), 1.0),
            (3, "c", dt.datetime(2011, 12, 1), 1.0)]
    inv = _inv(spark, rows)
    cust = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    lab = {r["customer_id"]: r["churn_label"] for r in churn.churn_labels(inv, cust, cutoff, 180, 90).collect()}
    assert lab == {1: 0, 2: 1, 3: 1}


def test_purchase_on_cutoff_is_ignored(spark):
    cutoff = dt.datetime(2011, 6, 1)
    rows = [(1, "a", cutoff, 1.0), (1, "b", cutoff + dt.timedelta(days=4), 1.0)]
    cust = spark.createDataFrame([(1,)], "customer_id long")
    r = churn.churn_labels(_inv(spark, rows), cust, cutoff, 90, 30).first()
    assert r["churn_label"] == 0 and r["days_to_next_purchase"] == 4


def test_label_validation(spark):
    cust = spark.createDataFrame([(1,)], "customer_id long")
    with pytest.raises(ValueError):
        churn.churn_labels(_inv(spark, [(1, "a", CUTOFF, 1.0)]), cust, CUTOFF, 30, 90)


def test_snapshot_unlabelled_is_churned(spark):
    feats = spark.createDataFrame([(i, 1, 2, 1, 10.0, 10.0, 0.0, 0.0, 0.0) for i in (1, 2, 3)],
                                  "customer_id long, recency_days long, tenure_days long, n_invoices long, "
                                  "total_revenue double, avg_order_value double, revenue_last_30d double, "
                                  "revenue_last_90d double, rev_30_to_90_ratio double")
    labels = spark.createDataFrame([(1, None, 5, 0), (2, None, None, 1)],
                                   "customer_id long, first_purchase_post_cutoff timestamp_ntz, "
                                   "days_to_next_purchase long, churn_label int")
    snap = churn.build_snapshot(feats, labels, CUTOFF, 180, 90)
    got = {r["customer_id"]: r["churn_label"] for r in snap.collect()}
    assert got == {1: 0, 2: 1, 3: 1}
    for c in ("cutoff_date", "prediction_horizon_days", "churn_inactivity_days"):
        assert c in snap.columns


def test_calibration_collapses_same_day_invoices(spark):
    rows = [(1, "a", dt.datetime(2011, 1, 1, 9), 1.0), (1, "b", dt.datetime(2011, 1, 1, 15), 1.0),
            (1, "c", dt.datetime(2011, 1, 11), 1.0), (1, "d", dt.datetime(2011, 6, 10), 1.0)]
    s = btyd.calibration_holdout(_inv(spark, rows), CUTOFF, dt.datetime(2011, 7, 1)).first()
    assert (s["frequency_cal"], s["recency_cal"], s["T_cal"], s["frequency_holdout"]) == (1.0, 10.0, 151.0, 1.0)


def test_require_columns_names_the_table(spark):
    from valuescope.schemas import require_columns

    df = spark.createDataFrame([(1,)], "customer_id long")
    with pytest.raises(ValueError, match="transactions"):
        require_columns(df, ["customer_id", "invoice"], "transactions")


def test_policy_validation():
    from valuescope.operators.policy import validate_config

    validate_config(100.0, 2.0, 0.1, 0.0)
    for bad in ((0, 2, 0.1, 0), (100, 0, 0.1, 0), (100, 2, 1.5, 0), (100, 2, 0.1, -1)):
        with pytest.raises(ValueError):
            validate_config(*bad)


def test_standardize_parses_text_and_rejects_non_integral(spark):
    from valuescope.sources import standardize

    raw = spark.createDataFrame(
        [("1", "A", "x", "2", "2011-01-01 10:00:00", "1.5", "17850.0", "UK"),
         ("2", "B", "y", "2.5", "not a date", "abc", "12.3", "UK")],
        "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, "
        "Price string, `Customer ID` string, Country string")
    rows = {r["invoice"]: r for r in standardize(raw, "sheet").collect()}
    assert rows["1"]["quantity"] == 2 and rows["1"]["customer_id"] == 17850 and rows["1"]["unit_price"] == 1.5
    assert rows["2"]["quantity"] is None and rows["2"]["customer_id"] is None
    assert rows["2"]["invoice_dt"] is None and rows["2"]["unit_price"] is None
    assert rows["1"]["source_sheet"] == "sheet"
