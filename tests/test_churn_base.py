"""Line items are joined and cleaned once for invoices and features, and duplicates are found where the join has dealt the rows."""

import datetime as dt

from valuescope.operators import cleaning, features
from valuescope.plans import queries_churn
from valuescope.plans.queries_core import txn_orders
from valuescope.sources import transactions_from_orders

SF = "/root/testdata/sf0.001"
CUTOFF = dt.datetime(2001, 1, 1)


def test_invoice_amounts_give_the_same_invoices_and_features(spark):
    day = dt.datetime(2000, 11, 1)
    rows = [(i % 5 if i % 11 else 7, f"i{i % 17}", day + dt.timedelta(days=(i * i) % 90, hours=i % 24), 0.1 * i + 0.0000000003) for i in range(300)]
    rows += rows[:40]  # equal rows; and invoices here span several days and customers
    txn = spark.createDataFrame(rows, "customer_id long, invoice string, invoice_dt timestamp_ntz, revenue double")
    amounts = features.invoice_amounts(txn)
    assert amounts.count() < txn.count()
    for build in (features.invoices, lambda t: features.customer_features(t, CUTOFF)):
        assert sorted(map(tuple, build(amounts).collect())) == sorted(map(tuple, build(txn).collect()))


def test_duplicates_need_no_shuffle_of_their_own(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables too large for a broadcast are joined
    try:
        plan = txn_orders(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Exchange hashpartitioning") == 2  # the join's two sides


def test_shared_columns_change_no_rows(spark):
    raw = transactions_from_orders(spark, SF, descriptive=False)
    twice = raw.unionByName(raw)
    assert cleaning.clean_transactions(twice).exceptAll(txn_orders(spark, SF)).isEmpty()
    assert cleaning.clean_transactions(twice).count() == txn_orders(spark, SF).count()


def test_churn_base_reads_line_items_once(spark, monkeypatch):
    cleaned, plain = [], features.invoice_amounts
    monkeypatch.setattr(features, "invoice_amounts", lambda txn: cleaned.append(txn) or plain(txn))
    inv, feats = queries_churn.churn_base(spark, SF)
    assert len(cleaned) == 1 and inv.count() and feats.count()
    for table in (inv, feats):
        assert "FileScan" not in table._jdf.queryExecution().executedPlan().toString()
