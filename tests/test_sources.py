"""Untyped CSV sources with provenance tags (S1, S3) and sinks."""

import pytest
import datetime as dt

from pyspark.sql import functions as F

from valuescope.operators import cleaning
from valuescope.sources import read_raw_transactions, write_parquet, write_report_csv


def test_csv_sources_union_with_tags(spark, tmp_path):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    a = tmp_path / "a.csv"
    b = tmp_path / "b.csv"
    a.write_text(header + "1,X,thing,2,2010-01-05 10:00:00,3.5,17850.0,UK\nC2,X,thing,-1,2010-01-06 10:00:00,3.5,17850,UK\n")
    b.write_text(header + "3,Y,other,1,2011-02-01 09:30:00,10,,France\n4,Y,other,1,bad,10,12345,France\n")
    raw = read_raw_transactions(spark, {"Year 2009-2010": str(a), "Year 2010-2011": str(b)})
    rows = {r["invoice"]: r for r in raw.collect()}
    assert rows["1"]["source_sheet"] == "Year 2009-2010" and rows["3"]["source_sheet"] == "Year 2010-2011"
    assert rows["1"]["invoice_dt"] == dt.datetime(2010, 1, 5, 10, 0) and rows["1"]["customer_id"] == 17850
    assert rows["3"]["customer_id"] is None and rows["4"]["invoice_dt"] is None
    clean = cleaning.clean_transactions(raw)
    assert [r["invoice"] for r in clean.collect()] == ["1"]
    wf = {r["rule"]: r["rows_removed"] for r in cleaning.cleaning_waterfall(raw).collect()}
    assert wf["cancelled_invoice"] == 1 and wf["missing_customer_id"] == 1 and wf["missing_invoice_dt"] == 1


def test_sinks_round_trip(spark, tmp_path):
    df = spark.range(5).select(F.col("id").alias("customer_id"), (F.col("id") * 1.5).alias("v"))
    write_parquet(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    write_report_csv(df, str(tmp_path / "r"))
    back = spark.read.option("header", True).csv(str(tmp_path / "r"))
    assert back.count() == 5 and back.rdd.getNumPartitions() == 1


def test_csv_columns_are_told_by_name(spark, tmp_path):
    from valuescope.schemas import RAW_TO_CANONICAL
    from valuescope.sources.transactions import read_raw_transactions

    names = list(RAW_TO_CANONICAL)
    row = {c: "" for c in names}
    by = {canon: src for src, canon in RAW_TO_CANONICAL.items()}
    row |= {by["invoice"]: "I1", by["stock_code"]: "S1", by["customer_id"]: "9007199254740993", by["invoice_dt"]: "12/1/2010 8:26"}
    swapped = [names[1], names[0], *names[2:]]
    p = tmp_path / "a.csv"
    p.write_text(",".join(swapped) + "\n" + ",".join(row[c] for c in swapped) + "\n")
    got = read_raw_transactions(spark, {"x": str(p)}).first()
    assert (got["invoice"], got["stock_code"], got["customer_id"]) == ("I1", "S1", 9007199254740993)
    assert str(got["invoice_dt"]) == "2010-12-01 08:26:00"
    q = tmp_path / "b.csv"
    q.write_text(",".join(names[:-1]) + "\n")
    with pytest.raises(ValueError, match="x: missing required columns"):
        read_raw_transactions(spark, {"x": str(q)})


def _sheet(spark, rows):
    names = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
    return spark.createDataFrame([(str(i), "s", "d", *r, "c") for i, r in enumerate(rows)], ", ".join(f"`{n}` string" for n in names))


def test_no_text_stops_the_batch_and_each_reject_has_a_reason(spark):
    from valuescope.operators import features
    from valuescope.sources import rejects, standardize

    good = ("2", "2010-12-01 08:26:15", "3.5", "7")
    cases = {
        ("Infinity", 1): "not_finite", ("-Infinity", 1): "not_finite", ("NaN", 1): "not_finite", ("1e30", 1): "out_of_range", ("-1e10", 1): "out_of_range", ("free", 1): "not_a_number",
    }
    rows = [good] + [(good[0], good[1], text, good[3]) for text, _ in cases]
    rows += [("1.5", *good[1:]), ("99999999999", *good[1:]), ("1e400", *good[1:]), ("two", *good[1:]), (" 3 ", *good[1:]), ("", *good[1:])]
    rows += [(*good[:3], "12345678901234567890"), (*good[:3], "1e5"), (*good[:3], "x"), (good[0], "yesterday", *good[2:])]
    raw = _sheet(spark, rows)
    got = sorted((int(r["invoice"]), r["column"], r["reason"]) for r in rejects(raw, "t").collect())
    want = [(i + 1, "unit_price", reason) for i, reason in enumerate(cases.values())]
    want += [(7, "quantity", "not_whole"), (8, "quantity", "out_of_range"), (9, "quantity", "not_finite"), (10, "quantity", "not_a_number")]
    want += [(13, "customer_id", "out_of_range"), (15, "customer_id", "not_a_number"), (16, "invoice_dt", "not_a_time")]
    assert got == sorted(want)
    clean = cleaning.clean_transactions(standardize(raw, "t"))
    assert sorted(r["invoice"] for r in clean.collect()) == ["0", "11", "14"]
    assert features.invoices(clean).count() == 3
    # typed sources meet the same rules
    typed = standardize(raw, "t").withColumn("unit_price", F.when(F.col("invoice") == "0", float("inf")).when(F.col("invoice") == "11", 1e30).otherwise(F.col("unit_price")))
    assert [r["invoice"] for r in cleaning.clean_transactions(typed).collect()] == ["14"]
    assert features.invoices(cleaning.clean_transactions(typed)).count() == 1


def test_time_forms(spark):
    from valuescope.sources import standardize

    forms = {
        "12/01/2010 08:26:15": dt.datetime(2010, 12, 1, 8, 26, 15), "12/1/10 8:26": dt.datetime(2010, 12, 1, 8, 26), "12/1/95 8:26": dt.datetime(1995, 12, 1, 8, 26),
        "12/1/2010": dt.datetime(2010, 12, 1), "12/1/10 8:26:07": dt.datetime(2010, 12, 1, 8, 26, 7), "2010-12-01T08:26:00+02:00": dt.datetime(2010, 12, 1, 6, 26),
        "2010-12-01T08:26:00Z": dt.datetime(2010, 12, 1, 8, 26), "2010-12-01 08:26:00-0530": None, "2010-12-01 08:26:00.25": dt.datetime(2010, 12, 1, 8, 26, 0, 250000),
        "2010-12-01": dt.datetime(2010, 12, 1), "13/13/2010 8:26": None, "": None,
    }
    raw = _sheet(spark, [("1", text, "1", "1") for text in forms])
    got = {int(r["invoice"]): r["invoice_dt"] for r in standardize(raw, "t").collect()}
    for i, (text, want) in enumerate(forms.items()):
        if text.endswith("-0530"):
            assert got[i] in (None, dt.datetime(2010, 12, 1, 13, 56))
        else:
            assert got[i] == want, text
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        again = {int(r["invoice"]): r["invoice_dt"] for r in standardize(raw, "t").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert again == got


def test_ordered_files_are_read_back_in_order(spark, tmp_path):
    from valuescope.sources import order_violations, read_ordered, write_ordered

    rows = [((i * 37) % 500 if i % 50 else None, f"r{i % 7}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, s string, i long").repartition(7)
    for path, most in ((f"{tmp_path}/a", 0), (f"{tmp_path}/b", 9)):
        write_ordered(df, path, ["k", "s", "i"], max_file_rows=most)
        back = read_ordered(spark, path).orderBy("position").collect()
        assert [r["position"] for r in back] == list(range(1, 501))
        assert [(r["k"], r["s"], r["i"]) for r in back] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert order_violations(spark, path, ["k", "s", "i"]).first()["violations"] == 0
    df.repartition(5, "s").write.parquet(f"{tmp_path}/c")
    found = order_violations(spark, f"{tmp_path}/c", ["k", "s", "i"]).first()
    assert found["rows"] == 500 and found["violations"] > 0
    write_ordered(df.limit(0), f"{tmp_path}/d", ["k"])
    assert read_ordered(spark, f"{tmp_path}/d").isEmpty()


def test_large_reports_are_refused_before_the_write(spark, tmp_path, monkeypatch):
    from valuescope.sources import sinks

    monkeypatch.setattr(sinks, "REPORT_ROW_LIMIT", 10)
    with pytest.raises(ValueError, match="more than 10 rows"):
        write_report_csv(spark.range(11).toDF("x"), f"{tmp_path}/r")
    assert not (tmp_path / "r").exists()
    write_report_csv(spark.range(10).toDF("x"), f"{tmp_path}/r")


def test_profiles_group_rows_once(spark):
    df = spark.createDataFrame([("1", "s", "d", 2, None, 3.0, 7, "c", "t")] * 3 + [("C2", "s", "d", -1, None, 0.0, None, "c", "t")], cleaning_schema())
    got = cleaning.profile_dataset(df).first().asDict()
    assert got == {"rows": 4, "unique_customers": 1, "missing_customer_id_rate": 0.25, "missing_invoice_dt_rate": 1.0, "nonpositive_price_rate": 0.25, "nonpositive_quantity_rate": 0.25, "cancellation_rate": 0.25, "duplicate_row_rate": 0.5}
    assert cleaning.basic_profile(df).first()["duplicate_row_rate"] == 0.5
    for table in (cleaning.profile_dataset(df), cleaning.basic_profile(df), cleaning.cleaning_waterfall(df)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
    empty = cleaning.profile_dataset(df.limit(0)).first()
    assert empty["rows"] == 0 and empty["unique_customers"] == 0 and empty["duplicate_row_rate"] is None


def cleaning_schema():
    from valuescope.schemas import TRANSACTIONS_RAW

    return TRANSACTIONS_RAW
