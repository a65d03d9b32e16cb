import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from valuescope.operators.ordered import average_rank, exact_quantiles, global_order, quantile_bin, quantile_bins


def _frame(spark, n, hot_frac=0.0, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = 7.0 if rnd.random() < hot_frac else round(rnd.gauss(0, 10), 1)
        rows.append((i * 3 + 1, v, rnd.choice(["a", "b", "c"])))
    return spark.createDataFrame(rows, "customer_id long, v double, g string")


@pytest.mark.parametrize("hot", [0.0, 0.35])
@pytest.mark.parametrize("desc", [False, True])
def test_row_number_and_prefix_match_plain_window(spark, hot, desc):
    df = _frame(spark, 3000, hot)
    got = global_order(df, "v", descending=desc, sums={"cs": F.col("v").cast("decimal(18,1)")},
                       rows_per_bucket=100)
    order = F.col("v").desc() if desc else F.col("v").asc()
    w = Window.orderBy(order, F.col("customer_id"))
    ref = df.withColumn("rn", F.row_number().over(w)).withColumn(
        "cs", F.sum(F.col("v").cast("decimal(18,1)")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    a = {r["customer_id"]: (r["rn"], r["cs"], r["n"]) for r in got.collect()}
    b = {r["customer_id"]: (r["rn"], r["cs"], 3000) for r in ref.collect()}
    assert a == b


def test_grouped_and_repartition_invariant(spark):
    df = _frame(spark, 2000, 0.3)
    w = Window.partitionBy("g").orderBy("v", "customer_id")
    ref = {r["customer_id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    for k in (1, 7, 64):
        got = global_order(df.repartition(k), "v", group="g", rows_per_bucket=50)
        assert {r["customer_id"]: r["rn"] for r in got.collect()} == ref


def test_quantile_bins_sizes(spark):
    for n, q in ((1, 4), (4, 4), (91, 10), (4933, 10)):
        df = spark.range(n).select(F.col("id").alias("customer_id"), (F.col("id") % 5).cast("double").alias("v"))
        got = quantile_bin(df, "v", q, "bin", rows_per_bucket=200)
        sizes = sorted(r["c"] for r in got.groupBy("bin").agg(F.count("*").alias("c")).collect())
        assert sum(sizes) == n
        assert max(sizes) - min(sizes) <= 1
    df = spark.range(4933).select(F.col("id").alias("customer_id"), F.col("id").cast("double").alias("v"))
    got = quantile_bin(df, "v", 10, "bin", rows_per_bucket=300)
    sizes = [r["c"] for r in got.groupBy("bin").agg(F.count("*").alias("c")).orderBy("bin").collect()]
    assert sizes == [494, 493, 493, 493, 494, 493, 493, 493, 493, 494]


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, 9.0), (5, 5.0)], "customer_id long, v double")
    got = {r["customer_id"]: r["r"] for r in average_rank(df, "v", "r", rows_per_bucket=1).collect()}
    assert got == {3: 1.0, 1: 3.0, 2: 3.0, 5: 3.0, 4: 5.0}


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rnd = random.Random(3)
    vals = [rnd.random() * 100 for _ in range(1001)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "customer_id long, v double")
    got = exact_quantiles(df, "v", [0.05, 0.5, 0.9, 0.99], rows_per_bucket=100).first()
    for p, name in ((0.05, "q5"), (0.5, "q50"), (0.9, "q90"), (0.99, "q99")):
        assert abs(got[name] - np.percentile(vals, p * 100)) < 1e-9


@pytest.mark.parametrize("rows_per_bucket", [40, 10_000])
def test_bins_from_cut_points_match_numbered_rows(spark, rows_per_bucket):
    for n, q in ((0, 4), (1, 4), (2, 4), (3, 10), (777, 10)):
        df = _frame(spark, n, 0.35).withColumn("u", -F.col("v"))
        got = quantile_bins(df, {"b1": "v", "b2": "u"}, q, rows_per_bucket=rows_per_bucket)
        one = {r["customer_id"]: r["b"] for r in quantile_bin(df, "v", q, "b").collect()}
        two = {r["customer_id"]: r["b"] for r in quantile_bin(df, "u", q, "b").collect()}
        rows = got.collect()
        assert {r["customer_id"]: r["b1"] for r in rows} == one
        assert {r["customer_id"]: r["b2"] for r in rows} == two


def test_average_rank_hot_values(spark):
    df = _frame(spark, 800, 0.5)
    for group in (None, "g"):
        part = [group] if group else []
        w = Window.partitionBy(*part, "v")
        ref = df.withColumn("r", F.rank().over(Window.partitionBy(*part).orderBy("v")) + (F.count(F.lit(1)).over(w) - 1) / 2.0)
        got = average_rank(df, "v", "r", group=group, rows_per_bucket=50)
        assert {r["customer_id"]: r["r"] for r in got.collect()} == {r["customer_id"]: r["r"] for r in ref.collect()}


def test_two_levels_of_splits_equal_a_plain_window(spark, monkeypatch):
    from valuescope.operators import ordered

    monkeypatch.setattr(ordered, "MAX_BUCKETS", 64)
    df = spark.range(20_000).select(F.col("id").alias("customer_id"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.hash("id"), F.lit(1000)).cast("double")).alias("v"), (F.col("id") % 2).alias("g"))
    buckets = ordered._bucketed(df, "v", "customer_id", "g", 10)
    sizes = [r["n"] for r in buckets.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 1000 and max(sizes) <= 100
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "customer_id"))).withColumn("s", F.sum("v").over(Window.partitionBy("g").orderBy("v", "customer_id").rowsBetween(Window.unboundedPreceding, 0)))
    got = global_order(df, "v", group="g", sums={"s": F.col("v")}, rows_per_bucket=10)
    assert {(r["customer_id"], r["rn"], r["s"]) for r in got.collect()} == {(r["customer_id"], r["rn"], r["s"]) for r in ref.collect()}
    rank = average_rank(df, "v", "r", group="g", rows_per_bucket=10)
    w = Window.partitionBy("g", "v")
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy("v")) + (F.count(F.lit(1)).over(w) - 1) / 2.0)
    assert {(r["customer_id"], r["r"]) for r in rank.collect()} == {(r["customer_id"], r["r"]) for r in ref.collect()}


def test_average_rank_joins_nothing_on_the_value(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = average_rank(_frame(spark, 800, 0.5), "v", "r", rows_per_bucket=50)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert average_rank(spark.createDataFrame([(1, None), (2, 3.0)], "customer_id long, v double"), "v", "r").collect()[0]["r"] == 1.0
