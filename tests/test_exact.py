"""Amounts below a cent, uncapped series, NULL groups, unequal costs, one class."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuescope.functions import money_sum
from valuescope.operators import metrics, policy
from valuescope.operators.btyd import expected_purchases, hyp2f1
from valuescope.operators.ordered import global_order


def test_money_keeps_parts_of_a_cent(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (1.2345,)], "revenue double")
    assert df.agg(money_sum("revenue")).first()[0] == 1.2465


def test_prefix_sums_keep_ten_digits(spark):
    df = spark.createDataFrame([(i, 0.0000000001) for i in range(1, 6)], "customer_id long, v double")
    out = global_order(df, "customer_id", sums={"cum": F.col("v").cast("decimal(30,10)")}, rows_per_bucket=2)
    assert sorted(str(r["cum"] * 10**10).split(".")[0] for r in out.collect()) == list("12345")


def _series(a, b, c, z, n=400_000):
    k = np.arange(n - 1, dtype=float)
    ratio = (a + k) * (b + k) / ((c + k) * (k + 1)) * z
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.abs(ratio)))])
    return math.fsum((np.concatenate([[1.0], np.cumprod(np.sign(ratio))]) * np.exp(logs)).tolist())


@pytest.mark.parametrize("a, b", [(2.0, -0.3), (0.5, 0.7), (7.2, 0.4)])
def test_hypergeometric_matches_long_series(spark, a, b):
    rows = [(a + 0.5 + x, z) for x in (0.0, 3.0, 9.0, 40.0, 300.0) for z in (0.3, 0.9, 0.99, 0.9999)]
    df = spark.createDataFrame(rows, "c double, z double")
    for r in df.select("c", "z", hyp2f1(a, b, F.col("c"), F.col("z")).alias("f")).collect():
        assert r["f"] == pytest.approx(_series(a, b, r["c"], r["z"]), rel=1e-9)


def test_expected_purchases_near_a_one(spark):
    df = spark.createDataFrame([(3.0, 40.0, 100.0)], "frequency_cal double, recency_cal double, T_cal double")
    at = [df.select(expected_purchases({"r": 0.243, "alpha": 4.414, "a": 1.0 + d, "b": 2.426}, 180.0)).first()[0]
          for d in (-2e-5, -1e-6, 0.0, 1e-6, 2e-5)]
    slope = (at[4] - at[0]) / 4e-5
    for d, v in zip((-1e-6, 0.0, 1e-6), at[1:4]):
        assert v == pytest.approx((at[0] + at[4]) / 2 + slope * d, abs=1e-9)


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "customer_id long, g string")
    got = {r["customer_id"]: (r["rn"], r["n"]) for r in global_order(df, "customer_id", group="g").collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (2, 2)}
    split = global_order(df, "customer_id", group="g", rows_per_bucket=1).collect()
    assert {r["customer_id"]: r["rn"] for r in split} == {1: 1, 2: 1, 3: 2}


def _sequential(rows, budget):
    taken, left = set(), budget
    for cid, gain, cost in sorted(rows, key=lambda r: (-r[1] / r[2], r[0])):
        if cost <= left:
            taken.add(cid)
            left -= cost
    return taken


@pytest.mark.parametrize("rows, budget", [
    ([(1, 10.0, 1.0), (2, 50.0, 6.0), (3, 5.0, 1.0), (4, 4.0, 1.0)], 3.0),
    ([(i, float(100 - (i * 37) % 90), float(1 + (i * 13) % 7)) for i in range(1, 40)], 45.0),
    ([(1, 5.0, 4.0)], 3.0),
])
def test_greedy_passes_over_misfits(spark, rows, budget):
    df = spark.createDataFrame(rows, "customer_id long, net_gain double, cost double")
    econ = df.withColumn("eligible", F.lit(True))
    out = policy.select_targets(econ, budget, "greedy")
    assert {r["customer_id"] for r in out.filter("target").collect()} == _sequential(rows, budget)


def test_one_class_gives_null_rates(spark):
    df = spark.createDataFrame([(1, 1, 0.2), (2, 1, 0.7)], "customer_id long, y int, p double")
    points = metrics.roc_pr_points(df, "y", "p")
    assert [r["fpr"] for r in points.collect()] == [None, None]
    assert metrics.curve_areas(points).first()["roc_area"] is None


def test_rank_lookup_does_not_shuffle_the_ranked_customers(spark):
    scores = spark.range(200).select(F.col("id").alias("customer_id"), (F.col("id") * 1.0 + 50).alias("clv_horizon"),
                                     F.lit(0.5).alias("churn_probability"))
    pol = policy.policy_frame(scores, 2.0, 0.1)
    grid = policy.budget_grid(pol, 2.0)
    curve = policy.roi_curve(pol, grid)
    assert "SortMergeJoin" not in curve._jdf.queryExecution().executedPlan().toString()
    assert curve.agg(F.max("budget")).first()[0] == 2.0 * pol.count()
