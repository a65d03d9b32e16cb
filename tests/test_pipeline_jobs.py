"""The whole batch with the comparison of all models: its jobs don't follow the boosted trees."""

import datetime as dt

from pyspark.sql import functions as F

from valuescope.operators import churn
from valuescope.params import Params
from valuescope.plans.pipeline import run_all
from valuescope.sources import load_model


def test_batch_compares_all_models_without_a_job_for_each_tree_level(spark, tmp_path):
    """Ten boosted fits of 300 trees of depth 5 were more than 10,000 jobs."""
    draw = lambda k: F.abs(F.xxhash64(F.lit(k), "id")) % 1009
    day = F.date_add(F.lit(dt.date(2010, 1, 1)), (draw(1) * 700 / 1009).cast("int"))
    raw = spark.range(0, 3000, numPartitions=2).select(
        F.concat(F.lit("I"), (F.col("id") / 2).cast("long")).alias("invoice"), F.concat(F.lit("S"), draw(2) % 30).alias("stock_code"), F.lit("x").alias("description"),
        (draw(3) % 9 + 1).alias("quantity"), day.cast("timestamp_ntz").alias("invoice_dt"), (draw(4) / 50.0 + 0.5).alias("unit_price"),
        ((F.col("id") / 2).cast("long") * 7 % 211 + 1).alias("customer_id"), F.lit("UK").alias("country"), F.lit("s").alias("source_sheet"))
    spark.range(1).collect()
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None))
    out = run_all(spark, raw, Params().with_(allow_unusable_fit=True, n_bootstrap=20, n_scenarios=20), str(tmp_path), write_reports=False)
    compared = {r["model"]: r for r in out["model_comparison"].collect()}
    assert set(compared) == set(churn.CANDIDATES) and all(r["cv_folds"] == 5 for r in compared.values())
    best = max(compared, key=lambda name: compared[name]["cv_roc_auc_mean"])
    assert {r["model_used"] for r in out["churn_scores"].select("model_used").distinct().collect()} == {best}
    scores = churn.score_with(load_model(f"{tmp_path}/churn_model"), out["customer_features"])
    assert scores.count() == out["churn_scores"].count() > 150
    assert max(tracker.getJobIdsForGroup(None)) - before < 1500
