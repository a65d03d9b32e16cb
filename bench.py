"""Benchmark: headline queries + the whole batch pipeline on one SF directory.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list; default: the headline set below),
BENCH_PIPELINE_MODEL (churn model for the pipeline run; default "auto", the comparison of
four candidates over five folds).  ``control_sec`` times a fixed query that uses none of the
library, before and after the others, so that runs on different machines can be compared.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_features",
    "cleaning_waterfall",
    "invoices",
    "cohort_retention",
    "pareto_summary",
    "rfm_segments",
    "segment_summary",
    "calibration_summary",
    "clv_scores_fixed",
    "clv_decile_lift",
    "clv_spearman",
    "targeting_list",
    "roi_curve",
    "scenario_summary",
    "tornado",
    "churn_labels",
    "churn_risk_metrics",
    "clv_scores",
    "churn_scores",
]


def control(spark, sf_dir: str) -> float:
    """Seconds of an unchanging join, aggregate and sort over the supplied tables."""
    from pyspark.sql import functions as F

    t = time.time()
    li, o = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in ("lineitem", "orders"))
    joined = li.join(o.hint("shuffle_merge"), li.l_orderkey == o.o_orderkey)
    for k in range(3):
        by = joined.groupBy("o_custkey", (F.col("l_partkey") % (k + 7)).alias("part")).agg(F.sum("l_extendedprice").alias("s"), F.max("o_orderdate").alias("d"))
        by.orderBy("s").write.format("noop").mode("overwrite").save()
    return round(time.time() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    model = os.environ.get("BENCH_PIPELINE_MODEL", "auto")

    from valuescope.session import get_spark

    spark = get_spark(f"local[{cpus}]", app_name="valuescope-bench", shuffle_partitions=cpus,
                      extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    from valuescope.plans.catalog import load_all

    reg = load_all()
    control(spark, sf_dir)  # warm-up
    before = control(spark, sf_dir)
    times: dict[str, float] = {}
    for name in names:
        q = reg[name]
        t = time.time()
        q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    from valuescope.params import TESTDATA_PARAMS
    from valuescope.plans.pipeline import run_all
    from valuescope.sources import transactions_from_orders

    from valuescope.session import checkpoint_dir

    # outputs go under the session's shared checkpoint folder, never a machine-local temp dir
    out_dir = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"
    t = time.time()
    res = run_all(spark, transactions_from_orders(spark, sf_dir, descriptive=True), TESTDATA_PARAMS, out_dir,
                  churn_model=model)
    times["pipeline_end_to_end"] = round(time.time() - t, 3)
    stage_times = res["_timings"]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_end_to_end_plus_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "control_sec": [before, control(spark, sf_dir)],
        "pipeline_stages": stage_times,
        "pipeline_churn_model": model,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
