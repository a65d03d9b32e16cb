"""The whole weekly batch (G6) as one Spark application.

Steps hand over lazily inside one session; the plan is cut only where a
table is reused by many later jobs: cleaned line items, invoices,
customer features, CLV scores and churn scores are written as Parquet
datasets under ``out_dir`` and read back (a lineage cut that also makes
the outputs the step contract, as in the original pipeline).
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.operators import btyd, churn, cleaning, cohorts, concentration, features, metrics, policy
from valuescope.operators import scenarios, segments, spend
from valuescope.params import Params
from valuescope.plans.materialize import materialize
from valuescope.sources.sinks import save_model, write_ordered, write_parquet, write_report_csv


def _stage(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    write_parquet(df, path, partition_by)
    return spark.read.parquet(path)


def _ordered_stage(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    write_ordered(df, path, keys)
    return spark.read.parquet(path)


def run_all(spark: SparkSession, raw: DataFrame, params: Params, out_dir: str,
            churn_model: str = "auto", write_reports: bool = True, report_parallelism: int = 4) -> dict:
    """Run ingest -> clean -> features -> CLV -> churn -> budget -> backtest ->
    segments -> cohorts -> insights -> sensitivity.  Returns the output tables."""
    p = params
    t0 = time.time()
    timings: dict[str, float] = {}
    out: dict[str, DataFrame] = {}

    def mark(name):
        timings[name] = round(time.time() - t0 - sum(timings.values()), 3)

    # 1-2 ingest + clean (profiles are one-pass aggregates)
    out["ingest_profile"] = cleaning.basic_profile(raw)
    txn = _ordered_stage(spark, cleaning.clean_transactions(raw), f"{out_dir}/transactions_clean", ["customer_id", "invoice_dt", "invoice"])
    out["cleaning_waterfall"] = cleaning.cleaning_waterfall(raw)
    mark("clean")

    # 3 features
    feats = _stage(spark, features.customer_features(txn, p.cutoff), f"{out_dir}/customer_features")
    features.assert_feature_contracts(feats)
    out["customer_features"] = feats
    mark("features")

    # 4 CLV
    inv = _stage(spark, features.invoices(txn), f"{out_dir}/invoices")
    hend = features.resolve_holdout_end(inv, p.cutoff, p.holdout_days)
    summary = btyd.calibration_holdout(inv, p.cutoff, hend)
    bg, bg_info = btyd.fit_bgnbd(summary, p.penalizer_bgnbd)
    gg, gg_info = spend.fit_gamma_gamma(inv, p.cutoff, p.penalizer_gg)
    status = (bool(bg_info["converged"]), bool(gg_info["converged"]), bool(gg_info.get("gg_mean_undefined")))
    if status != (True, True, False) and not p.allow_unusable_fit:
        raise RuntimeError(f"CLV fit not usable: BG/NBD converged {status[0]}, Gamma-Gamma converged {status[1]}, mean undefined {status[2]}")
    clv = _stage(spark, spend.score_clv(inv, summary, bg, gg, p.cutoff, hend, p.clv_horizon_days,
                                        p.discount_rate_annual, penalizer_bgnbd=p.penalizer_bgnbd,
                                        penalizer_gg=p.penalizer_gg), f"{out_dir}/clv_scores")
    out["clv_scores"] = clv
    out["clv_params"] = spark.createDataFrame(
        [(bg.r, bg.alpha, bg.a, bg.b, gg.p, gg.q, gg.v, *status)],
        "r double, alpha double, a double, b double, p double, q double, v double, "
        "bgnbd_converged boolean, gg_converged boolean, gg_mean_undefined boolean")
    mark("clv")

    # 5 churn
    ch = churn.train_and_evaluate(inv, feats, p.cutoff, p.prediction_horizon_days, p.inactivity_days,
                                  p.eval_gap_days, model=churn_model, k=p.n_folds, seed=p.seed)
    risk = _stage(spark, ch["scores"], f"{out_dir}/churn_scores")
    out["churn_scores"] = risk
    out["churn_holdout_metrics"] = ch["holdout_metrics"]
    out["feature_importance"] = ch["importance"]
    if ch["comparison"] is not None:
        out["model_comparison"] = ch["comparison"]
    save_model(ch["model"], f"{out_dir}/churn_model")
    mark("churn")

    # 6 budget allocation
    policy.validate_config(p.budget, p.unit_cost, p.retention_effectiveness, p.min_clv)
    joined = policy.join_scores(clv, risk)
    econ = policy.build_economics(joined, p.unit_cost, p.retention_effectiveness, p.min_clv)
    selected = policy.select_targets(econ, p.budget, "exact" if p.solver == "exact" else "greedy")
    targeting = _ordered_stage(spark, policy.targeting_list(selected), f"{out_dir}/targeting_list", policy.TARGETING_ORDER)
    out["targeting_list"] = targeting
    out["allocation_summary"] = policy.allocation_summary(selected)
    mark("budget")

    # 7 backtest
    act = btyd.holdout_actuals(inv, p.cutoff, p.cutoff + dt.timedelta(days=p.holdout_days), include_start=True)
    ev = clv.select("customer_id", "clv_horizon").join(act, "customer_id", "left").select(
        "customer_id", "clv_horizon", F.coalesce("holdout_revenue", F.lit(0.0)).alias("holdout_revenue"))
    bins = materialize(metrics.binned(ev, q=p.n_deciles))
    ci = metrics.bootstrap_decile_ci(bins, n_boot=p.n_bootstrap, ci_level=p.ci_level, seed=p.seed, q=p.n_deciles)
    out["decile_lift"] = metrics.decile_lift(bins, q=p.n_deciles, ci=ci)
    sp = metrics.spearman(ev, "clv_horizon", "holdout_revenue")
    unit_cost = policy.median_cost(targeting).first()["unit_cost"] or p.unit_cost
    pol = policy.policy_frame(policy.join_scores(clv, risk, validate=False), unit_cost, p.retention_effectiveness)
    out["roi_curve"] = policy.roi_curve(pol, policy.budget_grid(pol, unit_cost, p.n_budget_points, p.max_curve_budget,
                                                                 p.max_curve_customers))
    n_clv = clv.agg(F.count(F.lit(1)).alias("customers_scored_clv"))
    n_risk = risk.agg(F.count(F.lit(1)).alias("customers_scored_risk"))
    out["executive_summary"] = sp.join(n_clv, how="inner").join(n_risk, how="inner").select(  # 1-row each
        F.lit(p.cutoff.date()).alias("cutoff_date"), F.lit(p.holdout_days).alias("holdout_days"),
        F.round("spearman", 4).alias("spearman_clv_vs_holdout_revenue"), "customers_scored_clv",
        "customers_scored_risk", F.lit(float(unit_cost)).alias("unit_cost_assumed"),
        F.lit(float(p.retention_effectiveness)).alias("retention_effectiveness_assumed"))
    mark("backtest")

    # 8 segments
    seg = segments.build_segments(feats, clv, risk)
    out["customer_segments"] = _stage(spark, seg, f"{out_dir}/customer_segments")
    out["segment_summary"] = segments.segment_summary(out["customer_segments"])
    mark("segments")

    # 9 cohorts
    out["cohort_retention"] = cohorts.retention_matrix(txn, p.max_months, p.min_cohort_size)
    out["cohort_revenue"] = cohorts.cohort_revenue(txn, p.min_cohort_size)
    mark("cohorts")

    # 10 insights
    out["pareto_summary"] = concentration.pareto_summary(feats)
    out["monthly_revenue"] = concentration.monthly_revenue(txn)
    mark("insights")

    # 11 sensitivity
    base = scenarios.base_values(joined)
    bud = scenarios.sensitivity_budgets(base, p.unit_cost, p.n_budget_points, p.max_sensitivity_budget).select("budget")
    sc = scenarios.draw_scenarios(spark, p.n_scenarios, p.effectiveness_range, p.cost_range, p.seed)
    out["sensitivity_summary"] = scenarios.monte_carlo_summary(scenarios.scenario_roi(base, sc, bud))
    out["sensitivity_tornado"] = scenarios.tornado(base, p.reference_budget, p.retention_effectiveness,
                                                   p.unit_cost, p.variation)
    mark("sensitivity")

    if write_reports:
        # the report tables are independent, small jobs: submit them from a
        # few driver threads so their scheduling overheads overlap
        from concurrent.futures import ThreadPoolExecutor

        names = ["ingest_profile", "cleaning_waterfall", "decile_lift", "roi_curve", "executive_summary",
                 "segment_summary", "cohort_retention", "cohort_revenue", "pareto_summary", "monthly_revenue",
                 "sensitivity_summary", "sensitivity_tornado", "allocation_summary", "feature_importance",
                 "churn_holdout_metrics", "clv_params"] + (["model_comparison"] if "model_comparison" in out else [])
        with ThreadPoolExecutor(max_workers=report_parallelism) as pool:
            list(pool.map(lambda n: write_report_csv(out[n], f"{out_dir}/reports/{n}"), names))
        mark("reports")
    out["_timings"] = timings
    return out
