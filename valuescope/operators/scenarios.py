"""ROI under uncertain effectiveness and cost.

A scenario (effectiveness e, unit cost c) at budget B targets the
customers whose base value clv x p exceeds c/e, best first, up to
floor(B/c) of them.  The ordering by base never depends on (e, c), so
customers are ranked ONCE; every (scenario, budget) pair then needs only
(1) the number of customers above its threshold and (2) a prefix sum at
one rank.  (1) comes from a single ordered pass over distinct base values
merged with the thresholds; (2) from a join on rank with the
(scenario x budget) table broadcast -- that table is sized by the
parameters (draws x budget points), not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.functions import md5_uniform
from valuescope.operators.common import attach_one_row
from valuescope.operators.ordered import global_order

EXACT_SUM = "decimal(30,10)"
_BELOW_ALL_IDS = -(2**63)


def base_values(scores: DataFrame) -> DataFrame:
    """customer_id, base = clv x churn probability (rows with NULLs dropped: F14)."""
    s = scores.na.drop(subset=["clv_horizon", "churn_probability"])
    return s.select("customer_id", (F.col("clv_horizon") * F.col("churn_probability")).alias("base"))


def draw_scenarios(spark, n: int, eff_range=(0.05, 0.25), cost_range=(1.0, 5.0), seed: int = 42) -> DataFrame:
    """Seeded uniform (effectiveness, cost) draws from md5 -- reproducible anywhere."""
    ids = spark.range(n).select(F.col("id").alias("scenario_id"))
    ue = md5_uniform(F.lit(seed), F.lit("eff"), F.col("scenario_id"))
    uc = md5_uniform(F.lit(seed), F.lit("cost"), F.col("scenario_id"))
    return ids.select(
        "scenario_id",
        (F.lit(eff_range[0]) + (eff_range[1] - eff_range[0]) * ue).alias("effectiveness"),
        (F.lit(cost_range[0]) + (cost_range[1] - cost_range[0]) * uc).alias("unit_cost"),
    )


def linspace_budgets(spark, start: float, stop: float, points: int) -> DataFrame:
    """Budget levels start..stop (inclusive), ``points`` of them."""
    i = spark.range(points).select(F.col("id").cast("int").alias("i"))
    step = (stop - start) / (points - 1) if points > 1 else 0.0
    return i.select(
        F.when(F.col("i") == points - 1, F.lit(float(stop))).otherwise(F.lit(float(start)) + F.col("i") * F.lit(step))
        .alias("budget")
    )


def sensitivity_budgets(base: DataFrame, unit_cost: float, points: int = 12,
                        max_budget: float | None = None) -> DataFrame:
    """B7 (sensitivity form): from 10 x cost to 0.7 x n x cost, at most ``max_budget`` if given."""
    n = base.agg(F.count(F.lit(1)).alias("n"))
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    lo = F.lit(float(unit_cost) * 10.0)
    hi = F.col("n") * float(unit_cost) * 0.7
    hi = hi if max_budget is None else F.least(hi, F.lit(float(max_budget)))
    g = n.select(lo.alias("lo"), hi.alias("hi"), i)
    b = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(
        F.col("lo") + F.col("i") * ((F.col("hi") - F.col("lo")) / (points - 1)))
    return g.select(F.col("i").alias("budget_idx"), b.alias("budget"))


def scenario_roi(base: DataFrame, scenarios: DataFrame, budgets: DataFrame) -> DataFrame:
    """B8 for every (scenario, budget): targeted count, cost, benefit, net gain, ROI."""
    # (2) customers ranked once by base, descending, with exact prefix sums
    ranked = global_order(base, "base", descending=True, n=None,
                          sums={"_cum": F.col("base").cast(EXACT_SUM)})
    # (1) eligible counts: distinct base values merged with thresholds c/e in
    # one descending pass; at a threshold row the running customer count is
    # #{base > threshold} (thresholds sort before equal base values).
    dv = base.groupBy("base").agg(F.count(F.lit(1)).alias("_cnt"))
    th = scenarios.select("scenario_id", (F.col("unit_cost") / F.col("effectiveness")).alias("_t"))
    merged = dv.select(F.col("base").alias("_key"), F.col("_cnt"), F.lit(1).alias("_kind"),
                       F.lit(None).cast("bigint").alias("scenario_id")).unionByName(
        th.select(F.col("_t").alias("_key"), F.lit(0).cast("bigint").alias("_cnt"), F.lit(0).alias("_kind"),
                  "scenario_id"))
    counted = global_order(merged, "_key", tie="_kind", descending=True, n=None, rn="_r",
                           sums={"_above": F.col("_cnt")})
    n_elig = counted.filter(F.col("_kind") == 0).select("scenario_id", F.col("_above").alias("n_eligible"))
    grid = scenarios.join(n_elig, "scenario_id", "inner").join(budgets, how="inner")  # draws x budget points
    grid = grid.select(
        "*",
        F.when(F.col("budget") > 0,
               F.least(F.floor(F.col("budget") / F.col("unit_cost")), F.col("n_eligible"))).otherwise(F.lit(0))
        .cast("bigint").alias("k"),
    )
    # wanted ranks (draws x budget points at most) travel to the ranked customers, their hits travel back
    found = ranked.select(F.col("rn").alias("k"), "_cum").join(F.broadcast(grid.select("k").distinct()), "k")
    hit = grid.join(F.broadcast(found), "k", "left")
    spent = F.col("k") * F.col("unit_cost")
    benefit = F.col("effectiveness") * F.coalesce(F.col("_cum").cast("double"), F.lit(0.0))
    net = F.when(F.col("k") > 0, benefit - spent).otherwise(F.lit(0.0))
    return hit.select(
        *[c for c in grid.columns if c not in ("k",)],
        F.col("k").alias("n_targeted"),
        F.when(F.col("k") > 0, spent).otherwise(F.lit(0.0)).alias("total_cost"),
        net.alias("net_gain"),
        F.when(F.col("k") > 0, (benefit - spent) / spent).otherwise(F.lit(0.0)).alias("roi"),
    )


def monte_carlo_summary(roi: DataFrame) -> DataFrame:
    """p5/p50/p95 of ROI and net gain per budget (groups of n_scenarios rows)."""
    return roi.groupBy("budget").agg(
        *[F.round(F.percentile("roi", q), 6).alias(f"roi_p{int(q * 100)}") for q in (0.05, 0.5, 0.95)],
        *[F.round(F.percentile("net_gain", q), 6).alias(f"net_gain_p{int(q * 100)}") for q in (0.05, 0.5, 0.95)],
    )


def tornado(base: DataFrame, reference_budget: float, effectiveness: float, unit_cost: float,
            variation: float = 0.5) -> DataFrame:
    """ROI at base, low and high value of each parameter (one at a time);
    cost low value floored at 0.1; swing = |high - low|."""
    spark = base.sparkSession
    e_lo, e_hi = effectiveness * (1 - variation), effectiveness * (1 + variation)
    c_lo, c_hi = max(unit_cost * (1 - variation), 0.1), unit_cost * (1 + variation)
    rows = [(0, effectiveness, unit_cost), (1, e_lo, unit_cost), (2, e_hi, unit_cost),
            (3, effectiveness, c_lo), (4, effectiveness, c_hi)]
    sc = spark.createDataFrame(rows, "scenario_id long, effectiveness double, unit_cost double")
    bud = spark.createDataFrame([(float(reference_budget),)], "budget double")
    r = scenario_roi(base, sc, bud).select("scenario_id", "roi")
    piv = r.groupBy().pivot("scenario_id", [0, 1, 2, 3, 4]).agg(F.first("roi"))
    params = spark.createDataFrame(
        [("retention_effectiveness", effectiveness, e_lo, e_hi, "1", "2"),
         ("unit_cost", unit_cost, c_lo, c_hi, "3", "4")],
        "parameter string, base_value double, low_value double, high_value double, lo string, hi string")
    j = attach_one_row(params, piv)
    lo = F.when(F.col("lo") == "1", F.col("1")).otherwise(F.col("3"))
    hi = F.when(F.col("hi") == "2", F.col("2")).otherwise(F.col("4"))
    return j.select(
        "parameter", "base_value", "low_value", "high_value",
        F.round(F.col("0"), 6).alias("roi_at_base"), F.round(lo, 6).alias("roi_at_low"),
        F.round(hi, 6).alias("roi_at_high"), F.round(F.abs(hi - lo), 6).alias("roi_swing"),
    )
