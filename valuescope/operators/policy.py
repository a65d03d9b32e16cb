"""Budgeted retention targeting and ROI.

With one unit cost for every customer, an exact 0/1 knapsack, greedy by
net gain and greedy by gain per cost all select the same set: the top
floor(budget / cost) eligible customers by net gain.  Selection is
therefore a distributed rank plus a filter -- no solver, no row loop.
For per-customer costs the greedy rule passes over whoever no longer fits,
in rounds of prefix sums.
"""

from __future__ import annotations

import math
from decimal import ROUND_DOWN, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuescope.functions import clamp
from valuescope.operators.common import attach_one_row, require_single_key
from valuescope.operators.ordered import global_order

EXACT_SUM = "decimal(30,10)"  # prefix sums of benefits: exact and order-free
COST_UNIT = Decimal("1e-10")  # the least difference that EXACT_SUM tells
TARGETING_ORDER = ["recommended_action", "priority_rank", "customer_id"]


def validate_config(budget: float, unit_cost: float, effectiveness: float, min_clv: float) -> None:
    """B2."""
    if budget <= 0:
        raise ValueError("budget must be positive")
    if unit_cost <= 0:
        raise ValueError("unit_cost must be positive")
    if not 0 <= effectiveness <= 1:
        raise ValueError("retention_effectiveness must be in [0, 1]")
    if min_clv < 0:
        raise ValueError("min_clv must be non-negative")


def join_scores(clv: DataFrame, risk: DataFrame, validate: bool = True) -> DataFrame:
    """CLV inner-joined with churn risk; optional one-to-one check on both sides."""
    if validate:
        require_single_key(clv, "customer_id", "clv")
        require_single_key(risk, "customer_id", "risk")
    cols = ["customer_id", "churn_probability"] + (["risk_band"] if "risk_band" in risk.columns else [])
    return clv.select("customer_id", "clv_horizon").join(risk.select(*cols), "customer_id", "inner")


def expected_benefit(clv: Column, p: Column, effectiveness) -> Column:
    eff = effectiveness if isinstance(effectiveness, Column) else F.lit(float(effectiveness))
    return clamp(clv, lower=0.0) * clamp(p, 0.0, 1.0) * eff


def build_economics(scores: DataFrame, unit_cost: float, effectiveness: float, min_clv: float = 0.0) -> DataFrame:
    """B1 + F11: cost, expected benefit, net gain; rows with clv < min or
    churn <= 0 dropped; ``eligible`` = net gain > 0."""
    b = expected_benefit(F.col("clv_horizon"), F.col("churn_probability"), effectiveness)
    out = scores.select("*", F.lit(float(unit_cost)).alias("cost"), b.alias("expected_benefit"))
    out = out.withColumn("net_gain", F.col("expected_benefit") - F.col("cost"))
    out = out.filter((F.col("clv_horizon") >= float(min_clv)) & (F.col("churn_probability") > 0))
    return out.withColumn("eligible", F.col("net_gain") > 0)


def select_targets(econ: DataFrame, budget: float, solver: str = "exact") -> DataFrame:
    """Adds ``target`` and ``priority_rank`` (1.. by net gain among targets, else 0)."""
    elig = econ.filter("eligible")
    if solver == "exact":
        costs = econ.agg(F.min("cost").alias("mn"), F.max("cost").alias("mx")).first()
        if costs["mn"] is not None and costs["mn"] != costs["mx"]:
            raise ValueError("exact selection needs one unit cost; use solver='greedy'")
        cap = math.floor(budget / costs["mx"]) if costs["mx"] else 0
        ranked = global_order(elig.select("customer_id", "net_gain"), "net_gain", descending=True, n=None)
        chosen = ranked.filter(F.col("rn") <= cap).select("customer_id", F.col("rn").alias("priority_rank"))
    elif solver == "greedy":
        picked = take_while_affordable(elig, budget)
        chosen = global_order(picked.select("customer_id", "net_gain"), "net_gain", descending=True, n=None) \
            .select("customer_id", F.col("rn").alias("priority_rank"))
    else:
        raise ValueError(f"unknown solver {solver}")
    out = econ.join(chosen, "customer_id", "left")
    return out.select(
        *[c for c in econ.columns],
        F.col("priority_rank").isNotNull().alias("target"),
        F.coalesce(F.col("priority_rank"), F.lit(0)).cast("bigint").alias("priority_rank"),
    )


def take_while_affordable(elig: DataFrame, budget: float) -> DataFrame:
    """Best gain per cost first; whoever costs more than what is left is passed over.

    A round looks at the customers behind the last one decided who cost at most
    what is left, in two cost classes: up to half of what is left, and above.
    Those of the lower class are affordable as long as half is left, so a prefix sum over
    them alone decides who is taken, until they have spent half, or until
    the first of the upper class who still fits is met and taken. Either way less than
    half is left, so there are at most log2(budget / lowest cost) + 1 rounds
    whatever the order of costs. Only a few numbers a round are held.
    """
    ratio = F.col("net_gain") / F.col("cost")
    exact = F.col("cost").cast(EXACT_SUM)
    ranked = global_order(elig.select("customer_id", "net_gain", "cost", ratio.alias("_ratio")), "_ratio",
                          descending=True, n=None).checkpoint(eager=True)
    cheapest = ranked.agg(F.min(exact)).first()[0]
    left, after = Decimal(str(budget)), 0
    taken = F.lit(False)
    while cheapest is not None and left >= cheapest:
        half = (left / 2).quantize(COST_UNIT, rounding=ROUND_DOWN)
        limit, middle = (F.lit(str(v)).cast(EXACT_SUM) for v in (left, half))
        low = exact <= middle
        rows = ranked.filter((F.col("rn") > after) & (exact <= limit))
        rows = global_order(rows, "rn", n=None, rn="_place", sums={"_cum": F.when(low, exact).otherwise(F.lit(0).cast(EXACT_SUM))})
        first = rows.agg(F.min(F.when(~low & (exact + F.col("_cum") <= limit), F.struct("rn", exact.alias("cost"), "_cum"))).alias("fits"),
                         F.min(F.when(low & (F.col("_cum") > limit - middle), F.struct("rn", "_cum"))).alias("half_spent")).first()
        fits, crossing = first["fits"], first["half_spent"]
        if crossing is not None and fits is not None and fits["rn"] > crossing["rn"]:
            fits = None
        end = fits["rn"] if fits is not None else crossing["rn"] if crossing is not None else None
        upto = F.lit(True) if end is None else F.col("rn") <= end
        taken = taken | ((F.col("rn") > after) & upto & low)
        if fits is not None:
            taken = taken | (F.col("rn") == end)
            left -= fits["_cum"] + fits["cost"]
        elif crossing is not None:
            left -= crossing["_cum"]
        else:
            break
        after = end
    return ranked.filter(taken)


def targeting_list(selected: DataFrame) -> DataFrame:
    """The persisted targeting table (``TARGETING_ORDER`` at write time: O2)."""
    return selected.select(
        "customer_id",
        F.when(F.col("target"), "target").otherwise("no_action").alias("recommended_action"),
        "priority_rank",
        *(["risk_band"] if "risk_band" in selected.columns else []),
        "churn_probability", "clv_horizon", "cost", "expected_benefit", "net_gain",
    )


def allocation_summary(selected: DataFrame) -> DataFrame:
    """Totals over targeted rows (zeros when nothing is targeted); one row."""
    t = F.col("target")
    z = F.lit(0.0)
    return selected.agg(
        F.count(F.lit(1)).cast("double").alias("customers_total"),
        F.sum(F.col("eligible").cast("int")).cast("double").alias("customers_eligible"),
        F.sum(t.cast("int")).cast("double").alias("customers_targeted"),
        F.coalesce(F.sum(F.when(t, F.col("cost").cast(EXACT_SUM))).cast("double"), z).alias("total_cost"),
        F.coalesce(F.sum(F.when(t, F.col("expected_benefit").cast(EXACT_SUM))).cast("double"), z)
        .alias("total_expected_benefit"),
        F.coalesce(F.sum(F.when(t, F.col("net_gain").cast(EXACT_SUM))).cast("double"), z).alias("total_net_gain"),
        F.coalesce(F.avg(F.when(t, F.col("churn_probability"))), z).alias("avg_churn_probability_targeted"),
        F.coalesce(F.avg(F.when(t, F.col("clv_horizon"))), z).alias("avg_clv_targeted"),
    )


def policy_frame(scores: DataFrame, unit_cost: float, effectiveness: float) -> DataFrame:
    """B1 + F12 (backtest form): economics of customers with positive net gain."""
    b = expected_benefit(F.col("clv_horizon"), F.col("churn_probability"), effectiveness)
    out = scores.select("customer_id", "clv_horizon", "churn_probability",
                        F.lit(float(unit_cost)).alias("cost"), b.alias("expected_benefit"))
    return out.withColumn("net_gain", F.col("expected_benefit") - F.col("cost")).filter(F.col("net_gain") > 0)


def budget_grid(policy: DataFrame, unit_cost: float, points: int = 12, max_budget: float | None = None,
                max_customers: int | None = None) -> DataFrame:
    """Evenly spaced budgets from 100 x cost to min(max_budget, max(100, cost x min(n, max_customers))),
    without the limits that are None; duplicates removed (the grid can run downward on tiny inputs)."""
    n = policy.agg(F.count(F.lit(1)).alias("n"))
    lo = F.lit(float(unit_cost) * 100.0)
    n_top = F.col("n") if max_customers is None else F.least(F.col("n"), F.lit(max_customers))
    hi = F.greatest(F.lit(100.0), F.lit(float(unit_cost)) * n_top)
    hi = hi if max_budget is None else F.least(F.lit(float(max_budget)), hi)
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    g = n.select(lo.alias("lo"), hi.alias("hi"), i)
    b = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(
        F.col("lo") + F.col("i") * ((F.col("hi") - F.col("lo")) / (points - 1)))
    return g.select(b.alias("budget")).distinct()


def roi_curve(policy: DataFrame, budgets: DataFrame) -> DataFrame:
    """Greedy-by-net-gain ROI for every budget from ONE ranked pass.

    Requires a single unit cost (as the policy frame has).  k = min(floor(B/c), n);
    benefit = prefix sum of the k best benefits, looked up by rank with the
    budget table (bounded by the grid size) broadcast.
    """
    ranked = global_order(policy.select("customer_id", "net_gain", "expected_benefit", "cost"), "net_gain",
                          descending=True, sums={"_cum_b": F.col("expected_benefit").cast(EXACT_SUM)})
    stats = policy.agg(F.count(F.lit(1)).alias("_n"), F.max("cost").alias("_c"))
    b = attach_one_row(budgets.filter(F.col("budget") > 0), stats)
    b = b.select("budget", "_c", F.least(F.floor(F.col("budget") / F.col("_c")), F.col("_n")).cast("bigint").alias("k"))
    # the few wanted ranks travel to the ranked customers; what they hit (at most the grid's size) travels back
    found = ranked.select(F.col("rn").alias("k"), "_cum_b").join(F.broadcast(b.select("k").distinct()), "k")
    hit = b.join(F.broadcast(found), "k", "left")
    spent = F.col("k") * F.col("_c")
    benefit = F.coalesce(F.col("_cum_b").cast("double"), F.lit(0.0))
    return hit.select(
        F.col("budget").cast("double").alias("budget"),
        F.col("k").cast("double").alias("customers_targeted"),
        F.round(spent, 6).alias("total_cost"),
        F.round(benefit, 6).alias("total_expected_benefit"),
        F.round(benefit - spent, 6).alias("total_net_gain"),
        F.round(F.when(spent > 0, (benefit - spent) / spent).otherwise(0.0), 6).alias("roi"),
    )


def median_cost(targeting: DataFrame) -> DataFrame:
    """Unit cost inferred from a targeting list (median), one row."""
    from valuescope.operators.ordered import exact_quantiles

    return exact_quantiles(targeting, "cost", [0.5], prefix="_m").select(F.col("_m50").alias("unit_cost"))
