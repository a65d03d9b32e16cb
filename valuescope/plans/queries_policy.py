"""Phase 5 queries: economics, targeting, ROI curves, scenarios, tornado,
value x risk quadrants.

Inputs for the oracle-checked versions: CLV from fixed BG/NBD + Gamma-Gamma
parameters and churn risk = 1 - P(alive) (both expressible in SQL).  The
full pipeline feeds the same operators with fitted models.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from valuescope.functions import risk_band
from valuescope.operators import policy as PO
from valuescope.operators import scenarios as SC
from valuescope.operators import segments as SG
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans.catalog import register
from valuescope.plans.materialize import materialize
from valuescope.plans.queries_clv import CLV_BASE, dbl, fixed_scores
from valuescope.session import checkpoint_dir
from valuescope.sources import read_ordered, write_ordered

P = TESTDATA_PARAMS
BUDGET_SMALL = 200.0  # binding budget for the oracle checks (cap 100 customers)


def policy_inputs(spark, sf_dir):
    s = fixed_scores(spark, sf_dir)
    clv = s.select("customer_id", F.round("clv_horizon", 6).alias("clv_horizon"))
    p = F.round(1.0 - F.col("p_alive"), 9)
    risk = s.select("customer_id", p.alias("churn_probability"), risk_band(p).alias("risk_band"))
    return clv, risk


def scores_joined(spark, sf_dir):
    clv, risk = policy_inputs(spark, sf_dir)
    return materialize(PO.join_scores(clv, risk))


# ---------------------------------------------------------------- SQL side
def _clamp01(x):
    return f"(CASE WHEN {x} < 0.0 THEN 0.0 WHEN {x} > 1.0 THEN 1.0 ELSE {x} END)"


RISK_BAND_SQL = ("(CASE WHEN p IS NULL THEN NULL WHEN {c} <= 0.33 THEN 'low' WHEN {c} <= 0.66 THEN 'medium' "
                 "ELSE 'high' END)").replace("{c}", _clamp01("p"))

INPUTS = CLV_BASE[:-1] + f""",
inputs0 AS (SELECT customer_id, round(clv_horizon, 6) AS clv_horizon, round(1.0 - p_alive, 9) AS p FROM clv2),
inputs AS (SELECT customer_id, clv_horizon, p AS churn_probability, {RISK_BAND_SQL} AS risk_band FROM inputs0)
"""


def _benefit(eff: float) -> str:
    return (f"((CASE WHEN clv_horizon < 0.0 THEN 0.0 ELSE clv_horizon END) * {_clamp01('churn_probability')} "
            f"* {dbl(eff)})")


ECON = INPUTS + f""", econ0 AS (
  SELECT customer_id, clv_horizon, churn_probability, risk_band, {dbl(P.unit_cost)} AS cost,
    {_benefit(P.retention_effectiveness)} AS expected_benefit
  FROM inputs
),
econ AS (
  SELECT *, expected_benefit - cost AS net_gain, (expected_benefit - cost) > 0 AS eligible FROM econ0
  WHERE clv_horizon >= {dbl(P.min_clv)} AND churn_probability > 0
)
"""


def _selected(budget: float) -> str:
    cap = int(budget // P.unit_cost)
    return ECON + f""", rk AS (
  SELECT customer_id, row_number() OVER (ORDER BY net_gain DESC, customer_id) AS rn FROM econ WHERE eligible
),
sel AS (
  SELECT e.*, rk.rn IS NOT NULL AND rk.rn <= {cap} AS target,
    CAST(CASE WHEN rk.rn IS NOT NULL AND rk.rn <= {cap} THEN rk.rn ELSE 0 END AS BIGINT) AS priority_rank
  FROM econ e LEFT JOIN rk ON e.customer_id = rk.customer_id
)
"""


TARGET_COLS_SQL = ("customer_id, CASE WHEN target THEN 'target' ELSE 'no_action' END AS recommended_action, "
                   "priority_rank, risk_band, churn_probability, clv_horizon, cost, round(expected_benefit, 9) AS expected_benefit, "
                   "round(net_gain, 9) AS net_gain")


def _round_targets(df):
    return df.select("customer_id", "recommended_action", "priority_rank", "risk_band", "churn_probability",
                     "clv_horizon", "cost", F.round("expected_benefit", 9).alias("expected_benefit"),
                     F.round("net_gain", 9).alias("net_gain"))


# ---------------------------------------------------------------- queries
@register(
    "policy_economics",
    ECON + """SELECT customer_id, clv_horizon, churn_probability, risk_band, cost, round(expected_benefit, 9) AS expected_benefit,
  round(net_gain, 9) AS net_gain, eligible FROM econ""",
    "B1 F11 J5 P8 P12",
)
def q_policy_economics(spark, sf_dir):
    e = PO.build_economics(scores_joined(spark, sf_dir), P.unit_cost, P.retention_effectiveness, P.min_clv)
    return e.select("customer_id", "clv_horizon", "churn_probability", "risk_band", "cost",
                    F.round("expected_benefit", 9).alias("expected_benefit"), F.round("net_gain", 9).alias("net_gain"),
                    "eligible")


@register("targeting_list", _selected(P.budget) + f"SELECT {TARGET_COLS_SQL} FROM sel", "B3 B5 W1 P14 O2")
def q_targeting_list(spark, sf_dir):
    e = PO.build_economics(scores_joined(spark, sf_dir), P.unit_cost, P.retention_effectiveness, P.min_clv)
    return _round_targets(PO.targeting_list(PO.select_targets(e, P.budget, "exact")))


@register(
    "targeting_list_written",
    _selected(P.budget) + f"""SELECT row_number() OVER (ORDER BY recommended_action, priority_rank, customer_id) AS position,
  customer_id, recommended_action, priority_rank FROM (SELECT {TARGET_COLS_SQL} FROM sel) t""",
    "O2 S5",
)
def q_targeting_list_written(spark, sf_dir):
    """The targeting list as it stands in the files that the batch's ordered write makes."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/targeting-{uuid.uuid4().hex}"
    write_ordered(q_targeting_list(spark, sf_dir), path, PO.TARGETING_ORDER, max_file_rows=1000)
    return read_ordered(spark, path).select("position", "customer_id", "recommended_action", "priority_rank")


@register("targeting_list_greedy", _selected(BUDGET_SMALL) + f"SELECT {TARGET_COLS_SQL} FROM sel", "B4 W6")
def q_targeting_list_greedy(spark, sf_dir):
    e = PO.build_economics(scores_joined(spark, sf_dir), P.unit_cost, P.retention_effectiveness, P.min_clv)
    return _round_targets(PO.targeting_list(PO.select_targets(e, BUDGET_SMALL, "greedy")))


@register(
    "allocation_summary",
    _selected(BUDGET_SMALL) + """SELECT CAST(count(*) AS DOUBLE) AS customers_total,
  CAST(sum(CASE WHEN eligible THEN 1 ELSE 0 END) AS DOUBLE) AS customers_eligible,
  CAST(sum(CASE WHEN target THEN 1 ELSE 0 END) AS DOUBLE) AS customers_targeted,
  coalesce(CAST(sum(CASE WHEN target THEN CAST(cost AS DECIMAL(30,10)) END) AS DOUBLE), 0.0) AS total_cost,
  coalesce(CAST(sum(CASE WHEN target THEN CAST(expected_benefit AS DECIMAL(30,10)) END) AS DOUBLE), 0.0) AS total_expected_benefit,
  coalesce(CAST(sum(CASE WHEN target THEN CAST(net_gain AS DECIMAL(30,10)) END) AS DOUBLE), 0.0) AS total_net_gain,
  round(coalesce(avg(CASE WHEN target THEN churn_probability END), 0.0), 9) AS avg_churn_probability_targeted,
  round(coalesce(avg(CASE WHEN target THEN clv_horizon END), 0.0), 6) AS avg_clv_targeted
FROM sel""",
    "A29",
)
def q_allocation_summary(spark, sf_dir):
    e = PO.build_economics(scores_joined(spark, sf_dir), P.unit_cost, P.retention_effectiveness, P.min_clv)
    s = PO.allocation_summary(PO.select_targets(e, BUDGET_SMALL, "exact"))
    return s.select(*[c for c in s.columns if not c.startswith("avg_")],
                    F.round("avg_churn_probability_targeted", 9).alias("avg_churn_probability_targeted"),
                    F.round("avg_clv_targeted", 6).alias("avg_clv_targeted"))


@register(
    "targeting_median_cost",
    _selected(BUDGET_SMALL) + "SELECT quantile_cont(cost, 0.5) AS unit_cost FROM sel",
    "A31",
)
def q_targeting_median_cost(spark, sf_dir):
    e = PO.build_economics(scores_joined(spark, sf_dir), P.unit_cost, P.retention_effectiveness, P.min_clv)
    return PO.median_cost(PO.targeting_list(PO.select_targets(e, BUDGET_SMALL, "exact")))


_POLICY = INPUTS + f""", pol0 AS (
  SELECT customer_id, {dbl(P.unit_cost)} AS cost, {_benefit(P.retention_effectiveness)} AS eb FROM inputs
),
pol AS (SELECT *, eb - cost AS net FROM pol0 WHERE eb - cost > 0),
rk AS (
  SELECT row_number() OVER (ORDER BY net DESC, customer_id) AS rn,
    sum(CAST(eb AS DECIMAL(30,10))) OVER (ORDER BY net DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM pol
),
pn AS (SELECT count(*) AS n FROM pol),
grid0 AS (
  SELECT {dbl(P.unit_cost * 100.0)} AS lo,
    least({dbl(20000.0)}, greatest({dbl(100.0)}, {dbl(P.unit_cost)} * least(n, 10000))) AS hi, r.i
  FROM pn CROSS JOIN range(12) r(i)
),
grid AS (SELECT DISTINCT CASE WHEN i = 11 THEN hi ELSE lo + i * ((hi - lo) / 11) END AS budget FROM grid0),
kk AS (SELECT budget, CAST(least(floor(budget / {dbl(P.unit_cost)}), (SELECT n FROM pn)) AS BIGINT) AS k FROM grid WHERE budget > 0),
res AS (
  SELECT kk.budget, kk.k, kk.k * {dbl(P.unit_cost)} AS spent, coalesce(CAST(rk.cum AS DOUBLE), 0.0) AS benefit
  FROM kk LEFT JOIN rk ON rk.rn = kk.k
)
"""


@register(
    "roi_curve",
    _POLICY + """SELECT budget, CAST(k AS DOUBLE) AS customers_targeted, round(spent, 6) AS total_cost,
  round(benefit, 6) AS total_expected_benefit, round(benefit - spent, 6) AS total_net_gain,
  round(CASE WHEN spent > 0 THEN (benefit - spent) / spent ELSE 0.0 END, 6) AS roi
FROM res""",
    "B6 B7 F12 J6 W6",
)
def q_roi_curve(spark, sf_dir):
    pol = PO.policy_frame(scores_joined(spark, sf_dir), P.unit_cost, P.retention_effectiveness)
    return PO.roi_curve(pol, PO.budget_grid(pol, P.unit_cost, P.n_budget_points, P.max_curve_budget, P.max_curve_customers))


def _scenario_sql(scen_cte: str, budgets_cte: str) -> str:
    return INPUTS + f""", base AS (
  SELECT customer_id, clv_horizon * churn_probability AS base FROM inputs
  WHERE clv_horizon IS NOT NULL AND churn_probability IS NOT NULL
),
ranked AS (
  SELECT row_number() OVER (ORDER BY base DESC, customer_id) AS rn,
    sum(CAST(base AS DECIMAL(30,10))) OVER (ORDER BY base DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM base
),
{scen_cte},
{budgets_cte},
elig AS (SELECT s.*, (SELECT count(*) FROM base b WHERE b.base > s.unit_cost / s.effectiveness) AS n_eligible FROM sc s),
g AS (
  SELECT e.*, bu.budget,
    CAST(CASE WHEN bu.budget > 0 THEN least(floor(bu.budget / e.unit_cost), e.n_eligible) ELSE 0 END AS BIGINT) AS k
  FROM elig e CROSS JOIN bud bu
),
roi AS (
  SELECT g.*, CASE WHEN k > 0 THEN k * unit_cost ELSE 0.0 END AS total_cost,
    CASE WHEN k > 0 THEN effectiveness * coalesce(CAST(r.cum AS DOUBLE), 0.0) - k * unit_cost ELSE 0.0 END AS net_gain,
    CASE WHEN k > 0 THEN (effectiveness * coalesce(CAST(r.cum AS DOUBLE), 0.0) - k * unit_cost) / (k * unit_cost) ELSE 0.0 END AS roi
  FROM g LEFT JOIN ranked r ON r.rn = g.k
)
"""


_MD5U = "CAST(('0x' || substr(md5(concat_ws('|', {seed}, '{tag}', range)), 1, 8)) AS BIGINT) / CAST('4294967296.0' AS DOUBLE)"
_E0, _E1 = P.effectiveness_range
_C0, _C1 = P.cost_range
_SCEN_MC = f"""sc AS (
  SELECT range AS scenario_id,
    {dbl(_E0)} + {dbl(_E1 - _E0)} * {_MD5U.format(seed=P.seed, tag='eff')} AS effectiveness,
    {dbl(_C0)} + {dbl(_C1 - _C0)} * {_MD5U.format(seed=P.seed, tag='cost')} AS unit_cost
  FROM range({P.n_scenarios})
)"""
_BUD_SENS = f"""bud AS (
  SELECT CASE WHEN i = {P.n_budget_points - 1} THEN hi ELSE lo + i * ((hi - lo) / {P.n_budget_points - 1}) END AS budget
  FROM (SELECT {dbl(P.unit_cost * 10.0)} AS lo, least(count(*) * {dbl(P.unit_cost)} * {dbl(0.7)}, {dbl(8000.0)}) AS hi
        FROM base) x CROSS JOIN range({P.n_budget_points}) r(i)
)"""


def _sens_inputs(spark, sf_dir):
    s = scores_joined(spark, sf_dir)
    base = SC.base_values(s)
    return base, SC.sensitivity_budgets(base, P.unit_cost, P.n_budget_points, P.max_sensitivity_budget).select("budget")


@register(
    "scenario_summary",
    _scenario_sql(_SCEN_MC, _BUD_SENS) + """SELECT budget,
  round(quantile_cont(roi, 0.05), 6) AS roi_p5, round(quantile_cont(roi, 0.5), 6) AS roi_p50,
  round(quantile_cont(roi, 0.95), 6) AS roi_p95, round(quantile_cont(net_gain, 0.05), 6) AS net_gain_p5,
  round(quantile_cont(net_gain, 0.5), 6) AS net_gain_p50, round(quantile_cont(net_gain, 0.95), 6) AS net_gain_p95
FROM roi GROUP BY budget""",
    "B9 B8 F14",
)
def q_scenario_summary(spark, sf_dir):
    base, bud = _sens_inputs(spark, sf_dir)
    sc = SC.draw_scenarios(spark, P.n_scenarios, P.effectiveness_range, P.cost_range, P.seed)
    return SC.monte_carlo_summary(SC.scenario_roi(base, sc, bud))


_SCEN_BASE = f"""sc AS (SELECT 0 AS scenario_id, {dbl(P.retention_effectiveness)} AS effectiveness, {dbl(P.unit_cost)} AS unit_cost)"""


@register(
    "baseline_curve",
    _scenario_sql(_SCEN_BASE, _BUD_SENS) + """SELECT budget, round(roi, 6) AS roi, round(net_gain, 6) AS net_gain,
  k AS n_targeted FROM roi""",
    "B10 B8",
)
def q_baseline_curve(spark, sf_dir):
    base, bud = _sens_inputs(spark, sf_dir)
    sc = spark.createDataFrame([(0, float(P.retention_effectiveness), float(P.unit_cost))],
                               "scenario_id long, effectiveness double, unit_cost double")
    r = SC.scenario_roi(base, sc, bud)
    return r.select("budget", F.round("roi", 6).alias("roi"), F.round("net_gain", 6).alias("net_gain"), "n_targeted")


_e, _c, _v = P.retention_effectiveness, P.unit_cost, P.variation
_TORNADO_ROWS = [(0, _e, _c), (1, _e * (1 - _v), _c), (2, _e * (1 + _v), _c),
                 (3, _e, max(_c * (1 - _v), 0.1)), (4, _e, _c * (1 + _v))]
_SCEN_T = "sc AS (" + " UNION ALL ".join(
    f"SELECT {i} AS scenario_id, {dbl(e)} AS effectiveness, {dbl(c)} AS unit_cost" for i, e, c in _TORNADO_ROWS) + ")"
_BUD_T = f"bud AS (SELECT {dbl(P.reference_budget)} AS budget)"


@register(
    "tornado",
    _scenario_sql(_SCEN_T, _BUD_T) + f""", rr AS (SELECT scenario_id, roi FROM roi),
prm(parameter, base_value, low_value, high_value, lo, hi) AS (VALUES
  ('retention_effectiveness', {dbl(_e)}, {dbl(_TORNADO_ROWS[1][1])}, {dbl(_TORNADO_ROWS[2][1])}, 1, 2),
  ('unit_cost', {dbl(_c)}, {dbl(_TORNADO_ROWS[3][2])}, {dbl(_TORNADO_ROWS[4][2])}, 3, 4))
SELECT parameter, base_value, low_value, high_value,
  round((SELECT roi FROM rr WHERE scenario_id = 0), 6) AS roi_at_base,
  round((SELECT roi FROM rr WHERE scenario_id = lo), 6) AS roi_at_low,
  round((SELECT roi FROM rr WHERE scenario_id = hi), 6) AS roi_at_high,
  round(abs((SELECT roi FROM rr WHERE scenario_id = hi) - (SELECT roi FROM rr WHERE scenario_id = lo)), 6) AS roi_swing
FROM prm""",
    "B11",
)
def q_tornado(spark, sf_dir):
    base, _ = _sens_inputs(spark, sf_dir)
    return SC.tornado(base, P.reference_budget, P.retention_effectiveness, P.unit_cost, P.variation)


@register("risk_band_counts", INPUTS + "SELECT risk_band, CAST(count(*) AS BIGINT) AS count FROM inputs GROUP BY risk_band",
          "P12 A23")
def q_risk_band_counts(spark, sf_dir):
    _, risk = policy_inputs(spark, sf_dir)
    return SG.category_counts(risk, "risk_band")


_QUAD = INPUTS + """, th AS (
  SELECT quantile_cont(clv_horizon, 0.75) AS cq, quantile_cont(churn_probability, 0.75) AS pq FROM inputs
),
quad AS (
  SELECT i.customer_id, i.clv_horizon, i.churn_probability,
    CASE WHEN i.clv_horizon >= th.cq THEN 'high_value' ELSE 'lower_value' END AS value_segment,
    CASE WHEN i.churn_probability >= th.pq THEN 'high_risk' ELSE 'lower_risk' END AS risk_segment
  FROM inputs i CROSS JOIN th
)
"""


@register(
    "priority_quadrants",
    _QUAD + "SELECT value_segment || ' & ' || risk_segment AS priority_quadrant, CAST(count(*) AS BIGINT) AS count "
    "FROM quad GROUP BY 1",
    "A33 A23",
)
def q_priority_quadrants(spark, sf_dir):
    q = SG.value_risk_quadrants(scores_joined(spark, sf_dir))
    return SG.category_counts(q, "priority_quadrant")


@register(
    "top_priority_customers",
    _QUAD + """SELECT customer_id, clv_horizon, churn_probability FROM quad
WHERE value_segment = 'high_value' AND risk_segment = 'high_risk'
ORDER BY clv_horizon DESC, churn_probability DESC, customer_id LIMIT 20""",
    "O4",
)
def q_top_priority_customers(spark, sf_dir):
    q = SG.value_risk_quadrants(scores_joined(spark, sf_dir))
    q = q.filter(F.col("priority_quadrant") == "high_value & high_risk")
    return SG.top_k(q, 20, "clv_horizon", "churn_probability").select("customer_id", "clv_horizon",
                                                                       "churn_probability")
