"""Phase 4 queries: calibration summaries, BG/NBD + Gamma-Gamma scores,
CLV evaluation (A7-A10, C1-C10, W15, J9, B12)."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from valuescope.operators import btyd, metrics, spend
from valuescope.operators import features as FE
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.plans.materialize import materialize
from valuescope.plans.queries_core import txn_orders

P = TESTDATA_PARAMS
BG = btyd.BGNBDParams(**btyd.CDNOW_BGNBD)
GG = spend.GGParams(**spend.CDNOW_GG)
#: The SQL side sums the plain power series, to the length that the largest z (T = 0) needs.
SQL_MIN_TERMS = 20


def series_length(t: float) -> int:
    return math.ceil(math.log(1e-16) / math.log(t / (BG.alpha + t)))


N_TERMS = series_length(P.clv_horizon_days)
N_TERMS_HOLDOUT = series_length(P.holdout_days)


# ---------------------------------------------------------------- Spark side
def clv_inputs(spark, sf_dir, p=P):
    inv = materialize(FE.invoices(txn_orders(spark, sf_dir)))
    hend = FE.resolve_holdout_end(inv, p.cutoff, p.holdout_days)
    summary = btyd.calibration_holdout(inv, p.cutoff, hend)
    return inv, hend, summary


def fixed_scores(spark, sf_dir, p=P):
    inv, hend, summary = clv_inputs(spark, sf_dir, p)
    return materialize(spend.score_clv(inv, summary, BG, GG, p.cutoff, hend, p.clv_horizon_days,
                                       p.discount_rate_annual))


def eval_frame(spark, sf_dir, p=P):
    """Fixed-parameter CLV joined with backtest actuals [cutoff, cutoff+days]."""
    inv, hend, summary = clv_inputs(spark, sf_dir, p)
    scores = spend.score_clv(inv, summary, BG, GG, p.cutoff, hend, p.clv_horizon_days,
                             p.discount_rate_annual)
    act = btyd.holdout_actuals(inv, p.cutoff, p.cutoff + dt.timedelta(days=p.holdout_days), include_start=True)
    return materialize(scores.select("customer_id", "clv_horizon").join(act, "customer_id", "left").select(
        "customer_id", "clv_horizon",
        F.coalesce("holdout_revenue", F.lit(0.0)).alias("holdout_revenue"),
        F.coalesce("holdout_transactions", F.lit(0)).cast("bigint").alias("holdout_transactions"),
    ))


# ---------------------------------------------------------------- SQL side
def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


C = S.ts(P.cutoff)
CDATE = f"DATE '{P.cutoff.date().isoformat()}'"
DESIRED_END = S.ts(P.cutoff + dt.timedelta(days=P.holdout_days))

SUMMARY = f"""hend AS (SELECT least({DESIRED_END}, max(invoice_dt)) AS he FROM inv),
cal_days AS (SELECT DISTINCT customer_id, CAST(invoice_dt AS DATE) AS day FROM inv WHERE invoice_dt <= {C}),
hold_days AS (
  SELECT DISTINCT i.customer_id, CAST(i.invoice_dt AS DATE) AS day
  FROM inv i, hend WHERE i.invoice_dt > {C} AND i.invoice_dt <= hend.he
),
cal_s AS (SELECT customer_id, count(*) AS nd, min(day) AS f, max(day) AS l FROM cal_days GROUP BY customer_id),
hold_s AS (SELECT customer_id, count(*) AS fh FROM hold_days GROUP BY customer_id),
summ AS (
  SELECT CAST(c.customer_id AS BIGINT) AS customer_id, CAST(nd - 1 AS DOUBLE) AS frequency_cal,
    CAST(date_diff('day', f, l) AS DOUBLE) AS recency_cal, CAST(date_diff('day', f, {CDATE}) AS DOUBLE) AS T_cal,
    CAST(coalesce(h.fh, 0) AS DOUBLE) AS frequency_holdout,
    CAST(date_diff('day', {CDATE}, CAST(hend.he AS DATE)) AS DOUBLE) AS duration_holdout
  FROM cal_s c LEFT JOIN hold_s h ON c.customer_id = h.customer_id CROSS JOIN hend
)"""


def _scores_sql(t: float, n_terms: int, name: str = "scores") -> str:
    a, b, r, al = BG.a, BG.b, BG.r, BG.alpha
    A1, B1, C0 = a + b - 1.0 - r, a - 1.0, a + b - 1.0
    pop = GG.v * GG.p / (GG.q - 1.0)
    dfac = spend.discount_factor(P.discount_rate_annual, P.clv_horizon_days)
    return f"""zt_{name} AS (
  SELECT customer_id, frequency_cal AS x, recency_cal AS tx, T_cal AS T,
    {dbl(t)} / ({dbl(al)} + T_cal + {dbl(t)}) AS z, {dbl(C0)} + frequency_cal AS cc
  FROM summ
),
nt_{name} AS (
  SELECT *, CAST(least({n_terms}, greatest({SQL_MIN_TERMS}, coalesce(ceil({dbl(math.log(1e-16))} / ln(z)), {SQL_MIN_TERMS}))) AS INTEGER) AS nt
  FROM zt_{name}
),
hyp_{name}(customer_id, n, term, acc) AS (
  SELECT customer_id, 0, CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM zt_{name}
  UNION ALL
  SELECT h.customer_id, h.n + 1,
    h.term * ({dbl(A1)} + CAST(h.n AS DOUBLE)) * ({dbl(B1)} + CAST(h.n AS DOUBLE)) / ((s.cc + CAST(h.n AS DOUBLE)) * (CAST(h.n AS DOUBLE) + 1.0)) * s.z,
    h.acc + h.term
  FROM hyp_{name} h JOIN nt_{name} s ON h.customer_id = s.customer_id WHERE h.n < s.nt
),
ep_{name} AS (
  SELECT s.customer_id,
    (s.cc / {dbl(B1)} * (1.0 - pow(1.0 - s.z, {dbl(B1)}) * h.acc))
    / (1.0 + CASE WHEN s.x > 0 THEN {dbl(a)} / ({dbl(b)} + s.x - 1.0) * pow(({dbl(al)} + s.T) / ({dbl(al)} + s.tx), {dbl(r)} + s.x) ELSE 0.0 END) AS ep
  FROM nt_{name} s JOIN hyp_{name} h ON s.customer_id = h.customer_id AND h.n = s.nt
)"""


AVG_CAL = f"""avg_cal AS (
  SELECT customer_id, {S.money_sum('revenue')} / count(*) AS av FROM inv WHERE invoice_dt < {C} GROUP BY customer_id
),
gmean AS (SELECT {S.money_sum('revenue')} / count(*) AS gm FROM inv WHERE invoice_dt < {C})"""


def _clv_sql() -> str:
    a, b, r, al = BG.a, BG.b, BG.r, BG.alpha
    pop = GG.v * GG.p / (GG.q - 1.0)
    dfac = spend.discount_factor(P.discount_rate_annual, P.clv_horizon_days)
    x = "s.frequency_cal"
    pa = (f"CASE WHEN {x} = 0 THEN 1.0 ELSE 1.0 / (1.0 + exp(({dbl(r)} + {x}) * ln(({dbl(al)} + s.T_cal) / ({dbl(al)} + s.recency_cal))"
          f" + ln({dbl(a)} / ({dbl(b)} + greatest({x}, 1.0) - 1.0)))) END")
    xc = f"(CASE WHEN {x} < 0.0 THEN 0.0 ELSE {x} END)"
    w = f"({dbl(GG.p)} * {xc} / ({dbl(GG.p)} * {xc} + {dbl(GG.q - 1.0)}))"
    av = "(CASE WHEN coalesce(ac.av, g.gm) < 0.0 THEN 0.0 ELSE coalesce(ac.av, g.gm) END)"
    return f"""clv AS (
  SELECT s.customer_id, s.frequency_cal, s.recency_cal, s.T_cal, s.frequency_holdout,
    {pa} AS p_alive, e.ep AS exp_purchases_horizon, {av} AS avg_value_cal,
    (1.0 - {w}) * {dbl(pop)} + {w} * {av} AS exp_avg_value
  FROM summ s JOIN ep_scores e ON s.customer_id = e.customer_id
  LEFT JOIN avg_cal ac ON s.customer_id = ac.customer_id CROSS JOIN gmean g
),
clv2 AS (SELECT *, exp_purchases_horizon * exp_avg_value * {dbl(dfac)} AS clv_horizon FROM clv)"""


def with_rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


CLV_BASE = with_rec(S.txn_cte("orders"), S.INVOICES, SUMMARY, _scores_sql(P.clv_horizon_days, N_TERMS),
                    AVG_CAL, _clv_sql())

SCORE_COLS = ("customer_id, frequency_cal, recency_cal, T_cal, frequency_holdout, round(p_alive, 9) AS p_alive, "
              "round(exp_purchases_horizon, 9) AS exp_purchases_horizon, round(avg_value_cal, 6) AS avg_value_cal, "
              "round(exp_avg_value, 6) AS exp_avg_value, round(clv_horizon, 6) AS clv_horizon")


def _round_scores(df):
    return df.select(
        "customer_id", "frequency_cal", "recency_cal", "T_cal", "frequency_holdout",
        F.round("p_alive", 9).alias("p_alive"), F.round("exp_purchases_horizon", 9).alias("exp_purchases_horizon"),
        F.round("avg_value_cal", 6).alias("avg_value_cal"), F.round("exp_avg_value", 6).alias("exp_avg_value"),
        F.round("clv_horizon", 6).alias("clv_horizon"),
    )


# ---------------------------------------------------------------- queries
@register(
    "calibration_summary",
    S.with_(S.txn_cte("orders"), S.INVOICES, SUMMARY)
    + "SELECT customer_id, frequency_cal, recency_cal, T_cal, frequency_holdout, duration_holdout FROM summ",
    "A7 A10",
)
def q_calibration_summary(spark, sf_dir):
    return clv_inputs(spark, sf_dir)[2]


@register(
    "holdout_actuals",
    S.with_(S.txn_cte("orders"), S.INVOICES, SUMMARY.split(",\ncal_days")[0])
    + f"""SELECT customer_id, CAST(count(DISTINCT invoice) AS BIGINT) AS holdout_transactions,
  {S.money_sum('revenue')} AS holdout_revenue
FROM inv, hend WHERE invoice_dt > {C} AND invoice_dt <= hend.he GROUP BY customer_id""",
    "A8 F8",
)
def q_holdout_actuals(spark, sf_dir):
    inv, hend, _ = clv_inputs(spark, sf_dir)
    return btyd.holdout_actuals(inv, P.cutoff, hend)


@register(
    "backtest_actuals",
    S.with_(S.txn_cte("orders"), S.INVOICES)
    + f"""SELECT customer_id, CAST(count(DISTINCT invoice) AS BIGINT) AS holdout_transactions,
  {S.money_sum('revenue')} AS holdout_revenue
FROM inv WHERE invoice_dt >= {C} AND invoice_dt <= {DESIRED_END} GROUP BY customer_id""",
    "A8 F9",
)
def q_backtest_actuals(spark, sf_dir):
    inv = FE.invoices(txn_orders(spark, sf_dir))
    return btyd.holdout_actuals(inv, P.cutoff, P.cutoff + dt.timedelta(days=P.holdout_days), include_start=True)


@register(
    "gg_training_set",
    S.with_(S.txn_cte("orders"), S.INVOICES)
    + f"""SELECT customer_id, CAST(count(DISTINCT invoice) AS BIGINT) AS frequency,
  {S.money_sum('revenue')} / count(*) AS monetary_value
FROM inv WHERE invoice_dt < {C} GROUP BY customer_id HAVING count(DISTINCT invoice) > 1""",
    "A9 F13",
)
def q_gg_training_set(spark, sf_dir):
    inv = FE.invoices(txn_orders(spark, sf_dir))
    return spend.monetary_summary(inv, P.cutoff).filter(F.col("frequency") > 1)


@register("clv_scores_fixed", CLV_BASE + f"SELECT {SCORE_COLS} FROM clv2", "C4 C5 C6 C7 J3 P6 P8 P17 P18 P19")
def q_clv_scores_fixed(spark, sf_dir):
    return _round_scores(fixed_scores(spark, sf_dir))


@register(
    "bgnbd_loglik_fixed",
    S.with_(S.txn_cte("orders"), S.INVOICES, SUMMARY)
    + f""", ll AS (
  SELECT frequency_cal AS x, recency_cal AS tx, T_cal AS T,
    lgamma({dbl(BG.r)} + frequency_cal) - lgamma({dbl(BG.r)}) + {dbl(BG.r)} * ln({dbl(BG.alpha)})
    + lgamma({dbl(BG.a + BG.b)}) + lgamma({dbl(BG.b)} + frequency_cal) - lgamma({dbl(BG.b)}) - lgamma({dbl(BG.a + BG.b)} + frequency_cal) AS g,
    -({dbl(BG.r)} + frequency_cal) * ln({dbl(BG.alpha)} + T_cal) AS a3,
    ln({dbl(BG.a)}) - ln({dbl(BG.b)} + greatest(frequency_cal, 1.0) - 1.0) - ({dbl(BG.r)} + frequency_cal) * ln(recency_cal + {dbl(BG.alpha)}) AS a4
  FROM summ
)
SELECT CAST(count(*) AS BIGINT) AS customers,
  round(sum(g + greatest(a3, a4) + ln(exp(a3 - greatest(a3, a4)) + CASE WHEN x > 0 THEN exp(a4 - greatest(a3, a4)) ELSE 0.0 END)), 4) AS loglik,
  round(avg(g + greatest(a3, a4) + ln(exp(a3 - greatest(a3, a4)) + CASE WHEN x > 0 THEN exp(a4 - greatest(a3, a4)) ELSE 0.0 END)), 8) AS mean_loglik
FROM ll""",
    "C2",
)
def q_bgnbd_loglik_fixed(spark, sf_dir):
    summary = clv_inputs(spark, sf_dir)[2]
    ll = btyd.loglik_rows(BG)
    return summary.agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.round(F.sum(ll), 4).alias("loglik"),
        F.round(F.avg(ll), 8).alias("mean_loglik"),
    )


@register(
    "clv_holdout_metrics",
    with_rec(S.txn_cte("orders"), S.INVOICES, SUMMARY, _scores_sql(float(P.holdout_days), N_TERMS_HOLDOUT, "h"))
    + f""", act AS (
  SELECT customer_id, count(DISTINCT invoice) AS ht FROM inv, hend
  WHERE invoice_dt > {C} AND invoice_dt <= hend.he GROUP BY customer_id
),
ev AS (
  SELECT CAST(coalesce(a.ht, 0) AS DOUBLE) AS y, e.ep AS yhat
  FROM summ s JOIN ep_h e ON s.customer_id = e.customer_id LEFT JOIN act a ON s.customer_id = a.customer_id
)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(abs(y - yhat)), 6) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
  round(avg(CASE WHEN y != 0 THEN abs((y - yhat) / y) END), 6) AS mape
FROM ev""",
    "C5 C8 J4",
)
def q_clv_holdout_metrics(spark, sf_dir):
    inv, hend, summary = clv_inputs(spark, sf_dir)
    t = float((hend.date() - P.cutoff.date()).days)
    act = btyd.holdout_actuals(inv, P.cutoff, hend)
    ev = btyd.with_expected_purchases(summary.join(act, "customer_id", "left"), BG, t, "yhat").select(
        F.coalesce(F.col("holdout_transactions"), F.lit(0)).cast("double").alias("y"), "yhat")
    m = metrics.regression_metrics(ev, "y", "yhat")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "mape")])


_EVAL = CLV_BASE[:-1] + f""",
bt AS (
  SELECT customer_id, count(DISTINCT invoice) AS ht, {S.money_sum('revenue')} AS hr
  FROM inv WHERE invoice_dt >= {C} AND invoice_dt <= {DESIRED_END} GROUP BY customer_id
),
ev AS (
  SELECT c.customer_id, coalesce(c.clv_horizon, 0.0) AS s, coalesce(b.hr, 0.0) AS y, CAST(coalesce(b.ht, 0) AS BIGINT) AS ht
  FROM clv2 c LEFT JOIN bt b ON c.customer_id = b.customer_id
),
dec AS (
  SELECT *, {S.qbin('row_number() OVER (ORDER BY s, customer_id)', 'count(*) OVER ()', 10)} AS decile FROM ev
)
"""


@register(
    "clv_spearman",
    _EVAL + """, rx AS (SELECT customer_id, s, y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r1 FROM ev),
ry AS (SELECT customer_id, r1, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS r2 FROM rx)
SELECT CAST(count(*) AS BIGINT) AS n,
  round(CASE WHEN (SELECT count(DISTINCT s) FROM ev) > 1 AND (SELECT count(DISTINCT y) FROM ev) > 1 THEN corr(r1, r2) END, 6) AS spearman
FROM ry""",
    "C9 W5",
)
def q_clv_spearman(spark, sf_dir):
    ev = eval_frame(spark, sf_dir)
    sp = metrics.spearman(ev, "clv_horizon", "holdout_revenue")
    return sp.select("n", F.round("spearman", 6).alias("spearman"))


_MD5U = "CAST(('0x' || substr(md5(concat_ws('|', {seed}, rep, decile, part, CAST(m AS VARCHAR))), 1, 8)) AS BIGINT) / CAST('4294967296.0' AS DOUBLE)"
_DRAW = metrics.DRAW_SIZE


@register(
    "clv_decile_lift",
    _EVAL + f""", amounts AS (SELECT decile, {S.money('y')} AS m, count(*) AS total FROM dec GROUP BY ALL),
parts AS (
  SELECT decile, m, part, least({_DRAW}, total - part * {_DRAW}) AS n
  FROM amounts, unnest(range(0, (total - 1) // {_DRAW} + 1)) AS t(part)
),
pois(n, k, p, c) AS (
  SELECT DISTINCT n, 0, exp(-CAST(n AS DOUBLE)), exp(-CAST(n AS DOUBLE)) FROM parts
  UNION ALL SELECT n, k + 1, p * n / (k + 1), c + p * n / (k + 1) FROM pois WHERE k < floor(n + 8.0 * sqrt(n) + 16.0)
),
cdfs AS (SELECT n, list(c ORDER BY k) AS cdf FROM pois GROUP BY n),
boot AS (SELECT decile, rep, m, cdf, {_MD5U.format(seed=P.seed)} AS u FROM parts JOIN cdfs USING (n) CROSS JOIN range(1, {P.n_bootstrap + 1}) r(rep)),
bw AS (SELECT decile, rep, m, len(list_filter(cdf, lambda c: c <= u)) AS w FROM boot),
per AS (
  SELECT decile, rep, CASE WHEN sum(w) > 0 THEN CAST(sum(m * w) AS DOUBLE) / sum(w) ELSE 0.0 END AS m
  FROM bw GROUP BY decile, rep
),
ci AS (
  SELECT decile, round(quantile_cont(m, 0.025), 6) AS ci_lower, round(quantile_cont(m, 0.975), 6) AS ci_upper FROM per GROUP BY decile
),
g AS (
  SELECT decile, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, avg(s) AS aps,
    CAST(sum({S.money('y')}) AS DOUBLE) AS tot, count(*) AS n FROM dec GROUP BY decile
),
om AS (SELECT CAST(sum({S.money('y')}) AS DOUBLE) / count(*) AS m FROM ev)
SELECT g.decile, g.customers, round(g.aps, 6) AS avg_pred_clv, round(g.tot / g.n, 6) AS avg_holdout_revenue,
  g.tot AS total_holdout_revenue, round(CASE WHEN om.m > 0 THEN (g.tot / g.n) / om.m END, 6) AS lift_vs_overall_mean,
  ci.ci_lower, ci.ci_upper
FROM g CROSS JOIN om LEFT JOIN ci ON g.decile = ci.decile""",
    "W15 W1 W2 J9 B12",
)
def q_clv_decile_lift(spark, sf_dir):
    bins = metrics.binned(eval_frame(spark, sf_dir))
    ci = metrics.bootstrap_decile_ci(bins, n_boot=P.n_bootstrap, ci_level=P.ci_level, seed=P.seed)
    return metrics.decile_lift(bins, ci=ci)


@register("clv_scores", None, "C1 C3 C10 (fitted parameters; rows-only)")
def q_clv_scores(spark, sf_dir):
    inv, hend, summary = clv_inputs(spark, sf_dir)
    bg, _ = btyd.fit_bgnbd(summary, P.penalizer_bgnbd)
    gg, _ = spend.fit_gamma_gamma(inv, P.cutoff, P.penalizer_gg)
    return spend.score_clv(inv, summary, bg, gg, P.cutoff, hend, P.clv_horizon_days, P.discount_rate_annual,
                           penalizer_bgnbd=P.penalizer_bgnbd, penalizer_gg=P.penalizer_gg)


_OPTIMA = [("bgnbd", name) for name in btyd.PARAMETERS] + [("gamma_gamma", name) for name in ("p", "q", "v")]


@register(
    "fit_optimum",
    "SELECT model, parameter, false AS better_below, false AS better_above, true AS converged FROM (VALUES "
    + ", ".join(f"('{m}', '{name}')" for m, name in _OPTIMA) + ") AS t(model, parameter)",
    "C1 C3 (the penalised log-likelihood is no better on either side of any fitted parameter)",
)
def q_fit_optimum(spark, sf_dir):
    """Penalised mean log-likelihood at the fit and a hundredth to either side of each parameter.

    Values come from the per-row likelihoods, not from the sums that the fits use. Better is what
    exceeds the fit by more than rounding: where customers don't drop out, as in these tables, a goes to 0
    and the value is flat in a and b.
    """
    inv, _, summary = clv_inputs(spark, sf_dir)
    summary = materialize(summary)
    monetary = materialize(spend.monetary_summary(inv, P.cutoff))
    scale = 10.0 / summary.agg(F.max("T_cal")).first()[0]
    bg, bg_info = btyd.fit_bgnbd(summary, P.penalizer_bgnbd)
    gg, gg_info = spend.fit_gamma_gamma_summary(monetary, P.penalizer_gg)
    rows = []
    for model, best, converged in (("bgnbd", bg.as_dict(), bg_info["converged"]), ("gamma_gamma", gg.as_dict(), gg_info["converged"])):
        def moved(name, factor, best=best):
            return best | {name: best[name] * factor}

        for name in best:
            points = [moved(name, f) for f in (0.99, 1.0, 1.01)]
            if model == "bgnbd":
                means = summary.agg(*[F.avg(btyd.loglik_rows(p)).alias(f"m{i}") for i, p in enumerate(points)]).first()
                penalty = [P.penalizer_bgnbd * sum((v * scale if k == "alpha" else v) ** 2 for k, v in p.items()) for p in points]
            else:
                means = [spend.loglik_gamma_gamma(monetary, p).first()["mean_loglik"] for p in points]
                penalty = [P.penalizer_gg * sum(v ** 2 for v in p.values()) for p in points]
            below, at, above = (m - c for m, c in zip(means, penalty))
            rows.append((model, name, below > at + 1e-9, above > at + 1e-9, bool(converged)))
    return spark.createDataFrame(rows, "model string, parameter string, better_below boolean, better_above boolean, converged boolean")


@register(
    "gg_loglik_fixed",
    S.with_(S.txn_cte("orders"), S.INVOICES)
    + f""", mon AS (
  SELECT customer_id, CAST(count(DISTINCT invoice) AS DOUBLE) AS x, {S.money_sum('revenue')} / count(*) AS m
  FROM inv WHERE invoice_dt < {C} GROUP BY customer_id HAVING count(DISTINCT invoice) > 1
),
ll AS (
  SELECT lgamma({dbl(GG.p)} * x + {dbl(GG.q)}) - lgamma({dbl(GG.p)} * x) - lgamma({dbl(GG.q)}) + {dbl(GG.q)} * ln({dbl(GG.v)})
    + ({dbl(GG.p)} * x - 1.0) * ln(m) + {dbl(GG.p)} * x * ln(x) - ({dbl(GG.p)} * x + {dbl(GG.q)}) * ln(x * m + {dbl(GG.v)}) AS l
  FROM mon
)
SELECT CAST(count(*) AS BIGINT) AS customers, round(sum(l), 4) AS loglik, round(avg(l), 8) AS mean_loglik FROM ll""",
    "C3",
)
def q_gg_loglik_fixed(spark, sf_dir):
    inv = materialize(FE.invoices(txn_orders(spark, sf_dir)))
    ll = spend.loglik_gamma_gamma(spend.monetary_summary(inv, P.cutoff), GG)
    return ll.select("customers", F.round("loglik", 4).alias("loglik"), F.round("mean_loglik", 8).alias("mean_loglik"))
