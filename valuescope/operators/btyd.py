"""BG/NBD purchase-count model.

Fitting never moves customer rows to the driver: customers are compressed
to the sufficient statistics (x, t_x, T, count); each Newton step is one
pass over that table, which returns log-likelihood, gradient and observed
information (16 sums, taken by numpy over the column batches of a task, then
by Spark over tasks).  Only these and the 4 parameters live on
the driver.

Log-gamma terms depend only on the integer repeat count x, so
  sum_i [lnG(r+x_i) - lnG(r)] = sum_k N(x>k) ln(r+k)
  sum_i [lnG(b+x_i) - lnG(b) + lnG(a+b) - lnG(a+b+x_i)] = sum_k N(x>k) [ln(b+k) - ln(a+b+k)]
with the tail counts N(x>k) gathered once (length = max x); their derivatives
(differences of digammas and trigammas) are the sums of 1/(r+k) and -1/(r+k)^2.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuescope.functions import money, ts_lit
from valuescope.operators.optimize import minimize_newton, summed
from valuescope.session import checkpoint_dir

# Published BG/NBD estimates for the CDNOW sample (Fader, Hardie & Lee 2005),
# used as fixed parameters when a deterministic score is needed.
CDNOW_BGNBD = {"r": 0.243, "alpha": 4.414, "a": 0.793, "b": 2.426}


@dataclass(frozen=True)
class BGNBDParams:
    r: float
    alpha: float
    a: float
    b: float

    def as_dict(self):
        return {"r": self.r, "alpha": self.alpha, "a": self.a, "b": self.b}


def calibration_holdout(inv: DataFrame, cutoff: dt.datetime, holdout_end: dt.datetime) -> DataFrame:
    """Per-customer calibration/holdout summary on calendar days.

    Calibration = invoices at or before the cutoff, collapsed to distinct
    days: frequency = days - 1, recency = last - first day, T = cutoff day -
    first day.  Holdout = distinct days in (cutoff, holdout_end].  Customers
    without calibration purchases are absent; missing holdout -> 0.
    """
    c, e = ts_lit(cutoff), ts_lit(holdout_end)
    cday = F.lit(cutoff.date())
    days = inv.select("customer_id", "invoice_dt", F.col("invoice_dt").cast("date").alias("day"))
    cal = days.filter(F.col("invoice_dt") <= c)
    hold = days.filter((F.col("invoice_dt") > c) & (F.col("invoice_dt") <= e))
    cal_s = cal.groupBy("customer_id").agg(
        F.count_distinct("day").alias("_nd"), F.min("day").alias("_first"), F.max("day").alias("_last")
    )
    hold_s = hold.groupBy("customer_id").agg(F.count_distinct("day").alias("frequency_holdout"))
    duration = (holdout_end.date() - cutoff.date()).days
    return cal_s.join(hold_s, "customer_id", "left").select(
        F.col("customer_id").cast("bigint"),
        (F.col("_nd") - 1).cast("double").alias("frequency_cal"),
        F.datediff("_last", "_first").cast("double").alias("recency_cal"),
        F.datediff(cday, "_first").cast("double").alias("T_cal"),
        F.coalesce(F.col("frequency_holdout"), F.lit(0)).cast("double").alias("frequency_holdout"),
        F.lit(float(duration)).alias("duration_holdout"),
    )


def holdout_actuals(inv: DataFrame, start: dt.datetime, end: dt.datetime, include_start: bool = False) -> DataFrame:
    """A8 (F8) / F9: distinct invoices and revenue per customer in the holdout window.

    ``include_start=False``: (start, end] (CLV step); True: [start, end] (backtest).
    """
    s, e = ts_lit(start), ts_lit(end)
    lower = F.col("invoice_dt") >= s if include_start else F.col("invoice_dt") > s
    return (
        inv.filter(lower & (F.col("invoice_dt") <= e))
        .groupBy("customer_id")
        .agg(
            F.count_distinct("invoice").cast("bigint").alias("holdout_transactions"),
            F.sum(money("revenue")).cast("double").alias("holdout_revenue"),
        )
    )


# ------------------------------------------------------------------ closed forms
def _p(params) -> BGNBDParams:
    return params if isinstance(params, BGNBDParams) else BGNBDParams(**params)


def p_alive(params, x="frequency_cal", t_x="recency_cal", T="T_cal") -> Column:
    """C4: P(alive | x, t_x, T); 1 when x = 0."""
    p = _p(params)
    x, t_x, T = (F.col(c) if isinstance(c, str) else c for c in (x, t_x, T))
    log_div = (F.lit(p.r) + x) * F.log((p.alpha + T) / (p.alpha + t_x)) + F.log(
        F.lit(p.a) / (F.lit(p.b) + F.greatest(x, F.lit(1.0)) - 1)
    )
    return F.when(x == 0, F.lit(1.0)).otherwise(1.0 / (1.0 + F.exp(log_div)))


#: Terms of a power or Taylor series whose terms at least halve in the long run, besides those for large arguments.
SHORT_TERMS = 72
#: Distance from a = 1 below which expected purchases are interpolated, and the spacing of the nodes.
NEAR_ONE, NODE_SPACING = 1e-5, 1e-3


def hyp2f1(a: float, b: float, c: Column, z: Column) -> Column:
    """Gauss 2F1(a, b; c; z) for 0 <= z < 1, JVM-side; the work grows with log(1 / (1 - z)) and c, without a limit.

    Where c - a is large, and up to z = 1/2, this is the power series at 0: term
    n is below (1 + n / c)^(a - c) there whatever z is.  Else value and slope at
    1/2 are carried on by Taylor expansions of the hypergeometric equation; a
    step goes half way to 1, and no further than 5 / c of its start, as longer
    steps would let the equation's other solution, about z^-c, blow up rounding
    errors.
    """
    terms = SHORT_TERMS + 4 * math.ceil(max(0.0, a, b))
    count = F.sequence(F.lit(0), F.lit(terms - 1))
    excess = c - (a + max(0.0, b))
    direct = excess >= 10.0
    z0 = F.when(direct, z).otherwise(F.least(z, F.lit(0.5)))
    enough = F.greatest(F.lit(terms), F.ceil(c * (F.exp(40.0 / F.greatest(excess, F.lit(10.0))) - 1.0)).cast("int"))
    powers = F.sequence(F.lit(0), F.when(direct, enough).otherwise(F.lit(terms)) - 1)

    def power(s, n):
        n = n.cast("double")
        nxt = s["term"] * (a + n) * (b + n) / ((c + n) * (n + 1.0)) * z0
        return F.struct(nxt.alias("term"), (s["f"] + s["term"]).alias("f"), (s["g"] + n * s["term"]).alias("g"))

    zero, one = F.lit(0.0), F.lit(1.0)
    start = F.aggregate(powers, F.struct(one.alias("term"), zero.alias("f"), zero.alias("g")), power)

    def step(s, _):
        at = s["z"]
        h = F.least(z - at, (1.0 - at) / 2.0, 5.0 * at / F.greatest(c, F.lit(1.0)))
        # u, v: terms n and n + 1 of the expansion at ``at``, times h^n and h^(n+1)
        first = F.struct(s["f"].alias("u"), (s["g"] * h).alias("v"), zero.alias("f"), zero.alias("g"))

        def taylor(t, n):
            n = n.cast("double")
            side = ((2.0 * at - 1.0) * n - (c - (a + b + 1.0) * at)) * (n + 1.0) * h
            nxt = (side * t["v"] + (n + a) * (n + b) * h * h * t["u"]) / (at * (1.0 - at) * (n + 2.0) * (n + 1.0))
            return F.struct(t["v"].alias("u"), nxt.alias("v"), (t["f"] + t["u"]).alias("f"), (t["g"] + n * t["u"]).alias("g"))

        done = F.aggregate(count, first, taylor)
        moved = F.struct(z.alias("z"), done["f"].alias("f"), (done["g"] / h).alias("g"))
        moved = F.when(h < z - at, F.struct((at + h).alias("z"), done["f"].alias("f"), (done["g"] / h).alias("g"))).otherwise(moved)
        return F.when(at >= z, s).otherwise(moved)

    halvings = F.ceil(-F.log2(F.lit(1.0) - z)) + F.ceil(F.greatest(c, F.lit(1.0)) / 5.0)
    steps = F.when(z > z0, F.sequence(F.lit(1).cast("bigint"), halvings.cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    begin = F.struct(z0.alias("z"), start["f"].alias("f"), (start["g"] * 2.0).alias("g"))
    return F.when(z <= z0, start["f"]).otherwise(F.aggregate(steps, begin, step)["f"])


def _purchase_factor(p: BGNBDParams, t: float, x: Column, T: Column) -> Column:
    """The part of C5 that depends on (x, T) alone.

    Uses Euler's transform: with z = t/(alpha+T+t) it is
    (a+b+x-1)/(a-1) * [1 - (1-z)^(a-1) * 2F1(a+b-1-r, a-1; a+b+x-1; z)],
    whose first two arguments do not grow with x (no overflow).  It has a
    removable gap at a = 1, where it is interpolated in ``a``.
    """
    z = F.lit(float(t)) / (F.lit(p.alpha) + T + F.lit(float(t)))

    def numerator(a: float) -> Column:
        cc = F.lit(a + p.b - 1.0) + x
        hyp = hyp2f1(a + p.b - 1.0 - p.r, a - 1.0, cc, z)
        return cc / F.lit(a - 1.0) * (1.0 - F.pow(1.0 - z, F.lit(a - 1.0)) * hyp)

    if abs(p.a - 1.0) < NEAR_ONE:
        nodes = [1.0 + k * NODE_SPACING for k in (-2, -1, 1, 2)]
        weight = [math.prod((p.a - m) / (n - m) for m in nodes if m != n) for n in nodes]
        return sum((F.lit(w) * numerator(n) for w, n in zip(weight, nodes)), F.lit(0.0))
    return numerator(p.a)


def _dropout_divisor(p: BGNBDParams, x: Column, t_x: Column, T: Column) -> Column:
    return 1.0 + F.when(x > 0, F.lit(p.a) / (F.lit(p.b) + x - 1.0)
                        * F.pow((p.alpha + T) / (p.alpha + t_x), F.lit(p.r) + x)).otherwise(F.lit(0.0))


def expected_purchases(params, t: float, x="frequency_cal", t_x="recency_cal", T="T_cal") -> Column:
    """E[purchases in (T, T+t] | x, t_x, T] as a Column; ``with_expected_purchases`` is cheaper on many rows."""
    p = _p(params)
    x, t_x, T = (F.col(c) if isinstance(c, str) else c for c in (x, t_x, T))
    return _purchase_factor(p, t, x, T) / _dropout_divisor(p, x, t_x, T)


#: Distinct (x, T) that are broadcast at most (24 bytes each); more are joined by a shuffle.
MAX_FACTORS = 1_000_000


def with_expected_purchases(df: DataFrame, params, t: float, out: str, x: str = "frequency_cal", t_x: str = "recency_cal",
                            T: str = "T_cal", max_factors: int = MAX_FACTORS) -> DataFrame:
    """C5 for every row of ``df``: the hypergeometric factor is evaluated once for each distinct (x, T).

    Whole days and counts repeat, so these are far fewer than customers. Their table is
    materialised and counted: up to ``max_factors`` rows it is broadcast, else joined by a shuffle.
    Rows with a null x or T get null.
    """
    p = _p(params)
    checkpoint_dir(df.sparkSession)
    pairs = df.select(F.col(x).alias("_x"), F.col(T).alias("_T")).filter(F.col("_x").isNotNull() & F.col("_T").isNotNull()).distinct()
    factors = pairs.withColumn("_factor", _purchase_factor(p, t, F.col("_x"), F.col("_T"))).checkpoint(eager=True)
    if factors.limit(max_factors + 1).count() <= max_factors:
        factors = F.broadcast(factors)
    j = df.join(factors, (F.col(x) == F.col("_x")) & (F.col(T) == F.col("_T")), "left")
    return j.withColumn(out, F.col("_factor") / _dropout_divisor(p, F.col(x), F.col(t_x), F.col(T))).drop("_x", "_T", "_factor")


# ------------------------------------------------------------------ likelihood & fit
def sufficient_stats(summary: DataFrame) -> DataFrame:
    """Distinct (x, t_x, T) with customer counts -- the only input of the fit."""
    return summary.groupBy(
        F.col("frequency_cal").alias("x"), F.col("recency_cal").alias("tx"), F.col("T_cal").alias("T")
    ).agg(F.count(F.lit(1)).cast("double").alias("w"))


def _tail_counts(stats: DataFrame) -> np.ndarray:
    """N(x > k) for k = 0..max_x-1 (collected: max_x numbers)."""
    rows = stats.groupBy("x").agg(F.sum("w").alias("w")).collect()
    if not rows:
        return np.zeros(0)
    mx = int(max(r["x"] for r in rows))
    cnt = np.zeros(mx + 1)
    for r in rows:
        cnt[int(r["x"])] += r["w"]
    # tail[k] = sum_{x > k} cnt[x]
    return np.cumsum(cnt[::-1])[::-1][1:]


def _gamma_part(tail: np.ndarray, r, a, b) -> float:
    k = np.arange(len(tail))
    return float(np.sum(tail * (np.log(r + k) + np.log(b + k) - np.log(a + b + k))))


PARAMETERS = ("r", "alpha", "a", "b")
#: A direction whose curvature is below this share of the largest is flat: data without dropouts, for one, push a to 0.
FLAT = 1e-8


def _gamma_derivatives(tail: np.ndarray, r, a, b) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of ``_gamma_part`` in (r, alpha, a, b)."""
    k = np.arange(len(tail))
    one = [float(np.sum(tail / (v + k))) for v in (r, b, a + b)]
    two = [-float(np.sum(tail / (v + k) ** 2)) for v in (r, b, a + b)]
    g = np.array([one[0], 0.0, -one[2], one[1] - one[2]])
    H = np.zeros((4, 4))
    H[0, 0] = two[0]
    H[2, 2] = H[2, 3] = H[3, 2] = -two[2]
    H[3, 3] = two[1] - two[2]
    return g, H


def _row_derivatives(point, scale: float, x, tx, T, w) -> np.ndarray:
    """Weighted sums over rows, all but the log-gammas: value, customers, gradient and (upper) Hessian in (r, alpha, a, b).

    A row's term is r ln(alpha) + ln(e^u + e^v); with s = e^v / (e^u + e^v) its derivatives are the
    weighted ones of u and v, and s (1 - s) times the products of their differences.
    """
    r, alpha, a, b = point
    at_T, at_tx, back = alpha + T * scale, alpha + tx * scale, b + np.maximum(x, 1.0) - 1.0
    u = -(r + x) * np.log(at_T)
    v = np.where(x > 0, math.log(a) - np.log(back) - (r + x) * np.log(at_tx), -np.inf)
    both = np.logaddexp(u, v)
    s = np.exp(v - both)
    zero = np.zeros_like(x)
    du = [-np.log(at_T), -(r + x) / at_T, zero, zero]
    dv = [-np.log(at_tx), -(r + x) / at_tx, zero + 1.0 / a, -1.0 / back]
    ddu = {(0, 1): -1.0 / at_T, (1, 1): (r + x) / at_T**2}
    ddv = {(0, 1): -1.0 / at_tx, (1, 1): (r + x) / at_tx**2, (2, 2): zero - 1.0 / a**2, (3, 3): 1.0 / back**2}
    n = w.sum()
    g = [w @ ((1.0 - s) * p + s * q) for p, q in zip(du, dv)]
    g[0], g[1] = g[0] + n * math.log(alpha), g[1] + n * r / alpha
    H = {(i, j): w @ (s * (1.0 - s) * (dv[i] - du[i]) * (dv[j] - du[j]) + (1.0 - s) * ddu.get((i, j), zero) + s * ddv.get((i, j), zero))
         for i in range(4) for j in range(i, 4)}
    H[0, 1] += n / alpha
    H[1, 1] -= n * r / alpha**2
    return np.array([w @ both + n * r * math.log(alpha), n, *g, *H.values()])


def loglik_with_derivatives(stats: DataFrame, point, scale: float):
    """(sum of row terms, gradient, Hessian, customers) at one parameter point, in ONE aggregate over (x, tx, T, w)."""
    point = tuple(map(float, point))
    value, n, *rest = summed(stats, ["x", "tx", "T", "w"], lambda *rows: _row_derivatives(point, scale, *rows), 16)
    H = np.zeros((4, 4))
    H[np.triu_indices(4)] = rest[4:]
    return value, np.array(rest[:4]), np.triu(H) + np.triu(H, 1).T, n


def fit_bgnbd(summary: DataFrame, penalizer: float = 0.0, x0=(1.0, 1.0, 1.0, 1.0),
              max_iter: int = 200) -> tuple[BGNBDParams, dict]:
    """Penalised maximum likelihood by Newton's method in log-parameters.

    Objective = -(mean log-likelihood) + penalizer * sum(params^2) with T
    scaled so that max(T) = 10 before the penalty.  ``info`` has, besides the
    optimiser's, ``standard_errors`` of the parameters from the observed
    information (None where a direction is flat, as at the border of the parameters).
    """
    # checkpoint: the optimiser re-reads this small table every step; cutting
    # the lineage keeps each step's planning and recovery independent of the
    # upstream pipeline (written to the shared spark.checkpoint.dir).
    stats = sufficient_stats(summary).checkpoint(eager=True)
    t_max = stats.agg(F.max("T")).first()[0]
    scale = 10.0 / t_max if t_max else 1.0
    tail = _tail_counts(stats)

    def objective(theta):
        p = np.exp(theta)
        value, g, H, n = loglik_with_derivatives(stats, p, scale)
        dg, dH = _gamma_derivatives(tail, p[0], p[2], p[3])
        f = -(value + _gamma_part(tail, p[0], p[2], p[3])) / n + penalizer * float(np.sum(p * p))
        return f, *_in_logs(p, -(g + dg) / n + 2.0 * penalizer * p, -(H + dH) / n + 2.0 * penalizer * np.eye(4))

    theta, info = minimize_newton(objective, np.log(np.asarray(x0, dtype=float)), max_iter=max_iter)
    n = stats.agg(F.sum("w")).first()[0]
    r, alpha, a, b = np.exp(theta)
    params = BGNBDParams(float(r), float(alpha / scale), float(a), float(b))
    info["standard_errors"] = standard_errors(info["hessian"], n, np.array([r, alpha / scale, a, b]), PARAMETERS)
    return params, info


def _in_logs(p: np.ndarray, g: np.ndarray, H: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian in the parameters' logarithms."""
    return p * g, H * np.outer(p, p) + np.diag(p * g)


def standard_errors(hessian: np.ndarray, n: float, p: np.ndarray, names) -> dict | None:
    """Standard errors of parameters ``p`` from the Hessian of the mean objective in their logarithms."""
    if not np.all(np.isfinite(hessian)):
        return None
    curvature = np.linalg.eigvalsh(hessian)
    if curvature[0] <= FLAT * curvature[-1]:
        return None
    return dict(zip(names, (p * np.sqrt(np.diag(np.linalg.inv(hessian)) / n)).tolist()))


def loglik(summary: DataFrame, params) -> DataFrame:
    """Total and mean BG/NBD log-likelihood of fixed parameters over a table (1 row).

    Written per row with the full log-gamma expression is not possible with
    built-ins (no lgamma); the integer-x identity above is exact, so the
    per-row part is aggregated in Spark and the gamma part added from tail
    counts -- returned here as a one-row DataFrame for reporting.
    """
    p = _p(params)
    stats = sufficient_stats(summary)
    value, _, _, n = loglik_with_derivatives(stats, (p.r, p.alpha, p.a, p.b), 1.0)
    tail = _tail_counts(stats)
    total = value + _gamma_part(tail, p.r, p.a, p.b) if n else 0.0
    spark = summary.sparkSession
    return spark.createDataFrame([(float(n or 0), total, total / n if n else None)],
                                 "customers double, loglik double, mean_loglik double")


def loglik_rows(params, x="frequency_cal", t_x="recency_cal", T="T_cal") -> Column:
    """C2 per customer, fully as a Column: log-gamma differences over the
    integer x are summed as logs of consecutive factors."""
    p = _p(params)
    x, t_x, T = (F.col(c) if isinstance(c, str) else c for c in (x, t_x, T))
    g = F.aggregate(
        F.sequence(F.lit(0), x.cast("int") - 1), F.lit(0.0),
        lambda acc, k: acc + F.log(F.lit(p.r) + k) + F.log(F.lit(p.b) + k) - F.log(F.lit(p.a + p.b) + k),
    )
    gam = F.when(x > 0, g).otherwise(F.lit(0.0))
    a3 = -(F.lit(p.r) + x) * F.log(F.lit(p.alpha) + T)
    a4 = (F.log(F.lit(p.a)) - F.log(F.lit(p.b) + F.greatest(x, F.lit(1.0)) - 1.0)
          - (F.lit(p.r) + x) * F.log(t_x + p.alpha))
    mx = F.greatest(a3, a4)
    lse = mx + F.log(F.exp(a3 - mx) + F.when(x > 0, F.exp(a4 - mx)).otherwise(F.lit(0.0)))
    return gam + F.lit(p.r) * F.log(F.lit(p.alpha)) + lse
