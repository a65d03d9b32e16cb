"""Evaluation metrics.

Rank-based metrics use distributed average ranks over distinct values;
curves group by distinct score first, so a score shared by a third of all
customers is a single row before any ordering.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.functions import money
from valuescope.functions.digests import md5_heads
from valuescope.operators.common import attach_one_row
from valuescope.operators.ordered import average_rank, global_order, quantile_bins
from valuescope.session import let_workers_import


def regression_metrics(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """MAE, RMSE and MAPE (over non-zero actuals only); one row."""
    err = F.col(y_true) - F.col(y_pred)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.when(F.col(y_true) != 0, F.abs(err / F.col(y_true)))).alias("mape"),
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman rho = Pearson correlation of average ranks; NULL when either
    side is constant. One row (n, spearman)."""
    base = df.select("customer_id", F.col(x).alias("_x"), F.col(y).alias("_y"))
    rx = average_rank(base, "_x", "_rx")
    r = average_rank(rx, "_y", "_ry")
    return r.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.when((F.min("_x") < F.max("_x")) & (F.min("_y") < F.max("_y")), F.corr("_rx", "_ry"))
        .alias("spearman"),
    )


def with_deciles(df: DataFrame, score: str, q: int = 10, out: str = "decile") -> DataFrame:
    """W1+W2: rank (ties by customer_id) ascending by score, then q equal-count bins."""
    return quantile_bins(df, {out: score}, q)


def binned(df: DataFrame, score: str = "clv_horizon", actual: str = "holdout_revenue", q: int = 10) -> DataFrame:
    """customer_id, ``_s``, ``_y`` and decile; a frame that is binned already is returned as it is."""
    if {"_s", "_y", "decile"} <= set(df.columns):
        return df
    work = df.select("customer_id", F.coalesce(F.col(score), F.lit(0.0)).alias("_s"),
                     F.coalesce(F.col(actual), F.lit(0.0)).alias("_y"))
    return with_deciles(work, "_s", q)


def decile_lift(df: DataFrame, score: str = "clv_horizon", actual: str = "holdout_revenue",
                q: int = 10, ci: DataFrame | None = None) -> DataFrame:
    """Customers, mean predicted, mean/total actual and lift per decile
    (decile q = highest score); optional CI table left-joined on decile (J9)."""
    d = binned(df, score, actual, q)
    g = d.groupBy("decile").agg(
        F.count_distinct("customer_id").cast("bigint").alias("customers"),
        F.avg("_s").alias("avg_pred_clv"),
        F.sum(money("_y")).alias("_tot"),
        F.count(F.lit(1)).alias("_n"),
    )
    # q rows: the overall mean comes from the deciles' sums
    overall = g.agg((F.sum("_tot").cast("double") / F.sum("_n")).alias("_mean"))
    g = attach_one_row(g, overall)
    avg_y = F.col("_tot").cast("double") / F.col("_n")
    out = g.select(
        "decile", "customers",
        F.round("avg_pred_clv", 6).alias("avg_pred_clv"),
        F.round(avg_y, 6).alias("avg_holdout_revenue"),
        F.col("_tot").cast("double").alias("total_holdout_revenue"),
        F.round(F.when(F.col("_mean") > 0, avg_y / F.col("_mean")), 6).alias("lift_vs_overall_mean"),
    )
    if ci is not None:
        out = out.join(F.broadcast(ci.select("decile", "ci_lower", "ci_upper")), "decile", "left")
    return out


#: Customers of one bin and amount that share a draw at most; the terms of their Poisson distribution are bounded by it.
DRAW_SIZE = 512
#: Amounts of a batch that are drawn at a time.
DRAW_ROWS = 4096


def poisson_table(sizes: DataFrame) -> DataFrame:
    """n and cdf, the distribution function of Poisson(n) at 0, 1, ..., for distinct n; as far as a 32-bit uniform reaches."""
    n = F.col("n").cast("double")
    last = (n + 8.0 * F.sqrt(n) + 16.0).cast("int")

    def step(s, k):
        p = s["p"] * n / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["cdf"], F.array(s["c"] + p)).alias("cdf"))

    p0 = F.exp(-n)
    start = F.struct(p0.alias("p"), p0.alias("c"), F.array(p0).alias("cdf"))
    return sizes.select("n").distinct().select("n", F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"].alias("cdf"))


def _integer_parts(amounts: pa.Array) -> list[np.ndarray]:
    """A decimal column as integers of its last place, value = a + b * 2^32 + c * 2^64; NULL counts as 0."""
    low, high = np.frombuffer(amounts.buffers()[1], "<u8").reshape(-1, 2)[amounts.offset : amounts.offset + len(amounts)].T
    parts = [(low & np.uint64(0xFFFFFFFF)).astype(np.int64), (low >> np.uint64(32)).astype(np.int64), high.astype(np.int64)]
    null = amounts.is_null().to_numpy(zero_copy_only=False)
    return [np.where(null, 0, x) for x in parts]


def weighted_sums(seed: int, n_boot: int):
    """Arrow function of the bootstrap's rows: (decile, rep, sum of amount x weight, sum of weights) of a task."""
    prefixes = [f"{seed}|{rep}|".encode() for rep in range(1, n_boot + 1)]

    def run(batches):
        weights, totals, kind = {}, {}, None  # decile -> n_boot numbers; without an entry in totals, no amount
        for batch in batches:
            kind = batch.column("decile").type
            names = batch.column("decile").to_pylist()
            codes = {name: i for i, name in enumerate(dict.fromkeys(names))}
            decile, n = np.array([codes[x] for x in names], np.int64), batch.column("n").to_numpy()
            order = np.lexsort((n, decile))
            tails = np.array(batch.column("tail").cast(pa.binary()).to_pylist())
            parts = _integer_parts(batch.column("_m"))
            present = batch.column("_m").is_valid().to_numpy(zero_copy_only=False)
            known = {}  # the uniforms, as 32-bit integers, from which on a weight is one more
            for i in order[np.unique(n[order], return_index=True)[1]] if len(n) else ():
                steps = np.ceil(batch.column("cdf")[int(i)].values.to_numpy() * 2.0**32)
                known[n[i]] = steps[steps < 2.0**32].astype(np.uint32)
            for at in (order[i : i + DRAW_ROWS] for i in range(0, len(order), DRAW_ROWS)):
                runs = np.flatnonzero(np.diff(n[at], prepend=-1) | np.diff(decile[at], prepend=-1))
                starts = np.flatnonzero(np.diff(decile[at], prepend=-1))
                rep = 0
                for u in md5_heads(prefixes, tails[at]):
                    w = np.empty(u.shape, np.int64)
                    for i, j in zip(runs, [*runs[1:], len(at)]):
                        w[:, i:j] = np.searchsorted(known[n[at[i]]], u[:, i:j], "right")
                    sums = [np.add.reduceat(w, starts, axis=1)]
                    sums += [np.add.reduceat(w * p[at], starts, axis=1) if p[at].any() else None for p in parts]
                    for k, i in enumerate(starts):
                        key, reps = names[at[i]], slice(rep, rep + len(u))
                        weights.setdefault(key, np.zeros(n_boot, np.int64))[reps] += sums[0][:, k]
                        if present[at[i : starts[k + 1] if k + 1 < len(starts) else len(at)]].any():
                            total = totals.setdefault(key, np.zeros(n_boot, object))
                            for p, s in enumerate(sums[1:]):
                                if s is not None:
                                    total[reps] += s[:, k].astype(object) << (32 * p)
                    rep += len(u)
        exact = decimal.Context(prec=60)
        for key, w in weights.items():
            y = [exact.scaleb(decimal.Decimal(t), -10) for t in totals[key]] if key in totals else [None] * n_boot
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * n_boot, kind), pa.array(range(1, n_boot + 1), pa.int32()), pa.array(y, pa.decimal128(38, 10)), pa.array(w)],
                ["decile", "rep", "_sy", "_sw"])

    return run


def bootstrap_decile_ci(df: DataFrame, score: str = "clv_horizon", actual: str = "holdout_revenue",
                        n_boot: int = 500, ci_level: float = 0.95, seed: int = 42, q: int = 10) -> DataFrame:
    """Percentile CI of each decile's mean actual under Poisson bootstrap weights.

    Customers of one decile with equal actuals are one row of count n, whose
    weight in a replicate is Poisson(n): the sum of their n Poisson(1) weights.
    It comes by inversion from one md5 of (seed, replicate, decile, part, amount),
    so the result does not depend on partitioning. Counts above ``DRAW_SIZE`` are
    drawn in parts of that size. Work thus grows with distinct amounts, not with
    customers, and the many without revenue are a few rows. The amounts are dealt over
    the tasks, each of which digests and sums its rows for all replicates a block at a time
    (numpy), and hands on at most q * n_boot rows.
    ``df`` may be binned already.
    """
    d = binned(df, score, actual, q).groupBy("decile", money("_y").alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    d = d.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / DRAW_SIZE))).alias("part"))
    d = d.withColumn("n", F.least(F.lit(DRAW_SIZE), F.col("_n") - F.col("part") * DRAW_SIZE))
    # each row makes n_boot digests, so small inputs are spread over as many tasks as shuffles have
    d = d.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "decile", "_m", "part")
    d = d.join(F.broadcast(poisson_table(d)), "n")  # at most DRAW_SIZE rows
    tail = F.concat_ws("|", F.col("decile").cast("string"), F.col("part").cast("string"), F.col("_m").cast("string"))
    let_workers_import(df.sparkSession)
    per = d.select("decile", "n", "_m", tail.alias("tail"), "cdf").mapInArrow(
        weighted_sums(seed, n_boot), f"decile {d.schema['decile'].dataType.simpleString()}, rep int, _sy decimal(38,10), _sw bigint")
    per = per.groupBy("decile", "rep").agg(F.sum("_sy").alias("_sy"), F.sum("_sw").alias("_sw"))
    per = per.select("decile", "rep",
                     F.when(F.col("_sw") > 0, F.col("_sy").cast("double") / F.col("_sw")).otherwise(0.0)
                     .alias("m"))  # a decile that drew no weight counts as 0
    alpha = 1.0 - ci_level
    return per.groupBy("decile").agg(
        F.round(F.percentile("m", alpha / 2), 6).alias("ci_lower"),
        F.round(F.percentile("m", 1 - alpha / 2), 6).alias("ci_upper"),
        F.lit(float(ci_level)).alias("ci_level"),
        F.lit(n_boot).cast("bigint").alias("n_bootstrap"),
    )


# ------------------------------------------------------------------ classification
def _score_table(df: DataFrame, label: str, score: str, *by: str) -> DataFrame:
    """(score, pos, neg) per distinct score (of each group)."""
    return df.groupBy(*by, F.col(score).alias("_p")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"),
        F.sum((1 - F.col(label).cast("long"))).alias("_neg"),
    )


def classification_metrics(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """ROC AUC (rank-sum, ties averaged), average precision (step-wise)
    and base rate; AUC/AP NULL when only one class is present. One row, or one
    per value of ``by`` (few values, such as folds), in one pass."""
    groups = [by] if by else []
    tab = _score_table(df, label, score, *groups)
    # descending score order with running TP/FP (one row per distinct score)
    o = global_order(tab, "_p", tie="_p", descending=True, n=None, group=by,
                     sums={"_tp": F.col("_pos"), "_fp": F.col("_neg")})
    tot = tab.groupBy(*groups).agg(F.sum("_pos").alias("_n1"), F.sum("_neg").alias("_n0"))
    if by:
        tot = tot.withColumnRenamed(by, "_tby")
        o = o.join(F.broadcast(tot), F.col(by).eqNullSafe(F.col("_tby")), "inner").drop("_tby")
    else:
        o = attach_one_row(o, tot)
    # rank-sum AUC with ascending average ranks: rank = n - (cum before desc) ... computed per distinct score
    n_all = F.col("_n1") + F.col("_n0")
    cnt = F.col("_pos") + F.col("_neg")
    before_desc = F.col("_tp") + F.col("_fp") - cnt
    avg_rank_asc = n_all - before_desc - (cnt - 1) / 2.0
    res = o.groupBy(*groups).agg(
        F.first("_n1").alias("n1"), F.first("_n0").alias("n0"),
        F.sum(F.col("_pos") * avg_rank_asc).alias("rank_sum"),
        F.sum(F.when(F.col("_n1") > 0, F.col("_pos") / F.col("_n1") * (F.col("_tp") / (F.col("_tp") + F.col("_fp")))))
        .alias("ap"),
    )
    both = (F.col("n1") > 0) & (F.col("n0") > 0)
    auc = (F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2.0) / (F.col("n1") * F.col("n0"))
    return res.select(
        *groups,
        (F.col("n1") + F.col("n0")).cast("bigint").alias("n"),
        F.when(both, auc).alias("roc_auc"),
        F.when(both, F.col("ap")).alias("avg_precision"),
        (F.col("n1") / (F.col("n1") + F.col("n0"))).alias("churn_base_rate"),
    )


def roc_pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct threshold (descending): counts at the
    threshold, cumulative tp/fp, fpr, tpr, precision, recall."""
    tab = _score_table(df, label, score)
    o = global_order(tab, "_p", tie="_p", descending=True, n=None, rn="step",
                     sums={"_tp": F.col("_pos"), "_fp": F.col("_neg")})
    tot = tab.agg(F.sum("_pos").alias("_n1"), F.sum("_neg").alias("_n0"))
    o = attach_one_row(o, tot)
    return o.select(
        "step", F.col("_p").alias("threshold"),
        F.col("_pos").cast("bigint").alias("pos"), F.col("_neg").cast("bigint").alias("neg"),
        F.col("_tp").cast("bigint").alias("tp"), F.col("_fp").cast("bigint").alias("fp"),
        F.col("_n1").cast("bigint").alias("n1"), F.col("_n0").cast("bigint").alias("n0"),
        F.round(F.try_divide(F.col("_fp"), F.col("_n0")), 9).alias("fpr"),
        F.round(F.try_divide(F.col("_tp"), F.col("_n1")), 9).alias("tpr"),
        F.round(F.col("_tp") / (F.col("_tp") + F.col("_fp")), 9).alias("precision"),
        F.round(F.try_divide(F.col("_tp"), F.col("_n1")), 9).alias("recall"),
    )


def curve_areas(points: DataFrame) -> DataFrame:
    """Trapezoid ROC area (from (0,0)) and PR area (from recall 0,
    precision 1).  Each segment needs only the point's own counts and the
    running totals, so no ordered pass (lag) over the points is required.
    NULL areas when a class is missing."""
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    tpr, tpr_prev = F.try_divide(tp, n1), F.try_divide(tp - pos, n1)
    prec = tp / (tp + fp)
    prev_all = tp - pos + fp - neg
    prec_prev = F.when(prev_all > 0, (tp - pos) / prev_all).otherwise(F.lit(1.0))
    return points.agg(
        F.round(F.sum(F.try_divide(neg, n0) * (tpr + tpr_prev) / 2.0), 6).alias("roc_area"),
        F.round(F.sum(F.try_divide(pos, n1) * (prec + prec_prev) / 2.0), 6).alias("pr_area"),
        F.round(F.first(n1 / (n1 + n0)), 6).alias("no_skill_precision"),
    )


# Uniform calibration bin edges 0, 0.1, ..., 1 as produced by linspace.
CALIBRATION_EDGES = [float(e) for e in np.linspace(0.0, 1.0, 11)]


def calibration_table(df: DataFrame, label: str, score: str, n_bins: int = 10) -> DataFrame:
    """Uniform bins, left-open (edge e goes to the lower bin), empty bins dropped."""
    edges = [float(e) for e in np.linspace(0.0, 1.0, n_bins + 1)][1:-1]
    b = sum((F.col(score) > F.lit(e)).cast("int") for e in edges)
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"),
        F.round(F.avg(F.col(score)), 6).alias("mean_predicted"),
        F.round(F.avg(F.col(label).cast("double")), 6).alias("fraction_positive"),
    )
