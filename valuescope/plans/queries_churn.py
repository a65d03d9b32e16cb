"""Phase 6 queries: churn labels, snapshot, preprocessing statistics, folds,
classification metrics and curves (SQL-checked), model training (rows-only)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from valuescope.operators import churn as CH
from valuescope.operators import features as FE
from valuescope.operators import metrics as ME
from valuescope.params import TESTDATA_PARAMS
from valuescope.plans import sql as S
from valuescope.plans.catalog import register
from valuescope.plans.materialize import materialize
from valuescope.plans.queries_clv import dbl
from valuescope.plans.queries_core import txn_orders
from valuescope.plans.queries_policy import INPUTS, policy_inputs
from valuescope.schemas import FEATURE_COLUMNS
from valuescope.session import checkpoint_dir
from valuescope.sources.sinks import load_model, save_model

P = TESTDATA_PARAMS
C = S.ts(P.cutoff)


def churn_base(spark, sf_dir):
    amounts = materialize(FE.invoice_amounts(txn_orders(spark, sf_dir)))  # line items are joined and cleaned once
    inv = materialize(FE.invoices(amounts))
    feats = materialize(FE.customer_features(amounts, P.cutoff))
    return inv, feats


def snapshot(spark, sf_dir):
    inv, feats = churn_base(spark, sf_dir)
    lab = CH.churn_labels(inv, feats, P.cutoff, P.prediction_horizon_days, P.inactivity_days)
    return CH.build_snapshot(feats, lab, P.cutoff, P.prediction_horizon_days, P.inactivity_days)


def scored_eval(spark, sf_dir):
    """Churn labels at the cutoff scored by BG/NBD risk = 1 - P(alive)."""
    snap = snapshot(spark, sf_dir).select("customer_id", "churn_label")
    _, risk = policy_inputs(spark, sf_dir)
    return materialize(snap.join(risk.select("customer_id", "churn_probability"), "customer_id", "inner"))


# ---------------------------------------------------------------- SQL
END = S.ts(P.cutoff + dt.timedelta(days=P.prediction_horizon_days))
LABELS = f"""post AS (
  SELECT customer_id, min(invoice_dt) AS fp FROM inv WHERE invoice_dt > {C} AND invoice_dt <= {END} GROUP BY customer_id
),
labels AS (
  SELECT f.customer_id, p.fp AS first_purchase_post_cutoff, {S.days(C, 'p.fp')} AS days_to_next_purchase,
    CAST(CASE WHEN p.fp IS NULL OR {S.days(C, 'p.fp')} > {P.inactivity_days} THEN 1 ELSE 0 END AS INTEGER) AS churn_label
  FROM features f LEFT JOIN post p ON f.customer_id = p.customer_id
),
snap AS (
  SELECT f.*, l.first_purchase_post_cutoff, l.days_to_next_purchase, CAST(coalesce(l.churn_label, 1) AS INTEGER) AS churn_label,
    DATE '{P.cutoff.date().isoformat()}' AS cutoff_date, CAST({P.prediction_horizon_days} AS BIGINT) AS prediction_horizon_days,
    CAST({P.inactivity_days} AS BIGINT) AS churn_inactivity_days
  FROM features f LEFT JOIN labels l ON f.customer_id = l.customer_id
)"""

BASE_SQL = S.with_(S.txn_cte("orders"), S.INVOICES, S.features_cte(P.cutoff), LABELS)


@register("churn_labels", BASE_SQL + "SELECT customer_id, first_purchase_post_cutoff, days_to_next_purchase, churn_label FROM labels",
          "A11 J2 F8 P9 P11")
def q_churn_labels(spark, sf_dir):
    inv, feats = churn_base(spark, sf_dir)
    return CH.churn_labels(inv, feats, P.cutoff, P.prediction_horizon_days, P.inactivity_days)


@register("churn_snapshot", BASE_SQL + "SELECT * FROM snap", "M1 J1 P6 P19")
def q_churn_snapshot(spark, sf_dir):
    return snapshot(spark, sf_dir)


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM snap" for c in FEATURE_COLUMNS)


@register(
    "feature_scaling_stats",
    BASE_SQL + f""", lg AS ({_LONG}),
med AS (SELECT feature, quantile_cont(value, 0.5) AS median, count(value) AS n FROM lg GROUP BY feature),
imp AS (SELECT l.feature, coalesce(l.value, m.median) AS v FROM lg l JOIN med m ON l.feature = m.feature)
SELECT m.feature, round(m.median, 6) AS median, round(avg(i.v), 6) AS mean, round(stddev_pop(i.v), 6) AS std,
  CAST(m.n AS BIGINT) AS n
FROM med m JOIN imp i ON m.feature = i.feature GROUP BY m.feature, m.median, m.n""",
    "M2 M3",
)
def q_feature_scaling_stats(spark, sf_dir):
    st = CH.feature_stats(snapshot(spark, sf_dir))
    return st.select("feature", *[F.round(c, 6).alias(c) for c in ("median", "mean", "std")], "n")


@register(
    "class_weights",
    BASE_SQL + """SELECT churn_label, CAST(count(*) AS BIGINT) AS n_class,
  (SELECT count(*) FROM snap) / (2.0 * count(*)) AS weight FROM snap GROUP BY churn_label""",
    "M4",
)
def q_class_weights(spark, sf_dir):
    return CH.class_weights(snapshot(spark, sf_dir))


_MD5 = "CAST(('0x' || substr(md5(concat_ws('|', {seed}, customer_id)), 1, 8)) AS BIGINT) / CAST('4294967296.0' AS DOUBLE)"


@register(
    "fold_assignment",
    BASE_SQL + f"""SELECT customer_id, churn_label,
  CAST((row_number() OVER (PARTITION BY churn_label ORDER BY {_MD5.format(seed=P.seed)}, customer_id) - 1) % {P.n_folds} AS INTEGER) AS fold
FROM snap""",
    "M9",
)
def q_fold_assignment(spark, sf_dir):
    return CH.assign_folds(snapshot(spark, sf_dir).select("customer_id", "churn_label"), P.n_folds, P.seed)


EVAL_SQL = INPUTS[:-1].replace("WITH RECURSIVE ", "WITH RECURSIVE ", 1) + ",\n" + ",\n".join(
    [S.features_cte(P.cutoff), LABELS]) + """,
ev AS (SELECT s.customer_id, s.churn_label AS y, i.churn_probability AS p FROM snap s JOIN inputs i ON s.customer_id = i.customer_id),
tab AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM ev GROUP BY p),
tot AS (SELECT sum(pos) AS n1, sum(neg) AS n0 FROM tab),
o AS (
  SELECT p, pos, neg, row_number() OVER (ORDER BY p DESC) AS step,
    sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM tab
)
"""


@register(
    "churn_risk_metrics",
    EVAL_SQL + """SELECT CAST(max(n1) + max(n0) AS BIGINT) AS n,
  round(CASE WHEN max(n1) > 0 AND max(n0) > 0 THEN
    (sum(pos * ((n1 + n0) - (tp + fp - (pos + neg)) - ((pos + neg) - 1) / 2.0)) - max(n1) * (max(n1) + 1) / 2.0) / (max(n1) * max(n0)) END, 6) AS roc_auc,
  round(CASE WHEN max(n1) > 0 AND max(n0) > 0 THEN sum(pos / n1 * (tp / (tp + fp))) END, 6) AS avg_precision,
  round(max(n1) / (max(n1) + max(n0)), 6) AS churn_base_rate
FROM o CROSS JOIN tot""",
    "M12 W5",
)
def q_churn_risk_metrics(spark, sf_dir):
    m = ME.classification_metrics(scored_eval(spark, sf_dir), "churn_label", "churn_probability")
    return m.select("n", *[F.round(c, 6).alias(c) for c in m.columns[1:]])


@register(
    "roc_pr_points",
    EVAL_SQL + """SELECT step, p AS threshold, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(tp AS BIGINT) AS tp,
  CAST(fp AS BIGINT) AS fp, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0, round(fp / n0, 9) AS fpr, round(tp / n1, 9) AS tpr,
  round(tp / (tp + fp), 9) AS precision, round(tp / n1, 9) AS recall
FROM o CROSS JOIN tot""",
    "M13 M14",
)
def q_roc_pr_points(spark, sf_dir):
    return ME.roc_pr_points(scored_eval(spark, sf_dir), "churn_label", "churn_probability")


@register(
    "curve_areas",
    EVAL_SQL + """SELECT round(sum(neg / n0 * ((tp / n1) + ((tp - pos) / n1)) / 2.0), 6) AS roc_area,
  round(sum(pos / n1 * ((tp / (tp + fp)) + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE 1.0 END) / 2.0), 6) AS pr_area,
  round(max(n1 / (n1 + n0)), 6) AS no_skill_precision
FROM o CROSS JOIN tot""",
    "M13 M14",
)
def q_curve_areas(spark, sf_dir):
    return ME.curve_areas(ME.roc_pr_points(scored_eval(spark, sf_dir), "churn_label", "churn_probability"))


_EDGES = ME.CALIBRATION_EDGES[1:-1]


@register(
    "calibration_table",
    EVAL_SQL + f"""SELECT CAST({' + '.join(f'(CASE WHEN p > {dbl(e)} THEN 1 ELSE 0 END)' for e in _EDGES)} AS INTEGER) AS bin,
  CAST(count(*) AS BIGINT) AS count, round(avg(p), 6) AS mean_predicted, round(avg(CAST(y AS DOUBLE)), 6) AS fraction_positive
FROM ev GROUP BY 1""",
    "M15",
)
def q_calibration_table(spark, sf_dir):
    return ME.calibration_table(scored_eval(spark, sf_dir), "churn_label", "churn_probability")


@register("churn_scores", None, "M2 M3 M4 M5 M16 M17 M18 M20 M21 (logistic; rows-only)")
def q_churn_scores(spark, sf_dir):
    inv, feats = churn_base(spark, sf_dir)
    out = CH.train_and_evaluate(inv, feats, P.cutoff, P.prediction_horizon_days, P.inactivity_days,
                                P.eval_gap_days, model="logistic_regression", k=P.n_folds, seed=P.seed)
    return out["scores"]


@register("churn_feature_importance", None, "M16 M17 M18 (rows-only)")
def q_churn_feature_importance(spark, sf_dir):
    inv, feats = churn_base(spark, sf_dir)
    out = CH.train_and_evaluate(inv, feats, P.cutoff, P.prediction_horizon_days, P.inactivity_days,
                                P.eval_gap_days, model="logistic_regression", k=P.n_folds, seed=P.seed)
    return out["importance"]


@register("churn_cv_logistic", None, "M5 M9 M10 (per-fold out-of-fold metrics; rows-only)")
def q_churn_cv_logistic(spark, sf_dir):
    return CH.cross_validate(snapshot(spark, sf_dir), "logistic_regression", P.n_folds, P.seed)


@register("churn_model_comparison", None, "M5 M6 M7 M8 M9 M10 M11 (four candidates x five folds; rows-only)")
def q_churn_model_comparison(spark, sf_dir):
    comp, best = CH.compare_models(snapshot(spark, sf_dir), P.n_folds, P.seed)
    return comp.withColumn("chosen", F.col("model") == best)


@register(
    "saved_model_scores",
    BASE_SQL + "SELECT customer_id, true AS equal_scores FROM features",
    "S7 S8 (a saved whole model scores raw features as the fitted one does)",
)
def q_saved_model_scores(spark, sf_dir):
    """Fits, saves and loads the whole model, and scores raw features with both."""
    snap = materialize(snapshot(spark, sf_dir))
    model, _, score = CH.fit_model(snap, "logistic_regression", P.seed)
    path = f"{checkpoint_dir(spark).rstrip('/')}/churn-model-{uuid.uuid4().hex}"
    save_model(model, path)
    raw = snap.select("customer_id", *FEATURE_COLUMNS)
    loaded = CH.score_with(load_model(path), raw).withColumnRenamed("churn_probability", "loaded")
    return score(raw).join(loaded, "customer_id").select(
        "customer_id", (F.abs(F.col("churn_probability") - F.col("loaded")) <= 1e-12).alias("equal_scores"))


# ---------------------------------------------------------------- M16-M18 under fixed coefficients
#: Coefficients of the standardised features, in the order of FEATURE_COLUMNS.
FIXED_COEF = [0.9, -0.2, -0.8, -0.3, 0.1, -0.25, -0.4, 0.05]


def fixed_attributions(spark, sf_dir):
    snap = materialize(snapshot(spark, sf_dir))
    scaled = CH.preprocess(snap, CH.collect_stats(CH.feature_stats(snap)))
    return CH.linear_attributions(scaled, FIXED_COEF)


_Z = ", ".join(
    f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1.0 END AS {c}"
    for c in FEATURE_COLUMNS)
_Z_SQL = BASE_SQL + f", z AS (SELECT customer_id, {_Z} FROM snap)\n"


@register(
    "churn_attributions_fixed",
    _Z_SQL + "SELECT customer_id, " + ", ".join(
        f"round({dbl(b)} * {c}, 6) AS attr_{c}" for c, b in zip(FEATURE_COLUMNS, FIXED_COEF)) + " FROM z",
    "M2 M3 M17",
)
def q_churn_attributions_fixed(spark, sf_dir):
    return fixed_attributions(spark, sf_dir).select("customer_id", *[F.round(f"attr_{c}", 6).alias(f"attr_{c}") for c in FEATURE_COLUMNS])


@register(
    "churn_importance_fixed",
    _Z_SQL + ", lg AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS x, {dbl(b)} * {c} AS a, {dbl(b)} AS b FROM z" for c, b in zip(FEATURE_COLUMNS, FIXED_COEF))
    + """)
SELECT feature, b AS coefficient, abs(b) AS abs_coefficient, CASE WHEN b > 0 THEN 'increases_churn' ELSE 'decreases_churn' END AS coefficient_direction,
  round(avg(abs(a)), 6) AS importance_score, CASE WHEN corr(x, a) > 0 THEN 'increases_churn' ELSE 'decreases_churn' END AS direction
FROM lg GROUP BY feature, b""",
    "M16 M18",
)
def q_churn_importance_fixed(spark, sf_dir):
    by_coef = CH.coefficient_importance(spark, FIXED_COEF).withColumnRenamed("direction", "coefficient_direction")
    by_attr = CH.attribution_importance(fixed_attributions(spark, sf_dir))
    return by_coef.join(by_attr, "feature").select(
        "feature", "coefficient", "abs_coefficient", "coefficient_direction", F.round("importance_score", 6).alias("importance_score"), "direction")
