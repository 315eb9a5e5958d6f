"""Metric, decision, serving-alignment and attribution queries over the ``scored`` fixture."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sqlexpr import bin_index_sql
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import profile as PR
from ..operators import scoring as S
from ..params import DEFAULTS, FEATURE_COLS
from . import oracle_base as O
from .stages import split_table

THRESHOLD = DEFAULTS.predict.prediction_threshold
# fixed values: scorers that stand for the trials of a search (weights of a logistic score, intercept)
TRIAL_SCORERS = (
    (S.FIXED_COEF, S.FIXED_INTERCEPT),
    ((("PAY_0", 1.0), ("PAY_3", 0.2)), -1.0),
    ((("n_months_delayed", 0.9), ("util_ratio", -0.7)), -2.0),
    ((("pay_delay_max", 0.5), ("pct_paid", -1.1), ("SEX", 0.1)), 0.0),
)
# fixed values: a linear score over more columns than the top list shows
WIDE_COEF = (
    ("LIMIT_BAL", -0.000002), ("SEX", 0.1), ("EDUCATION", -0.15), ("MARRIAGE", 0.12), ("AGE", 0.01), ("PAY_0", 0.8),
    ("PAY_2", 0.4), ("PAY_3", 0.2), ("pay_delay_max", 0.3), ("n_months_delayed", 0.5), ("util_ratio", 0.6), ("pct_paid", -0.9),
)
WIDE_INTERCEPT = -1.25
FEATS = [c for c, _ in S.FIXED_COEF]


def _split(spark, sf, name):
    s = split_table(spark, sf)
    return s.filter(F.col("split") == name)


def scored(spark: SparkSession, sf: str, split: str) -> DataFrame:
    return S.fixed_scores(_split(spark, sf, split))


# ---------------------------------------------------------------- spark side
def q_score_decisions(spark: SparkSession, sf: str) -> DataFrame:
    s = scored(spark, sf, "test")
    return s.select("customer_id", F.col("score").alias("default_proba"), S.decide(F.col("score"), THRESHOLD).alias("prediction"))


def q_decision_log(spark: SparkSession, sf: str) -> DataFrame:
    """The 7-field decision summary of the scored test rows."""
    s = scored(spark, sf, "test").withColumn("pred", S.decide(F.col("score"), THRESHOLD))
    return S.decision_log(s, THRESHOLD, "score", "pred")


def q_score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """40 equal-width bins of the test scores."""
    s = scored(spark, sf, "test").select(F.lit("test").alias("batch"), F.col("score").alias("value"))
    return PR.density_histogram(s, "batch", 40).drop("batch")


def q_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return M.roc_auc(scored(spark, sf, "val"), "score", "label")


def q_pr_auc(spark: SparkSession, sf: str) -> DataFrame:
    return M.average_precision(scored(spark, sf, "val"), "score", "label")


def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion(scored(spark, sf, "val"), "prediction", "label")


def q_threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return M.threshold_sweep(scored(spark, sf, "val"), "score", "label", 20)


def q_align_features(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse request maps (non-zero features + an unknown key) aligned back to the
    model's features, scored, rounded to 4, decided on the unrounded probability."""
    t = _split(spark, sf, "test")
    req = t.select("customer_id", S.sparse_request(t, FEATURE_COLS, {"unknown_field": 1.0}).alias("features"))
    aligned = req.select("customer_id", *S.align_request(F.col("features"), FEATS))
    p = F.expr(f"1.0 / (1.0 + exp(-{S.margin_sql()}))")
    return aligned.select("customer_id", F.round(p, 4).alias("default_probability"),
                          S.decide(p, THRESHOLD).alias("prediction"), F.lit(THRESHOLD).alias("threshold"))


def q_trial_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """M7/M8/V1-V4: metrics of several trials from one long table of their validation scores, ranked."""
    val = _split(spark, sf, "val")
    scores = F.array(*[F.struct(F.lit(i).alias("trial"), F.expr(S.score_sql(c, b)).alias("proba")) for i, (c, b) in enumerate(TRIAL_SCORERS)])
    long = val.select(F.col("default").cast("int").alias("label"), F.explode(scores).alias("s")).select("label", "s.*")
    m = MD.trial_metrics(long, DEFAULTS.train, THRESHOLD)
    ranked = Window.orderBy(F.desc(F.round(DEFAULTS.train.primary_metric, 6)), "trial")  # one row per trial
    return m.select("trial", *[F.round(c, 6).alias(c) for c in MD.METRICS], F.row_number().over(ranked).cast("int").alias("rank"))


def q_top_drivers_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The 8 largest of 12 attributions of every test row."""
    train = _split(spark, sf, "train")
    names = [c for c, _ in WIDE_COEF]
    m = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()  # 12 scalars
    each = S.linear_attribution(_split(spark, sf, "test"), WIDE_COEF, m.asDict(), WIDE_INTERCEPT)
    return S.top_drivers(each, names, 8)


def _linear(spark, sf, rows: DataFrame) -> DataFrame:
    train = _split(spark, sf, "train")
    m = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATS]).first()  # 3 scalars
    return S.linear_attribution(rows, S.FIXED_COEF, {c: m[c] for c in FEATS}, S.FIXED_INTERCEPT)


def q_linear_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return _linear(spark, sf, _split(spark, sf, "test"))


def q_top_drivers(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_drivers(_linear(spark, sf, _split(spark, sf, "test")), FEATS, 8)


def q_global_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return S.global_attribution(_linear(spark, sf, _split(spark, sf, "train")), FEATS)


# ---------------------------------------------------------------- oracle side
def oracles() -> dict[str, str]:
    cp = O.credit_profile_cte()
    q = lambda c: f'"{c}"'
    score = S.score_sql(quote=q)
    margin = S.margin_sql(quote=q)
    base = f"WITH {cp},\n{O.split_cte()},\n" + f"""_scored AS (
  SELECT customer_id, split, CAST("default" AS INTEGER) AS label, {score} AS score, {', '.join(q(c) for c in FEATS)} FROM split_assign
),
_val AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM _scored WHERE split = 'val'),
_test AS (SELECT *, CAST(score >= {THRESHOLD!r} AS INTEGER) AS prediction FROM _scored WHERE split = 'test'),
_means AS (SELECT {', '.join(f'avg(CAST({q(c)} AS DOUBLE)) AS m_{c}' for c in FEATS)} FROM split_assign WHERE split = 'train')"""
    rates = """round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 6) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 6) AS recall,
       round(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0.0), 6) AS f1,
       round(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + tn + fn, 0), 6) AS accuracy"""
    phis = ", ".join(f"round({w!r} * (CAST({q(c)} AS DOUBLE) - m_{c}), 6) AS {q(c)}" for c, w in S.FIXED_COEF)
    base_value = " + ".join(f"{w!r} * m_{c}" for c, w in S.FIXED_COEF) + f" + {S.FIXED_INTERCEPT!r}"
    attr_test = f"SELECT customer_id, {phis}, round({base_value}, 6) AS base_value, round({margin}, 6) AS margin FROM split_assign, _means WHERE split = 'test'"
    trials = "\n  UNION ALL ".join(
        f"""SELECT {i} AS trial, CAST("default" AS INTEGER) AS y, round(1.0 / (1.0 + exp(-({' + '.join(f'{w!r} * CAST({q(c)} AS DOUBLE)' for c, w in coef)} + {b!r}))), 6) AS s
  FROM split_assign WHERE split = 'val'""" for i, (coef, b) in enumerate(TRIAL_SCORERS))
    wide = ", ".join(f"round({w!r} * (CAST({q(c)} AS DOUBLE) - avg(CAST({q(c)} AS DOUBLE)) FILTER (WHERE split = 'train') OVER ()), 6) AS {q(c)}" for c, w in WIDE_COEF)
    wide_names = ", ".join(q(c) for c, _ in WIDE_COEF)
    hist_bin = bin_index_sql("value", "lo", "step", 40)
    return {
        "score_decisions": f"{base} SELECT customer_id, score AS default_proba, prediction FROM _test",
        "decision_log": f"""{base}
SELECT count(*) AS n_scored, CAST({THRESHOLD!r} AS DOUBLE) AS threshold, CAST(sum(prediction) AS BIGINT) AS n_predicted_default,
       round(CAST(sum(prediction) AS DOUBLE) / count(*), 6) AS predicted_default_rate, round(avg(score), 6) AS proba_mean,
       round(quantile_cont(score, 0.5), 6) AS proba_median, round(quantile_cont(score, 0.95), 6) AS proba_p95 FROM _test""",
        "score_histogram": f"""{base},
_l AS (SELECT score AS value FROM _test),
_st AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS total, (max(value) - min(value)) / 40.0 AS step FROM _l),
_b AS (SELECT {hist_bin} AS bin, count(*) AS n FROM _l, _st GROUP BY 1),
_g AS (SELECT _st.*, CAST(g.bin AS INTEGER) AS bin FROM _st, range(0, 40) g(bin))
SELECT g.bin, round(g.lo + CAST(g.bin AS DOUBLE) * g.step, 6) AS bin_lo, CAST(coalesce(b.n, 0) AS BIGINT) AS n,
       round(CAST(coalesce(b.n, 0) AS DOUBLE) / ((CASE WHEN g.bin = 39 THEN g.hi ELSE g.lo + CAST(g.bin + 1 AS DOUBLE) * g.step END)
             - (g.lo + CAST(g.bin AS DOUBLE) * g.step)) / CAST(g.total AS DOUBLE), 8) AS density
FROM _g g LEFT JOIN _b b ON g.bin = b.bin""",
        "roc_auc": f"""{base},
_c AS (SELECT score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM _val GROUP BY score),
_k AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS neg_cum FROM _c)
SELECT CAST(sum(pos) + sum(neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       round(sum(pos * (neg_cum - 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS roc_auc FROM _k""",
        "pr_auc": f"""{base},
_c AS (SELECT score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM _val GROUP BY score),
_k AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM _c)
SELECT CAST(sum(pos) AS BIGINT) AS n_pos, round(sum(pos * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / CAST(sum(pos) AS DOUBLE), 6) AS pr_auc FROM _k""",
        "confusion": f"""{base},
_t AS (SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp, count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
              count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn, count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn FROM _val)
SELECT tp, fp, tn, fn, {rates} FROM _t""",
        "threshold_sweep": f"""{base},
_g AS (SELECT CAST(g.k AS INTEGER) AS k FROM range(1, 20) g(k)),
_t AS (SELECT g.k, count(v.label) FILTER (WHERE v.label = 1) AS tp, count(v.label) FILTER (WHERE v.label = 0) AS fp
       FROM _g g LEFT JOIN _val v ON v.score >= CAST(g.k AS DOUBLE) / 20.0 GROUP BY g.k),
_n AS (SELECT sum(label) AS P, count(*) - sum(label) AS N FROM _val)
SELECT CAST(k AS DOUBLE) / 20.0 AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(N - fp AS BIGINT) AS tn,
       CAST(P - tp AS BIGINT) AS fn, {rates.replace('tn', '(N - fp)').replace('fn', '(P - tp)')} FROM _t, _n""",
        "align_features": f"""{base}
SELECT customer_id, round(1.0 / (1.0 + exp(-{margin})), 4) AS default_probability,
       CAST(1.0 / (1.0 + exp(-{margin})) >= {THRESHOLD!r} AS INTEGER) AS prediction, CAST({THRESHOLD!r} AS DOUBLE) AS threshold
FROM split_assign WHERE split = 'test'""",
        "linear_attribution": f"{base} {attr_test}",
        # pairs of a positive and a negative row, and every score as a cut
        "trial_metrics": f"""WITH {cp},\n{O.split_cte()},
_s AS ({trials}),
_auc AS (SELECT p.trial, avg(CASE WHEN p.s > n.s THEN 1.0 WHEN p.s = n.s THEN 0.5 ELSE 0.0 END) AS roc_auc
         FROM _s p JOIN _s n ON p.trial = n.trial AND p.y = 1 AND n.y = 0 GROUP BY p.trial),
_ap AS (SELECT trial, avg(prec) AS pr_auc FROM (
          SELECT p.trial, avg(CAST(o.y AS DOUBLE)) AS prec FROM (SELECT *, row_number() OVER () AS i FROM _s WHERE y = 1) p
          JOIN _s o ON o.trial = p.trial AND o.s >= p.s GROUP BY p.trial, p.i) GROUP BY trial),
_c AS (SELECT trial, count(*) FILTER (WHERE s >= {THRESHOLD!r} AND y = 1) AS tp, count(*) FILTER (WHERE s >= {THRESHOLD!r} AND y = 0) AS fp,
              count(*) FILTER (WHERE s < {THRESHOLD!r} AND y = 0) AS tn, count(*) FILTER (WHERE s < {THRESHOLD!r} AND y = 1) AS fn FROM _s GROUP BY trial)
SELECT trial, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0.0), 6) AS f1,
       round(CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn), 6) AS accuracy,
       CAST(row_number() OVER (ORDER BY round(roc_auc, 6) DESC, trial) AS INTEGER) AS rank
FROM _auc JOIN _ap USING (trial) JOIN _c USING (trial)""",
        "top_drivers_wide": f"""WITH {cp},\n{O.split_cte()},
_a AS (SELECT customer_id, split, {wide} FROM split_assign),
_l AS (UNPIVOT (SELECT customer_id, {wide_names} FROM _a WHERE split = 'test') ON {wide_names} INTO NAME feature VALUE shap)
SELECT * FROM (SELECT customer_id, feature, shap, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY abs(shap) DESC, feature) AS INTEGER) AS rank FROM _l)
WHERE rank <= 8""",
        "top_drivers": f"""{base},
_a AS ({attr_test}),
_l AS (UNPIVOT (SELECT customer_id, {', '.join(q(c) for c in FEATS)} FROM _a) ON {', '.join(q(c) for c in FEATS)} INTO NAME feature VALUE shap)
SELECT customer_id, feature, shap, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY abs(shap) DESC, feature) AS INTEGER) AS rank FROM _l""",
        "global_attribution": f"""{base},
_s AS (SELECT * FROM split_assign WHERE split = 'train'),
_a AS (SELECT customer_id, {phis} FROM _s, _means),
_l AS (UNPIVOT (SELECT {', '.join(q(c) for c in FEATS)} FROM _a) ON {', '.join(q(c) for c in FEATS)} INTO NAME feature VALUE shap),
_g AS (SELECT feature, round(avg(abs(shap)), 6) AS mean_abs_shap FROM _l GROUP BY feature)
SELECT feature, mean_abs_shap, CAST(row_number() OVER (ORDER BY mean_abs_shap DESC, feature) AS INTEGER) AS rank FROM _g""",
    }


QUERIES = {
    "score_decisions": q_score_decisions,
    "decision_log": q_decision_log,
    "score_histogram": q_score_histogram,
    "roc_auc": q_roc_auc,
    "pr_auc": q_pr_auc,
    "confusion": q_confusion,
    "threshold_sweep": q_threshold_sweep,
    "trial_metrics": q_trial_metrics,
    "top_drivers_wide": q_top_drivers_wide,
    "align_features": q_align_features,
    "linear_attribution": q_linear_attribution,
    "top_drivers": q_top_drivers,
    "global_attribution": q_global_attribution,
}
