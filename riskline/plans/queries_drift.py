"""Queries for split, samples, baseline and drift, with their DuckDB oracle SQL."""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sqlexpr import bin_index_sql, kolmogorov_sql
from ..operators import drift as D
from ..operators.split import drift_samples, reference_profile
from ..params import DEFAULTS, FEATURE_COLS
from . import oracle_base as O
from ..sources.tables import read_csv, write_csv
from .stages import drift_batches, drift_inputs, layer, layer_folder, reference_counts, reference_moments, split_table

P = DEFAULTS.drift
BATCHES = ["clean", "drifted"]


def _batches(clean: DataFrame, drifted: DataFrame) -> DataFrame:
    return clean.withColumn("batch", F.lit("clean")).unionByName(drifted.withColumn("batch", F.lit("drifted")))


def _vcs(spark, sf):
    """Stored baseline counts, and the batches' distinct values with their counts."""
    return reference_counts(spark, sf), D.value_counts_long(drift_batches(spark, sf), FEATURE_COLS, "batch")


def _bins(spark, sf):
    """D1 of both batches from the stored baseline and the batches' rows."""
    return D.psi_bins(reference_counts(spark, sf), D.long_form(drift_batches(spark, sf), FEATURE_COLS, "batch"), P)


# ---------------------------------------------------------------- spark side
def q_split_assign(spark: SparkSession, sf: str) -> DataFrame:
    return split_table(spark, sf).select("customer_id", "default", "split")


def q_split_balance(spark: SparkSession, sf: str) -> DataFrame:
    s = split_table(spark, sf)
    g = s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("default").cast("long").alias("n_pos"))
    every = Window.partitionBy()  # one row per split label
    return g.select(
        "split", "n_rows", "n_pos", F.sum("n_rows").over(every).alias("_all")).select(
        "split", "n_rows", "n_pos",
        F.round(F.col("n_pos") / F.col("n_rows"), 6).alias("pos_rate"),
        F.round(F.lit(100.0) * F.col("n_rows") / F.col("_all"), 6).alias("pct_of_total"))


def q_drift_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The seeded samples of at most ``sample_size`` rows; the drift queries take whole batches."""
    _, test, _, _ = drift_inputs(spark, sf)
    return _batches(*drift_samples(test, P)).select("batch", "customer_id", "AGE", "default")


def q_reference_profile(spark: SparkSession, sf: str) -> DataFrame:
    reference, _, _, _ = drift_inputs(spark, sf)
    return reference_profile(reference, FEATURE_COLS)


def q_psi_bins(spark: SparkSession, sf: str) -> DataFrame:
    return _bins(spark, sf).select("batch", "feature", "bin", F.round("bin_lo", 6).alias("bin_lo"), "ref_count", "cur_count",
                    F.round("e", 8).alias("e"), F.round("a", 8).alias("a"))


def _feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """The per-feature drift table, a layer: summary and verdict read it instead of recomputing PSI/JS/KS."""
    def build() -> DataFrame:
        ref_vc, cur_vc = _vcs(spark, sf)
        rows = D.long_form(drift_batches(spark, sf), FEATURE_COLS, "batch")
        return D.feature_table(ref_vc, cur_vc, P, BATCHES, rows)

    return layer(spark, sf, "psi_per_feature", build)


def q_psi_table(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_table(spark, sf)


def q_drift_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The drift table written as CSV with a header and scanned again with its schema."""
    table = _feature_table(spark, sf)
    path = layer_folder(spark, sf, "psi_per_feature_csv")
    write_csv(table, path)
    return read_csv(spark, path, table.schema)


def q_js_table(spark: SparkSession, sf: str) -> DataFrame:
    return D.psi_js(_bins(spark, sf)).select("batch", "feature", F.round("js", 4).alias("js"))


def q_ks_table(spark: SparkSession, sf: str) -> DataFrame:
    ref_vc, cur_vc = _vcs(spark, sf)
    return D.ks_stats(ref_vc, cur_vc, BATCHES).select("batch", "feature", F.round("ks_stat", 6).alias("ks_stat"),
                                             F.round("ks_pvalue", 4).alias("ks_pvalue"))


def q_ks_table_exact(spark: SparkSession, sf: str) -> DataFrame:
    """D5 with the reference's method choice: exact two-sample law when both samples have
    at most 10,000 rows, asymptotic otherwise (rows-only: the lattice count has no SQL form)."""
    ref_vc, cur_vc = _vcs(spark, sf)
    ks = D.ks_pvalue_auto(D.ks_stats(ref_vc, cur_vc, BATCHES))
    return ks.select("batch", "feature", F.round("ks_stat", 6).alias("ks_stat"), "n_ref", "n_cur", "ks_method",
                     F.round("ks_pvalue_exact", 4).alias("ks_pvalue"))


def q_drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    return D.batch_summary(_feature_table(spark, sf))


def _pca(spark: SparkSession, sf: str) -> DataFrame:
    """PCA drift of both batches: stored baseline moments against the moments of one scan."""
    def build() -> DataFrame:
        ref = D.merge_moments(reference_moments(spark, sf).collect())[""]
        groups = D.grouped_moments(drift_batches(spark, sf), FEATURE_COLS, "batch")
        return D.pca_table(spark, ref, groups, BATCHES, P)

    return layer(spark, sf, "pca_recon", build)


def q_pca_recon(spark: SparkSession, sf: str) -> DataFrame:
    return _pca(spark, sf)


PAIR = ["BILL_AMT1", "BILL_AMT2"]


def _pca_pair(spark: SparkSession, sf: str) -> DataFrame:
    reference, _, clean, drifted = drift_inputs(spark, sf)
    return D.pca_recon(reference, {"clean": clean, "drifted": drifted}, PAIR, replace(P, pca_components=1))


def q_pca_recon_pair(spark: SparkSession, sf: str) -> DataFrame:
    """D6 on two correlated features with one component: the same moments-only code path as
    the wide case, small enough for a closed-form SQL check (eigenvalues 1 +- |r|)."""
    return _pca_pair(spark, sf).select("batch", "n_components", "reference_error", "current_error", "pca_recon_ratio")


def q_drift_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict on both batches, over the PCA of all features."""
    return D.drift_verdict(D.batch_summary(_feature_table(spark, sf)), _pca(spark, sf), P)


def q_drift_verdict_pair(spark: SparkSession, sf: str) -> DataFrame:
    """The same verdict over the PCA of the pair, with retraining on drift."""
    return D.drift_verdict(D.batch_summary(_feature_table(spark, sf)), _pca_pair(spark, sf), replace(P, trigger_retrain_on_drift=True))


# ---------------------------------------------------------------- oracle side
bin_sql = bin_index_sql


def drift_cte() -> str:
    feats = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FEATURE_COLS)
    on = ", ".join(f'"{c}"' for c in FEATURE_COLS)
    nb = P.buckets
    return O.split_cte() + f""",
_test AS (SELECT * FROM split_assign WHERE split = 'test'),
_train AS (SELECT * FROM split_assign WHERE split = 'train'),
_thr AS (SELECT quantile_cont(CAST("{P.bias_column}" AS DOUBLE), {P.bias_quantile!r}) AS q FROM _test),
_biased AS (SELECT _test.* FROM _test, _thr WHERE "{P.bias_column}" >= _thr.q),
_sample AS (
  SELECT 'clean' AS batch, * FROM (
    SELECT * FROM _test ORDER BY md5(CAST(customer_id AS VARCHAR) || ':{P.sample_seed}'), customer_id LIMIT {P.sample_size})
  UNION ALL SELECT 'drifted' AS batch, * FROM (
    SELECT * FROM _biased ORDER BY md5(CAST(customer_id AS VARCHAR) || ':{P.sample_seed}'), customer_id LIMIT {P.sample_size})
),
_clean AS (SELECT * FROM _test),
_drifted AS (SELECT * FROM _biased),
batches AS (SELECT 'clean' AS batch, * FROM _clean UNION ALL SELECT 'drifted' AS batch, * FROM _drifted),
_ref_long AS (UNPIVOT (SELECT {feats} FROM _train) ON {on} INTO NAME feature VALUE value),
_cur_long AS (UNPIVOT (SELECT batch, {feats} FROM batches) ON {on} INTO NAME feature VALUE value),
ref_vc AS (SELECT feature, value, count(*) AS c FROM _ref_long GROUP BY ALL),
cur_vc AS (SELECT batch, feature, value, count(*) AS c FROM _cur_long GROUP BY ALL),
_rs AS (SELECT feature, min(value) AS rlo, max(value) AS rhi, sum(c) AS n_ref FROM ref_vc GROUP BY feature),
_cs AS (SELECT batch, feature, min(value) AS clo, max(value) AS chi, sum(c) AS n_cur FROM cur_vc GROUP BY ALL),
edges AS (
  SELECT batch, _cs.feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
         least(rlo, clo) AS lo, greatest(rhi, chi) AS hi, (greatest(rhi, chi) - least(rlo, clo)) / {float(nb)!r} AS step
  FROM _cs JOIN _rs ON _cs.feature = _rs.feature
),
_rb AS (SELECT e.batch, e.feature, {bin_sql('r.value', 'e.lo', 'e.step', nb)} AS bin, sum(r.c) AS ref_count
        FROM ref_vc r JOIN edges e ON r.feature = e.feature GROUP BY ALL),
_cb AS (SELECT e.batch, e.feature, {bin_sql('c.value', 'e.lo', 'e.step', nb)} AS bin, sum(c.c) AS cur_count
        FROM cur_vc c JOIN edges e ON c.feature = e.feature AND c.batch = e.batch GROUP BY ALL),
_grid AS (SELECT e.*, CAST(g.bin AS INTEGER) AS bin FROM edges e, range(0, {nb}) g(bin)),
psi_bins AS (
  SELECT g.batch, g.feature, g.bin, g.lo + CAST(g.bin AS DOUBLE) * g.step AS bin_lo,
         CAST(coalesce(rb.ref_count, 0) AS BIGINT) AS ref_count, CAST(coalesce(cb.cur_count, 0) AS BIGINT) AS cur_count,
         CASE WHEN coalesce(rb.ref_count, 0) = 0 THEN {P.epsilon!r} ELSE CAST(rb.ref_count AS DOUBLE) / CAST(g.n_ref AS DOUBLE) END AS e,
         CASE WHEN coalesce(cb.cur_count, 0) = 0 THEN {P.epsilon!r} ELSE CAST(cb.cur_count AS DOUBLE) / CAST(g.n_cur AS DOUBLE) END AS a
  FROM _grid g
  LEFT JOIN _rb rb ON g.batch = rb.batch AND g.feature = rb.feature AND g.bin = rb.bin
  LEFT JOIN _cb cb ON g.batch = cb.batch AND g.feature = cb.feature AND g.bin = cb.bin
),
_pj AS (
  SELECT *, sum(e) OVER (PARTITION BY batch, feature) AS se, sum(a) OVER (PARTITION BY batch, feature) AS sa FROM psi_bins
),
psi_js AS (
  SELECT batch, feature,
         sum((a - e) * ln(a / e)) AS psi,
         sqrt(greatest(0.0, 0.5 * sum((e / se) * log2((e / se) / (((e + a) / 2) / ((se + sa) / 2))))
                          + 0.5 * sum((a / sa) * log2((a / sa) / (((e + a) / 2) / ((se + sa) / 2)))))) AS js
  FROM _pj GROUP BY batch, feature
),
_pooled AS (
  SELECT batch, feature, value, sum(cr) AS cr, sum(cc) AS cc FROM (
    SELECT b.batch, r.feature, r.value, r.c AS cr, 0 AS cc FROM ref_vc r, (SELECT DISTINCT batch FROM cur_vc) b
    UNION ALL
    SELECT batch, feature, value, 0 AS cr, c AS cc FROM cur_vc) GROUP BY ALL
),
_cum AS (
  SELECT *, sum(cr) OVER (PARTITION BY batch, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr_cum,
            sum(cc) OVER (PARTITION BY batch, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc_cum,
            sum(cr) OVER (PARTITION BY batch, feature) AS n_ref, sum(cc) OVER (PARTITION BY batch, feature) AS n_cur
  FROM _pooled
),
ks AS (
  SELECT batch, feature, max(abs(CAST(cr_cum AS DOUBLE) / CAST(n_ref AS DOUBLE) - CAST(cc_cum AS DOUBLE) / CAST(n_cur AS DOUBLE))) AS ks_stat,
         any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
  FROM _cum GROUP BY batch, feature
),
ks_table AS (SELECT batch, feature, ks_stat, {kolmogorov_sql('ks_stat', 'n_ref', 'n_cur')} AS ks_pvalue FROM ks),
feature_table AS (
  SELECT p.batch, p.feature, round(p.psi, 4) AS psi, round(p.js, 4) AS js, round(k.ks_pvalue, 4) AS ks_pvalue,
         p.psi >= {P.psi_threshold!r} AS drift,
         CASE WHEN p.psi < 0.1 THEN 'stable' WHEN p.psi < 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band,
         CAST(row_number() OVER (PARTITION BY p.batch ORDER BY round(p.psi, 4) DESC, p.feature ASC) AS INTEGER) AS rank
  FROM psi_js p JOIN ks_table k ON p.batch = k.batch AND p.feature = k.feature
)"""


def oracles() -> dict[str, str]:
    cp = O.credit_profile_cte()
    split = f"WITH {cp},\n{O.split_cte()}"
    drift = f"WITH {cp},\n{drift_cte()}"
    feats = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FEATURE_COLS)
    on = ", ".join(f'"{c}"' for c in FEATURE_COLS)
    a, b = (f'CAST("{c}" AS DOUBLE)' for c in PAIR)
    pair = f"""{drift},
_r AS (SELECT avg({a}) AS ma, avg({b}) AS mb, stddev_pop({a}) AS sa, stddev_pop({b}) AS sb, corr({a}, {b}) AS r FROM _train),
_c AS (SELECT batch, avg({a}) AS ca, avg({b}) AS cb, var_pop({a}) AS va, var_pop({b}) AS vb, covar_pop({a}, {b}) AS cab
       FROM batches GROUP BY batch),
_s AS (SELECT batch, r, 1.0 - abs(r) AS err_ref,
              va / (sa * sa) + ((ca - ma) / sa) * ((ca - ma) / sa) AS s11,
              vb / (sb * sb) + ((cb - mb) / sb) * ((cb - mb) / sb) AS s22,
              cab / (sa * sb) + ((ca - ma) / sa) * ((cb - mb) / sb) AS s12
       FROM _c, _r)
PAIR_SELECT
SELECT batch, 1 AS n_components, round(err_ref, 6) AS reference_error,
       round((s11 + s22 - 2.0 * sign(r) * s12) / 2.0, 6) AS current_error,
       round(((s11 + s22 - 2.0 * sign(r) * s12) / 2.0) / err_ref, 3) AS pca_recon_ratio
FROM _s"""
    summary = """SELECT batch, count(*) FILTER (WHERE drift) AS n_features_drifted, count(*) AS n_features,
       round(CAST(count(*) FILTER (WHERE drift) AS DOUBLE) / count(*), 3) AS share_drifted,
       coalesce(array_to_string(list(feature ORDER BY rank) FILTER (WHERE drift AND rank IS NOT NULL)[1:5], ', '), '') AS top_drifted
FROM feature_table GROUP BY batch"""
    ctes, selected = pair.split("PAIR_SELECT")
    verdict = f"""{ctes.rstrip()},
_p AS ({selected}),
_b AS ({summary}),
_j AS (SELECT _b.*, pca_recon_ratio, pca_recon_ratio >= {P.pca_drift_ratio!r} AS multivariate_drift FROM _b JOIN _p ON _b.batch = _p.batch)
SELECT batch, n_features_drifted, n_features, share_drifted, pca_recon_ratio, multivariate_drift,
       CASE WHEN n_features_drifted = 0 THEN 'NO DRIFT' ELSE n_features_drifted || ' features drifted' END AS verdict,
       CASE WHEN multivariate_drift THEN 'drift' ELSE 'stable' END AS pca_state,
       CASE WHEN top_drifted = '' THEN '-' ELSE top_drifted END AS top_drifted,
       CAST({P.psi_threshold!r} AS DOUBLE) AS psi_threshold, CAST({P.pca_drift_ratio!r} AS DOUBLE) AS pca_drift_ratio_threshold,
       n_features_drifted > 0 OR multivariate_drift AS drift_detected, n_features_drifted > 0 OR multivariate_drift AS retrain
FROM _j"""
    return {
        "pca_recon_pair": ctes + selected,
        "drift_verdict_pair": verdict,
        "split_assign": f'{split} SELECT customer_id, "default", split FROM split_assign',
        "split_balance": f"""{split}
SELECT split, count(*) AS n_rows, CAST(sum("default") AS BIGINT) AS n_pos,
       round(CAST(sum("default") AS DOUBLE) / count(*), 6) AS pos_rate,
       round(100.0 * count(*) / (SELECT count(*) FROM split_assign), 6) AS pct_of_total
FROM split_assign GROUP BY split""",
        "drift_samples": f'{drift} SELECT batch, customer_id, "AGE", "default" FROM _sample',
        "reference_profile": f"""{drift},
_l AS (UNPIVOT (SELECT {feats} FROM _train) ON {on} INTO NAME feature VALUE value)
SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       min(value) AS min, max(value) AS max FROM _l GROUP BY feature""",
        "psi_bins": f"""{drift}
SELECT batch, feature, bin, round(bin_lo, 6) AS bin_lo, ref_count, cur_count, round(e, 8) AS e, round(a, 8) AS a FROM psi_bins""",
        "psi_table": f"{drift} SELECT * FROM feature_table",
        "drift_csv": f"{drift} SELECT * FROM feature_table",
        "js_table": f"{drift} SELECT batch, feature, round(js, 4) AS js FROM psi_js",
        "ks_table": f"{drift} SELECT batch, feature, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 4) AS ks_pvalue FROM ks_table",
        "drift_summary": f"""{drift}
SELECT batch, count(*) FILTER (WHERE drift) AS n_features_drifted, count(*) AS n_features,
       round(CAST(count(*) FILTER (WHERE drift) AS DOUBLE) / count(*), 3) AS share_drifted,
       coalesce(array_to_string(list(feature ORDER BY rank) FILTER (WHERE drift AND rank IS NOT NULL)[1:5], ', '), '') AS top_drifted
FROM feature_table GROUP BY batch""",
    }


QUERIES = {
    "split_assign": q_split_assign,
    "split_balance": q_split_balance,
    "drift_samples": q_drift_samples,
    "reference_profile": q_reference_profile,
    "psi_bins": q_psi_bins,
    "psi_table": q_psi_table,
    "drift_csv": q_drift_csv,
    "js_table": q_js_table,
    "ks_table": q_ks_table,
    "ks_table_exact": q_ks_table_exact,
    "drift_summary": q_drift_summary,
    "pca_recon": q_pca_recon,
    "pca_recon_pair": q_pca_recon_pair,
    "drift_verdict": q_drift_verdict,
    "drift_verdict_pair": q_drift_verdict_pair,
}
