"""Drift statistics (D1-D14) for many features and batches in a few aggregate jobs.

Layout: every batch is turned into the long form ``(batch, feature, value, c)`` by ``unpivot``,
c being how often a row counts. PSI and JS take two passes over it: minima and maxima per
feature, which give the edges (10 equal-width bins over BOTH samples, a table of batches x
features rows that is broadcast), then counts per (feature, bin). Both passes are summed up on
the map side, so a task sends features x bins rows at most and no table of distinct values is
made. KS needs distinct values: they are counted for the batches, stored for the baseline, and
cumulated with one exchange; the baseline stands there once for all batches. PCA reconstruction
error comes from moments only, which merge without the rows.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import FEATURE_COLS, DriftParams
from ..functions.sqlexpr import bin_index_sql, kolmogorov_sql
from .ordering import running_sums


# ------------------------------------------------------------------ long form
def long_form(df: DataFrame, features: list[str], batch_col: str | None = None) -> DataFrame:
    """(batch?, feature, value, c): one row per row and feature, c = 1."""
    keep = [batch_col] if batch_col else []
    wide = df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    return wide.unpivot(keep, features, "feature", "value").withColumn("c", F.lit(1).cast("long"))


def value_counts_long(df: DataFrame, features: list[str], batch_col: str | None = None) -> DataFrame:
    """(batch?, feature, value, c): per-feature distinct values with their row counts."""
    keep = [batch_col] if batch_col else []
    return long_form(df, features, batch_col).groupBy(*keep, "feature", "value").agg(F.sum("c").alias("c"))


def bin_index(value: str, lo: str, step: str, buckets: int = 10) -> Column:
    """Bin of ``value`` against edges ``lo + i*step``: half-open bins, last bin closed.
    Counting the inner edges at or below the value reproduces searchsorted semantics,
    including ``value == hi`` (last bin) and ``lo == hi`` (everything in the last bin)."""
    return F.expr(bin_index_sql(value, lo, step, buckets))


def shared_edges(ref_vc: DataFrame, cur_vc: DataFrame, buckets: int = 10) -> DataFrame:
    ref = ref_vc.groupBy("feature").agg(F.min("value").alias("rlo"), F.max("value").alias("rhi"),
                                        F.sum("c").alias("n_ref"))
    cur = cur_vc.groupBy("batch", "feature").agg(F.min("value").alias("clo"), F.max("value").alias("chi"),
                                                 F.sum("c").alias("n_cur"))
    e = cur.join(ref, "feature")
    lo = F.least("rlo", "clo")
    hi = F.greatest("rhi", "chi")
    return e.select("batch", "feature", "n_ref", "n_cur", lo.alias("lo"), hi.alias("hi"),
                    ((hi - lo) / F.lit(float(buckets))).alias("step"))


def psi_bins(ref_vc: DataFrame, cur_vc: DataFrame, params: DriftParams = DriftParams()) -> DataFrame:
    """Per (batch, feature, bin) counts and epsilon-floored proportions on shared edges, of
    rows (batch?, feature, value, c) that need not be collapsed. The edge table has batches x
    features rows and is broadcast."""
    nb = params.buckets
    edges = F.broadcast(shared_edges(ref_vc, cur_vc, nb))
    r = (ref_vc.join(edges, "feature")
         .select("batch", "feature", bin_index("value", "lo", "step", nb).alias("bin"), "c")
         .groupBy("batch", "feature", "bin").agg(F.sum("c").alias("ref_count")))
    c = (cur_vc.join(edges, ["batch", "feature"])
         .select("batch", "feature", bin_index("value", "lo", "step", nb).alias("bin"), "c")
         .groupBy("batch", "feature", "bin").agg(F.sum("c").alias("cur_count")))
    grid = edges.select("batch", "feature", "n_ref", "n_cur", "lo", "step",
                        F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("bin"))
    g = (grid.join(r, ["batch", "feature", "bin"], "left").join(c, ["batch", "feature", "bin"], "left")
         .fillna(0, ["ref_count", "cur_count"]))
    e = F.col("ref_count") / F.col("n_ref")
    a = F.col("cur_count") / F.col("n_cur")
    eps = F.lit(params.epsilon)
    return g.select(
        "batch", "feature", F.col("bin").cast("int").alias("bin"),
        (F.col("lo") + F.col("bin").cast("double") * F.col("step")).alias("bin_lo"),
        F.col("ref_count").cast("long").alias("ref_count"), F.col("cur_count").cast("long").alias("cur_count"),
        F.when(e == 0, eps).otherwise(e).alias("e"), F.when(a == 0, eps).otherwise(a).alias("a"),
    )


def psi_js(bins: DataFrame) -> DataFrame:
    """D2 + D3 from one binned table: PSI on floored proportions; JS distance normalises
    both floored vectors (and their mixture) to sum 1 first, base-2 logs."""
    w = Window.partitionBy("batch", "feature")
    b = bins.select("*", F.sum("e").over(w).alias("se"), F.sum("a").over(w).alias("sa"))
    m = (F.col("e") + F.col("a")) / 2
    sm = (F.col("se") + F.col("sa")) / 2
    pe, pa, pm = F.col("e") / F.col("se"), F.col("a") / F.col("sa"), m / sm
    return b.groupBy("batch", "feature").agg(
        F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"),
        F.sum(pe * F.log2(pe / pm)).alias("kl_e"),
        F.sum(pa * F.log2(pa / pm)).alias("kl_a"),
    ).select("batch", "feature", "psi",
             F.sqrt(F.greatest(F.lit(0.0), F.lit(0.5) * F.col("kl_e") + F.lit(0.5) * F.col("kl_a"))).alias("js"))


def kolmogorov_pvalue(d: str, n1: str, n2: str) -> Column:
    """Two-sided asymptotic p-value with Stephens' small-sample factor.
    z = (sqrt(en) + 0.12 + 0.11/sqrt(en)) * D, en = n1 n2 / (n1 + n2). For z < 1.18 use
    the theta-series form of the CDF (1 - sqrt(2 pi)/z sum exp(-(2k-1)^2 pi^2 / (8 z^2))),
    else 2 sum (-1)^(k-1) exp(-2 k^2 z^2); clipped to [0, 1]."""
    return F.expr(kolmogorov_sql(d, n1, n2))


def ks_stats(ref_vc: DataFrame, cur_vc: DataFrame, batch_names: list[str] | None = None) -> DataFrame:
    """Sup |F_ref - F_cur| over pooled values, per (batch, feature).

    Every batch has a count column of its own, so the reference stands in the pooled rows once and
    one exchange by (feature, range of values) serves all batches. The running sums go up to and
    including all rows of a value, so equal values of the two sides need not meet before."""
    if batch_names is None:
        batch_names = sorted(r[0] for r in cur_vc.select("batch").distinct().collect())  # one row per batch
    zero = F.lit(0).cast("long")
    names = {b: f"c{i}" for i, b in enumerate(batch_names)}
    pooled = (ref_vc.select("feature", "value", F.col("c").cast("long").alias("cr"), *[zero.alias(c) for c in names.values()])
              .unionByName(cur_vc.select("feature", "value", zero.alias("cr"), *[
                  F.when(F.col("batch") == b, F.col("c").cast("long")).otherwise(zero).alias(c) for b, c in names.items()])))
    counted = ["cr", *names.values()]
    cum = running_sums(pooled, ["value"], counted, partition_cols=["feature"], ties=True)
    # features rows
    totals = pooled.groupBy(F.col("feature").alias("_f")).agg(*[F.sum(c).alias(f"n_{c}") for c in counted])
    j = cum.join(F.broadcast(totals), F.col("feature") == F.col("_f"))
    gaps = j.groupBy("feature", "n_cr", *[f"n_{c}" for c in names.values()]).agg(*[
        F.max(F.abs(F.col("cr_cum") / F.col("n_cr") - F.col(f"{c}_cum") / F.col(f"n_{c}"))).alias(f"gap_{c}") for c in names.values()])
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("batch"), F.col(f"gap_{c}").alias("ks_stat"), F.col(f"n_{c}").alias("n_cur"))
                               for b, c in names.items()]))
    long = gaps.select("feature", F.col("n_cr").alias("n_ref"), each.alias("r")).select("feature", "n_ref", "r.*").where("n_cur > 0")
    return long.select("batch", "feature", "ks_stat", kolmogorov_pvalue("ks_stat", "n_ref", "n_cur").alias("ks_pvalue"),
                       F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"))


def psi_band(psi: Column) -> Column:
    """Stable < 0.1 <= moderate < 0.2 <= significant."""
    return F.when(psi < 0.1, F.lit("stable")).when(psi < 0.2, F.lit("moderate")).otherwise(F.lit("significant"))


def feature_table(ref_vc: DataFrame, cur_vc: DataFrame, params: DriftParams = DriftParams(),
                  batch_names: list[str] | None = None, cur_long: DataFrame | None = None) -> DataFrame:
    """D8 (+D7, D13, W1): per (batch, feature) psi/js/ks_pvalue rounded to 4, flag on the
    unrounded psi, rank by rounded psi desc then feature name. ``cur_long``: the batches' rows
    as they are, for the bins, which need no distinct values."""
    pj = psi_js(psi_bins(ref_vc, cur_vc if cur_long is None else cur_long, params))
    ks = ks_stats(ref_vc, cur_vc, batch_names)
    t = pj.join(ks, ["batch", "feature"])
    rw = Window.partitionBy("batch").orderBy(F.desc(F.round("psi", 4)), F.asc("feature"))
    return t.select(
        "batch", "feature",
        F.round("psi", 4).alias("psi"), F.round("js", 4).alias("js"), F.round("ks_pvalue", 4).alias("ks_pvalue"),
        (F.col("psi") >= F.lit(params.psi_threshold)).alias("drift"),
        psi_band(F.col("psi")).alias("psi_band"),
    ).withColumn("rank", F.row_number().over(rw).cast("int"))


def batch_summary(table: DataFrame, top_n: int = 5) -> DataFrame:
    """D10 (univariate part) + W2: counts, share (3 dp), first ``top_n`` drifted names."""
    ranked_names = F.sort_array(F.collect_list(F.when(F.col("drift"), F.struct(F.col("rank"), F.col("feature")))))
    return table.groupBy("batch").agg(
        F.count_if("drift").cast("long").alias("n_features_drifted"),
        F.count(F.lit(1)).cast("long").alias("n_features"),
        ranked_names.alias("_top"),
    ).select(
        "batch", "n_features_drifted", "n_features",
        F.round(F.col("n_features_drifted") / F.col("n_features"), 3).alias("share_drifted"),
        F.concat_ws(", ", F.slice(F.transform("_top", lambda s: s["feature"]), 1, top_n)).alias("top_drifted"),
    )


# ------------------------------------------------------------------ PCA (moments only)
def moments(df: DataFrame, features: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance with ddof 0) from two distributed tree-aggregations
    (``Summarizer`` for count/mean/variance, ``Correlation`` for the d x d matrix).
    Only d + d^2 numbers reach the driver, bounded by the feature count."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation, Summarizer

    vec = VectorAssembler(inputCols=list(features), outputCol="_v", handleInvalid="error").transform(
        df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features]))
    s = vec.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("_v")).alias("s")).first()["s"]
    n = int(s["count"])
    mean = np.asarray(s["mean"].toArray(), dtype=float)
    var1 = np.asarray(s["variance"].toArray(), dtype=float)
    var0 = var1 * (n - 1) / n if n > 0 else var1
    corr = np.asarray(Correlation.corr(vec, "_v", "pearson").first()[0].toArray(), dtype=float)
    sd0 = np.sqrt(np.maximum(var0, 0.0))
    corr = np.where(np.isfinite(corr), corr, 0.0)
    cov0 = corr * np.outer(sd0, sd0)
    np.fill_diagonal(cov0, var0)
    return n, mean, cov0


def _merge(parts) -> tuple[int, np.ndarray, np.ndarray]:
    """Combine (n, mean, centred co-moment) triples exactly (pairwise update, no raw sums)."""
    n, mean, m2 = 0, None, None
    for nb, mb, cb in parts:
        if nb == 0:
            continue
        if n == 0:
            n, mean, m2 = nb, np.array(mb, dtype=float), np.array(cb, dtype=float)
            continue
        delta = mb - mean
        tot = n + nb
        mean = mean + delta * (nb / tot)
        m2 = m2 + cb + np.outer(delta, delta) * (n * nb / tot)
        n = tot
    return n, mean, m2


MOMENTS = "g string, n long, mean array<double>, m2 array<double>"


def moment_rows(df: DataFrame, features: list[str], group_col: str | None = None, fan_in: int = 64) -> DataFrame:
    """(g, n, mean, m2) in one pass over the rows: at most ``fan_in`` partial rows per group, or
    one row (g null) without a group column. Rows of the same or of different groups merge by
    ``merge_moments``. Null groups are left out.

    Each task folds its Arrow batches into one (n, mean, co-moment) per group; a second stage
    merges those partials in ``fan_in`` buckets per group (each bucket holds at most partitions /
    fan_in partials of d*d numbers). Centred co-moments keep the sums well conditioned."""
    d = len(features)

    def fold(batches):
        acc: dict = {}
        for pdf in batches:
            for g, sub in pdf.groupby("g", sort=False):
                x = sub[features].to_numpy(dtype=float)
                mb = x.mean(axis=0)
                c = x - mb
                acc[g] = _merge([acc.get(g, (0, None, None)), (len(x), mb, c.T @ c)])
        if acc:
            yield pd.DataFrame({"g": list(acc), "n": [v[0] for v in acc.values()],
                                "mean": [v[1].tolist() for v in acc.values()],
                                "m2": [v[2].ravel().tolist() for v in acc.values()]})

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, m2 = _merge((int(r.n), np.asarray(r.mean), np.asarray(r.m2).reshape(d, d)) for r in pdf.itertuples())
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "n": [n], "mean": [mean.tolist()], "m2": [m2.ravel().tolist()]})

    group = F.col(group_col).cast("string") if group_col else F.lit("")
    partial = (df.select(group.alias("g"), *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
               .where("g is not null").mapInPandas(fold, MOMENTS)
               # the task's number: a row id would hold it above bit 33 and fill a few buckets only
               .withColumn("_b", F.spark_partition_id() % fan_in))
    merged = partial.groupBy("g", "_b").applyInPandas(combine, MOMENTS)
    if group_col:
        return merged
    return merged.groupBy("g").applyInPandas(combine, MOMENTS)


def merge_moments(rows) -> dict:
    """(n, mean, covariance ddof 0) by group, of collected moment rows."""
    parts: dict = {}
    for r in rows:
        d = len(r["mean"])
        parts.setdefault(r["g"], []).append((r["n"], np.asarray(r["mean"]), np.asarray(r["m2"]).reshape(d, d)))
    out = {}
    for g in sorted(parts):
        n, mean, m2 = _merge(parts[g])
        out[g] = (n, mean, m2 / n)
    return out


def merged_group(groups: dict) -> tuple:
    """(n, mean, covariance) of all groups together, from theirs."""
    n, mean, m2 = _merge((n, mean, cov * n) for n, mean, cov in groups.values())
    return n, mean, m2 / n


def grouped_moments(df: DataFrame, features: list[str], group_col: str, fan_in: int = 64) -> dict:
    """(n, mean, covariance ddof 0) per group; at most groups x fan_in rows reach the driver."""
    return merge_moments(moment_rows(df, features, group_col, fan_in).collect())


def pca_recon_from_moments(ref: tuple, cur: tuple, k: int) -> dict:
    """Reconstruction-error ratio of a k-component PCA fitted on the standardised
    reference. err_ref = sum of discarded eigenvalues; err_cur = tr(P S) with
    S = Cov_cur + (mu_c - mu_r)(mu_c - mu_r)' in reference-scaled space."""
    _, mu_r, cov_r = ref
    _, mu_c, cov_c = cur
    d = len(mu_r)
    k = min(k, d)
    scale = np.sqrt(np.diag(cov_r))
    scale = np.where(scale > 0, scale, 1.0)
    inv = 1.0 / scale
    c_r = cov_r * np.outer(inv, inv)
    vals, vecs = np.linalg.eigh(c_r)
    order = np.argsort(vals)[::-1]
    v = vecs[:, order[:k]]
    proj_out = np.eye(d) - v @ v.T
    err_ref = float(np.trace(proj_out @ c_r))
    shift = (mu_c - mu_r) * inv
    s = cov_c * np.outer(inv, inv) + np.outer(shift, shift)
    err_cur = float(np.trace(proj_out @ s))
    err_ref = max(err_ref, 0.0)
    return {"reference": err_ref, "current": err_cur, "ratio": err_cur / err_ref if err_ref > 1e-12 else 0.0, "k": k}


PCA_TABLE = ("batch string, n_features int, n_components int, reference_error double, current_error double, "
             "pca_recon_ratio double, multivariate_drift boolean")


def pca_table(spark, ref: tuple, groups: dict, names: list[str], params: DriftParams = DriftParams()) -> DataFrame:
    """D6/D9 per batch from moments: reference/current errors, ratio (3 dp) and the multivariate flag."""
    d = len(ref[1])
    rows = []
    for name in names:
        r = pca_recon_from_moments(ref, groups.get(name, (0, np.zeros(d), np.zeros((d, d)))), params.pca_components)
        rows.append((name, d, r["k"], round(r["reference"], 6), round(r["current"], 6),
                     round(r["ratio"], 3), bool(r["ratio"] >= params.pca_drift_ratio)))
    return spark.createDataFrame(rows, PCA_TABLE)


def pca_recon(reference: DataFrame, batches: dict[str, DataFrame], features: list[str] = FEATURE_COLS,
              params: DriftParams = DriftParams()) -> DataFrame:
    """``pca_table`` of a reference frame and a frame per batch."""
    columns = [F.col(f"`{c}`") for c in features]
    ref = merge_moments(moment_rows(reference, features).collect()).get("")
    if ref is None:
        raise ValueError("the reference has no rows")
    both = None
    for name, df in batches.items():
        part = df.select(F.lit(name).alias("_grp"), *columns)
        both = part if both is None else both.unionByName(part)
    groups = grouped_moments(both, features, "_grp") if both is not None else {}
    return pca_table(reference.sparkSession, ref, groups, list(batches), params)


# ------------------------------------------------------------------ frozen-reference windows
def frozen_reference(ref_long: DataFrame, params: DriftParams = DriftParams()) -> tuple[DataFrame, DataFrame]:
    """Edges and floored proportions of a frozen reference ``(feature, value)``, or of its stored
    counts ``(feature, value, c)``. Returns ``(edges(feature, lo, step, n_ref), ref_bins(feature, bin, e))``; both have at
    most features x buckets rows. Later values outside [lo, hi] fall in the first/last bin."""
    nb = params.buckets
    times = F.sum("c") if "c" in ref_long.columns else F.count(F.lit(1))
    edges = ref_long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), times.alias("n_ref"))
    edges = edges.select("feature", "lo", ((F.col("hi") - F.col("lo")) / F.lit(float(nb))).alias("step"), "n_ref")
    e = F.broadcast(edges)
    weight = F.col("c") if "c" in ref_long.columns else F.lit(1)
    counts = (ref_long.join(e, "feature").select("feature", bin_index("value", "lo", "step", nb).alias("bin"), weight.alias("c"))
              .groupBy("feature", "bin").agg(F.sum("c").alias("c")))
    grid = edges.select("feature", "n_ref", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("bin"))
    p = grid.join(counts, ["feature", "bin"], "left").fillna(0, ["c"])
    share = F.col("c") / F.col("n_ref")
    ref_bins = p.select("feature", "bin", F.when(share == 0, F.lit(params.epsilon)).otherwise(share).alias("e"))
    return edges, ref_bins


def window_bin_counts(cur_long: DataFrame, edges: DataFrame, buckets: int = 10) -> DataFrame:
    """(window_start, feature, bin, c) against the frozen edges (broadcast)."""
    return (cur_long.join(F.broadcast(edges.select("feature", "lo", "step")), "feature")
            .select("window_start", "feature", bin_index("value", "lo", "step", buckets).alias("bin"))
            .groupBy("window_start", "feature", "bin").agg(F.count(F.lit(1)).alias("c")))


def window_psi(counts: DataFrame, ref_bins: DataFrame, params: DriftParams = DriftParams()) -> DataFrame:
    """PSI per (window, feature) from per-bin counts; missing bins are floored to epsilon."""
    tot = counts.groupBy("window_start", "feature").agg(F.sum("c").alias("n"))
    grid = tot.join(F.broadcast(ref_bins), "feature")  # features x buckets reference rows
    g = grid.join(counts, ["window_start", "feature", "bin"], "left").fillna(0, ["c"])
    share = F.col("c") / F.col("n")
    a = F.when(share == 0, F.lit(params.epsilon)).otherwise(share)
    return g.groupBy("window_start", "feature", "n").agg(
        F.sum((a - F.col("e")) * F.log(a / F.col("e"))).alias("psi")).select(
        "window_start", "feature", F.col("n").cast("long").alias("n"), F.round("psi", 6).alias("psi"),
        (F.col("psi") >= F.lit(params.psi_threshold)).alias("drift"))


# ------------------------------------------------------------------ exact two-sample KS law
EXACT_MAX_N = 10_000  # fixed value: exact law up to this sample size, asymptotic above


def ks_exact_pvalue(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for two samples of sizes n1, n2 under H0 (no ties), by counting the
    monotone lattice paths from (0, 0) to (n1, n2) that stay strictly inside
    |i/n1 - j/n2| < d. Inside one row the allowed cells form an interval, so a row of
    counts is a cumulative sum of the previous row; rows are rescaled to avoid overflow."""
    if n1 <= 0 or n2 <= 0:
        return 1.0
    if n1 > n2:
        n1, n2 = n2, n1
    h = int(round(d * n1 * n2))  # D = |a*n2 - b*n1| / (n1*n2): an integer lattice distance
    if h <= 0:
        return 1.0
    j = np.arange(n2 + 1)
    row = np.where(j * n1 < h, 1.0, 0.0)
    # the path must stay contiguous from (0, 0): cut at the first outside cell
    first_out = np.argmax(row == 0) if (row == 0).any() else n2 + 1
    row[first_out:] = 0.0
    log_scale = 0.0
    for i in range(1, n1 + 1):
        inside = np.abs(i * n2 - j * n1) < h
        if not inside.any():
            return 1.0
        a, b = int(np.argmax(inside)), int(len(inside) - 1 - np.argmax(inside[::-1]))
        new = np.zeros(n2 + 1)
        new[a:b + 1] = np.cumsum(row[a:b + 1])
        s = new.max()
        if s <= 0:
            return 1.0
        row = new / s
        log_scale += math.log(s)
    if row[n2] <= 0:
        return 1.0
    log_inside = math.log(row[n2]) + log_scale - (math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1))
    return float(min(1.0, max(0.0, 1.0 - math.exp(log_inside))))


def ks_pvalue_by(ks: DataFrame, law: str = "by size", exact_up_to: int = EXACT_MAX_N) -> DataFrame:
    """Adds ``ks_pvalue_exact`` and ``ks_method`` by the law asked for: "exact", "asymptotic", or
    "by size", the configured habit of taking the exact law while both samples have at most
    ``exact_up_to`` rows. Runs as a pandas UDF over the aggregated (batch, feature) rows - one row
    per feature and batch, never per data row; exact counting takes time in n_ref * n_cur."""
    if law not in ("exact", "asymptotic", "by size"):
        raise ValueError(f"{law!r} is no law of the KS statistic")

    @F.pandas_udf("double")
    def exact(d: pd.Series, n1: pd.Series, n2: pd.Series, wanted: pd.Series) -> pd.Series:
        # paths are counted for the rows that want it only
        return pd.Series([ks_exact_pvalue(float(a), int(b), int(c)) if w else float("nan")
                          for a, b, c, w in zip(d, n1, n2, wanted, strict=True)])

    small = F.greatest(F.col("n_ref"), F.col("n_cur")) <= F.lit(exact_up_to)
    by_exact = {"exact": F.lit(True), "asymptotic": F.lit(False), "by size": small}[law]
    return ks.withColumn("ks_method", F.when(by_exact, F.lit("exact")).otherwise(F.lit("asymptotic"))).withColumn(
        "ks_pvalue_exact", F.when(by_exact, exact("ks_stat", "n_ref", "n_cur", by_exact)).otherwise(F.col("ks_pvalue")))


def ks_pvalue_auto(ks: DataFrame) -> DataFrame:
    """``ks_pvalue_by`` size."""
    return ks_pvalue_by(ks, "by size")


# ------------------------------------------------------------------ verdict
def drift_verdict(summary: DataFrame, pca: DataFrame, params: DriftParams = DriftParams()) -> DataFrame:
    """Per batch: verdict text, PCA state word, top list, thresholds, retrain flag. ``pca`` has one
    row per batch (batch, pca_recon_ratio, multivariate_drift)."""
    j = summary.join(F.broadcast(pca.select("batch", "pca_recon_ratio", "multivariate_drift")), "batch")
    n = F.col("n_features_drifted")
    any_drift = (n > 0) | F.col("multivariate_drift")
    return j.select(
        "batch", "n_features_drifted", "n_features", "share_drifted", "pca_recon_ratio", "multivariate_drift",
        F.when(n == 0, F.lit("NO DRIFT")).otherwise(F.concat(n.cast("string"), F.lit(" features drifted"))).alias("verdict"),
        F.when(F.col("multivariate_drift"), F.lit("drift")).otherwise(F.lit("stable")).alias("pca_state"),
        F.when(F.col("top_drifted") == "", F.lit("-")).otherwise(F.col("top_drifted")).alias("top_drifted"),
        F.lit(params.psi_threshold).alias("psi_threshold"),
        F.lit(params.pca_drift_ratio).alias("pca_drift_ratio_threshold"),
        any_drift.alias("drift_detected"),
        (any_drift & F.lit(params.trigger_retrain_on_drift)).alias("retrain"),
    )
