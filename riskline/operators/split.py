"""Splitting, sampling and the drift baseline.

Stratified split with exact per-class counts: class sizes are counted (one tiny
aggregate, one row per class), hold-out counts are allocated by the largest-remainder
rule (kept part first, as the reference's splitter does), and each class is ranked by
``md5(key:seed)``. Ranking uses ``dense_index`` so a dominant class is spread over many
tasks instead of landing in one window partition.

Row identity differs from any numpy-seeded splitter; sizes, class counts and
determinism are what we match.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import FEATURE_COLS, DriftParams, SplitParams
from .ordering import dense_index, running_sums

SPLIT_COL = "split"


def hash_order(key: str, seed: int) -> Column:
    """Reproducible pseudo-random order key, identical in Spark and DuckDB."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def largest_remainder(counts: dict, frac: float) -> dict:
    """Hold-out rows per class when ``ceil(N * frac)`` rows are held out overall.
    Kept rows ``N - ceil(N*frac)`` are shared by floor + largest fractional part
    (ties by class value); hold-out = class size - kept."""
    total_n = sum(counts.values())
    keep_total = total_n - math.ceil(total_n * frac)
    shares = {k: keep_total * n / total_n for k, n in counts.items()}
    kept = {k: math.floor(s) for k, s in shares.items()}
    left = keep_total - sum(kept.values())
    for k in sorted(counts, key=lambda k: (-(shares[k] - math.floor(shares[k])), k))[:left]:
        kept[k] += 1
    return {k: counts[k] - kept[k] for k in counts}


def allocation(counts: DataFrame, frac: float, cls: str = "_cls", n: str = "_n") -> DataFrame:
    """In-plan largest-remainder allocation over a class-count table (one row per class,
    so the un-partitioned windows here see only that many rows). Adds ``_keep``/``_hold``."""
    every = Window.partitionBy()
    total = F.sum(n).over(every)
    keep_total = total - F.ceil(total.cast("double") * F.lit(float(frac))).cast("long")
    # exact at any row count: a decimal product, its quotient and its remainder
    t = counts.select(cls, n, total.alias("_total"), keep_total.alias("_keep_total"))
    t = t.withColumn("_prod", F.col("_keep_total").cast("decimal(19,0)") * F.col(n).cast("decimal(19,0)"))
    t = t.select("*", F.expr("_prod div _total").cast("long").alias("_fl"), F.expr("_prod % _total").alias("_fr"))
    t = t.select("*", F.row_number().over(Window.orderBy(F.desc("_fr"), F.asc(cls))).alias("_r"),
                 (F.col("_keep_total") - F.sum("_fl").over(every)).alias("_left"))
    keep = F.col("_fl") + (F.col("_r") <= F.col("_left")).cast("long")
    return t.select(cls, n, keep.alias("_keep"), (F.col(n) - keep).alias("_hold"))


def stratified_split(features: DataFrame, params: SplitParams = SplitParams(), key: str = "customer_id") -> DataFrame:
    """Add ``split`` in {'train','val','test'}: test first, then val out of the remainder.
    Class counts and allocations stay inside the plan (a tiny broadcast table), so the
    split is computed in one pass with no driver round trip."""
    target = params.target_column
    if params.stratify and not params.shuffle:
        raise ValueError("Stratified train/test split is not implemented for shuffle=False")
    val_rel = params.val_size / (1.0 - params.test_size)
    df = features.withColumn("_cls", F.col(target) if params.stratify else F.lit(0))
    counts = df.groupBy("_cls").agg(F.count(F.lit(1)).alias("_n"))
    test = allocation(counts, params.test_size).select("_cls", F.col("_keep").alias("_n"), F.col("_hold").alias("_t"))
    val = allocation(test.select("_cls", "_n"), val_rel).select("_cls", F.col("_hold").alias("_v"))
    limits = test.join(val, "_cls").select("_cls", "_t", (F.col("_t") + F.col("_v")).alias("_tv"))
    if params.shuffle:
        df = df.withColumn("_ord", hash_order(key, params.random_seed))
        ranked = dense_index(df, ["_ord", key], out="_rk", partition_cols=["_cls"])
    else:
        # unshuffled: the last rows (by key) are held out
        df = df.withColumn("_ord", -F.col(key))
        ranked = dense_index(df, ["_ord"], out="_rk", partition_cols=["_cls"])
    # one row per class: safe to broadcast
    out = ranked.join(F.broadcast(limits), "_cls").withColumn(
        SPLIT_COL,
        F.when(F.col("_rk") < F.col("_t"), F.lit("test")).when(F.col("_rk") < F.col("_tv"), F.lit("val"))
        .otherwise(F.lit("train")),
    )
    return out.drop("_rk", "_ord", "_cls", "_t", "_tv")


def feature_matrix(df: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """P5: drop the target (must exist) and whichever id columns exist."""
    if params.target_column not in df.columns:
        raise KeyError(f"target column {params.target_column!r} missing")
    return df.drop(params.target_column, *[c for c in params.id_columns if c in df.columns])


#: Hex digits of the order key that one step of the cut-off search tells apart.
CUT_DIGITS = 3
#: Below so many rows the order keys themselves are looked at.
CUT_ROWS = 4_096


def _cut_off(keyed: DataFrame, size: int) -> tuple[str, object] | None:
    """The last (order key, key) of the ``size`` smallest; None where there are no more rows than that.

    Rows are counted by a few hex digits of the md5, then by more digits within the range that the
    cut falls into, until few are left: at most 16 ** CUT_DIGITS counts reach the driver at a time."""
    prefix, before = "", 0
    while True:
        inside = keyed.where(F.col("_ord").startswith(prefix)) if prefix else keyed
        counts = sorted((r["p"], r["n"]) for r in inside.groupBy(F.substring("_ord", 1, len(prefix) + CUT_DIGITS).alias("p"))
                        .agg(F.count(F.lit(1)).alias("n")).collect())
        if not prefix and sum(n for _, n in counts) <= size:
            return None
        for prefix, n in counts:
            if before + n >= size:
                break
            before += n
        if n <= CUT_ROWS or len(prefix) >= 30:
            break
    last = keyed.where(F.col("_ord").startswith(prefix)).orderBy("_ord", "_key").limit(size - before).agg(
        F.max(F.struct("_ord", "_key")).alias("last")).first()["last"]
    return last["_ord"], last["_key"]


def seeded_sample(df: DataFrame, size: int, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, size)`` rows, reproducible: the ``size`` smallest md5(key:seed).

    The cut-off is found first from counts; the sample is then a filter on the order key, which
    moves no rows. ``key`` is unique and not null."""
    if size <= 0:
        return df.limit(0)
    keyed = df.select(hash_order(key, seed).alias("_ord"), F.col(f"`{key}`").alias("_key"))
    last = _cut_off(keyed, size)
    if last is None:
        return df
    order = hash_order(key, seed)
    return df.where((order < F.lit(last[0])) | ((order == F.lit(last[0])) & (F.col(f"`{key}`") <= F.lit(last[1]))))


def exact_quantiles(df: DataFrame, column: str, qs: list[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation between order statistics
    (h = (n-1) q, as numpy/pandas 'linear'). Built from per-value counts and distributed
    running sums; only the <= 2 order statistics per quantile reach the driver."""
    vc = (df.groupBy(F.col(f"`{column}`").cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
          .filter(F.col("v").isNotNull()))
    n = vc.agg(F.sum("c")).first()[0] or 0
    if n == 0:
        return [None for _ in qs]
    plan = []
    for q in qs:
        h = (n - 1) * q
        k0 = int(math.floor(h))
        plan.append((h, k0, min(k0 + 1, n - 1)))
    cum = running_sums(vc, ["v"], ["c"])  # rows <= v as c_cum
    cover = F.lit(False)
    for k in sorted({k for _, k0, k1 in plan for k in (k0, k1)}):
        cover = cover | ((F.col("c_cum") - F.col("c") <= F.lit(k)) & (F.lit(k) < F.col("c_cum")))
    runs = [(r["v"], r["c_cum"] - r["c"], r["c_cum"]) for r in cum.filter(cover).collect()]

    def at(k):
        return next(v for v, lo, hi in runs if lo <= k < hi)

    return [at(k0) + (h - k0) * (at(k1) - at(k0)) for h, k0, k1 in plan]


def drift_samples(test: DataFrame, params: DriftParams = DriftParams(), key: str = "customer_id") -> tuple[DataFrame, DataFrame]:
    """Clean control batch and a batch biased to ``bias_column >= quantile``.
    The threshold is one exact scalar (P11), inlined as a literal in the filter."""
    clean = seeded_sample(test, params.sample_size, key, params.sample_seed)
    (thr,) = exact_quantiles(test, params.bias_column, [params.bias_quantile])
    biased = test.filter(F.col(params.bias_column) >= F.lit(thr))
    drifted = seeded_sample(biased, params.sample_size, key, params.sample_seed)
    return clean, drifted


def whole_batches(test: DataFrame, threshold: float | None, params: DriftParams = DriftParams()) -> DataFrame:
    """The test rows with a column ``batch``, once for each batch they belong to: all of them in the
    clean one, those at or above the threshold in the drifted one. One scan, nothing sampled."""
    biased = F.col(params.bias_column) >= F.lit(threshold)
    of = F.when(biased, F.array(F.lit("clean"), F.lit("drifted"))).otherwise(F.array(F.lit("clean")))
    return test.withColumn("batch", F.explode(of))


def reference_profile(train: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Per-feature moments and range of the frozen training baseline."""
    long = train.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features]).unpivot(
        [], features, "feature", "value")
    return long.groupBy("feature").agg(
        F.count("value").cast("long").alias("n"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
