"""Exploration aggregates (A1-A8, A12, A14, P12-P13, R5, E11) as long-form group-bys.

Many columns are summarised in ONE aggregate: ``unpivot`` to ``(column, value)`` and
group by the column name, so the job count does not grow with the number of columns.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sqlexpr import bin_index_sql


def long_form(df: DataFrame, cols: list[str], keep: list[str] = (), name: str = "column", value: str = "value",
              as_type: str = "double") -> DataFrame:
    wide = df.select(*[F.col(f"`{k}`") for k in keep], *[F.col(f"`{c}`").cast(as_type).alias(c) for c in cols])
    return wide.unpivot(list(keep), cols, name, value)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """A1: counts per (column, value), all columns in one aggregate."""
    return (long_form(df, cols, as_type="long").groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def undocumented(df: DataFrame, groups: list[tuple[str, list[str], list[int]]]) -> DataFrame:
    """Per group of columns, the codes outside the documented set,
    how many rows hold at least one of them and their share (percent, 4 dp).

    One aggregate pass counts rows per group; distinct codes come from a distributed
    group-by, and only the code lists (bounded by the code domain) reach the driver."""
    flags = []
    for label, cols, documented in groups:
        bad = [F.col(f"`{c}`").isNotNull() & ~F.col(f"`{c}`").isin(documented) for c in cols]
        any_bad = bad[0]
        for b in bad[1:]:
            any_bad = any_bad | b
        flags.append(F.count_if(any_bad).alias(label))
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *flags).first()
    total = counts["_total"]
    rows = []
    for label, cols, documented in groups:
        codes = [r[0] for r in long_form(df, cols, as_type="long").filter(~F.col("value").isin(documented))
                 .select("value").distinct().orderBy("value").collect()]
        n = int(counts[label])
        rows.append((label, ",".join(str(c) for c in codes), n, round(100.0 * n / total, 4) if total else 0.0))
    return df.sparkSession.createDataFrame(rows, "column string, undocumented_codes string, n_rows long, pct_rows double")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, std (ddof 1), min, max per column in one aggregate."""
    return long_form(df, cols, name="feature").groupBy("feature").agg(
        F.count("value").cast("long").alias("n"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def target_signal(df: DataFrame, cols: list[str], target: str = "default") -> DataFrame:
    """A5: mean per target class, transposed, with gap = mean(1) - mean(0)."""
    t = F.col(f"`{target}`")
    g = long_form(df, cols, keep=[target], name="feature").groupBy("feature").agg(
        F.avg(F.when(t == 0, F.col("value"))).alias("mean_0"),
        F.avg(F.when(t == 1, F.col("value"))).alias("mean_1"))
    return g.select("feature", F.round("mean_0", 6).alias("mean_0"), F.round("mean_1", 6).alias("mean_1"),
                    F.round(F.col("mean_1") - F.col("mean_0"), 6).alias("gap"))


def target_corr(df: DataFrame, cols: list[str], target: str = "default") -> DataFrame:
    """Pearson correlation with the target, ranked by absolute value (name breaks ties)."""
    g = long_form(df, cols, keep=[target], name="feature").groupBy("feature").agg(
        F.corr("value", F.col(f"`{target}`").cast("double")).alias("c"))
    g = g.select("feature", F.round("c", 6).alias("corr"))
    w = Window.orderBy(F.desc(F.abs("corr")), F.asc("feature"))  # one row per feature: tiny
    return g.withColumn("rank", F.row_number().over(w).cast("int"))


def class_weights(df: DataFrame, target: str = "default") -> DataFrame:
    """M2: balanced weights n / (k * n_class)."""
    every = Window.partitionBy()  # one row per class
    g = df.groupBy(F.col(f"`{target}`").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("label", "n", F.round(F.sum("n").over(every).cast("double")
                                          / (F.count(F.lit(1)).over(every) * F.col("n")), 6).alias("weight"))


def density_histogram(long_df: DataFrame, group: str, bins: int = 30) -> DataFrame:
    """Per group its own equal-width edges over [min, max]; density = n / width / N."""
    st = long_df.groupBy(group).agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                    F.count(F.lit(1)).alias("total"))
    st = st.select(group, "lo", "hi", "total", ((F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("step"))
    b = (long_df.join(F.broadcast(st), group)
         .select(group, F.expr(bin_index_sql("value", "lo", "step", bins)).alias("bin"))
         .groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = grid.join(b, [group, "bin"], "left").fillna(0, ["n"])
    lo_edge = F.col("lo") + F.col("bin").cast("double") * F.col("step")
    hi_edge = F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(
        F.col("lo") + (F.col("bin") + 1).cast("double") * F.col("step"))
    width = hi_edge - lo_edge
    return g.select(group, F.col("bin").cast("int").alias("bin"), F.round(lo_edge, 6).alias("bin_lo"),
                    F.col("n").cast("long").alias("n"),
                    F.round(F.try_divide(F.try_divide(F.col("n").cast("double"), width), F.col("total").cast("double")), 8)
                    .alias("density"))
