"""Ordering helpers: dense row numbers and running sums with one exchange of the rows.

A plain ``sum().over(Window.partitionBy(group).orderBy(...))`` brings all rows of a group into
one task. Here a group with more rows than a range should hold is cut into ranges of its first
order column. The cuts come from an approximate quantile table that is taken once and becomes
part of the plan as literals, so every evaluation of the plan, also after executor loss, deals a
row into the same range; whether the cuts are exact quantiles doesn't matter for the result. The
rows are exchanged once by (group, range) and numbered or summed within; totals of the earlier
ranges of the group are added from a small broadcast table.

Bounds: a range should hold ``max(RANGE_ROWS, total rows / MAX_RANGES)`` rows. So at most
``MAX_RANGES`` groups are cut, and the table of range totals has at most ``MAX_RANGES ** 2 / 4``
rows; only those two tables reach the driver or are broadcast. Groups that are not cut, however
many there are, have no row in either. Nothing is checkpointed.

Null groups are groups like others; null order values come first. Callers pass order columns that
are unique within a group (add a key as a tie-breaker); then results do not depend on scheduling.
Rows that share one value of the first order column stay in one range.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_ROWS = 500_000
MAX_RANGES = 1_000
#: Cuts are compared in steps: every STEP-th first, then the ones of the step.
STEP = 32


def _place(df: DataFrame, column: str) -> Column:
    """A number that never falls where the column rises."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        # the first seven bytes; strings are ordered by their bytes
        return F.conv(F.rpad(F.substring(F.hex(c), 1, 14), 14, "0"), 16, 10).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.NumericType):
        return c
    return c.cast("timestamp").cast("double") if isinstance(kind, (T.DateType, T.TimestampNTZType)) else c.cast("double")


def _cut_table(df: DataFrame, pc: list[str], first: str, ranges: int | None) -> DataFrame | None:
    """(group columns, _cuts) of the groups to cut; None where no group has too many rows."""
    sizes = df.groupBy(*pc).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).first()[0] if pc else sizes.first()[0]
    most = max(RANGE_ROWS, -(-(total or 0) // MAX_RANGES)) if ranges is None else max(1, -(-(total or 0) // ranges))
    if (total or 0) <= most:
        return None
    large = sizes.where(F.col("_n") > most).collect()  # at most total / most of them
    if not large:
        return None
    cuts = min(MAX_RANGES, -(-max(r["_n"] for r in large) // most))
    shares = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    spark = df.sparkSession
    kinds = T.StructType([T.StructField(f"_g{i}", df.schema[c].dataType) for i, c in enumerate(pc)])
    of_large = df
    if pc:
        groups = spark.createDataFrame([tuple(r[c] for c in pc) for r in large], kinds)
        of_large = df.join(F.broadcast(groups), reduce(
            lambda a, b: a & b, [df[f"`{c}`"].eqNullSafe(groups[f"_g{i}"]) for i, c in enumerate(pc)]), "left_semi")
    place = _place(df, first)
    found = of_large.groupBy(*pc).agg(F.percentile_approx(place, shares, F.lit(5_000)).alias("_cuts"))
    kinds = kinds.add("_cuts", found.schema["_cuts"].dataType)
    rows = [(*[r[c] for c in pc], sorted(set(r["_cuts"]))) for r in found.collect() if r["_cuts"]]
    return spark.createDataFrame(rows, kinds)


def _ranged(df: DataFrame, pc: list[str], first: str, ranges: int | None) -> DataFrame | None:
    """The rows with ``_range``, the number of their group's cuts at or below them (-1 in groups without cuts)."""
    cuts = _cut_table(df, pc, first, ranges)
    if cuts is None:
        return None
    place = _place(df, first)
    if pc:
        on = reduce(lambda a, b: a & b, [df[f"`{c}`"].eqNullSafe(cuts[f"_g{i}"]) for i, c in enumerate(pc)])
        joined = df.join(F.broadcast(cuts), on, "left").drop(*[f"_g{i}" for i in range(len(pc))])
    else:
        one = cuts.first()
        if one is None:
            return None
        kind = cuts.schema["_cuts"].dataType
        joined = df.withColumn("_cuts", F.array(*[F.lit(x) for x in one["_cuts"]]).cast(kind))
    steps = F.size(F.filter(F.transform(F.sequence(F.lit(STEP), F.size("_cuts") - F.size("_cuts") % STEP, F.lit(STEP)),
                                        lambda i: F.get(F.col("_cuts"), i - 1)), lambda c: c <= place))
    steps = F.when(F.size("_cuts") >= STEP, steps).otherwise(F.lit(0))
    within = F.size(F.filter(F.slice("_cuts", steps * STEP + 1, F.lit(STEP)), lambda c: c <= place))
    return joined.withColumn("_range", F.when(F.col("_cuts").isNull(), F.lit(-1)).otherwise(steps * STEP + within)).drop("_cuts")


def _cumulated(df: DataFrame, oc: list[str], sums: dict[str, Column], pc: list[str], ranges: int | None, ties: bool = False) -> DataFrame:
    """Each expression of ``sums`` summed within the group up to and including the row, or its ties."""
    def up_to_here(*groups) -> Window:
        w = Window.partitionBy(*groups).orderBy(*oc)
        return (w.rangeBetween if ties else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)

    with_ranges = _ranged(df, pc, oc[0], ranges)
    if with_ranges is None:
        w = up_to_here(*(pc or [F.lit(0)]))
        return df.select("*", *[F.sum(e).over(w).alias(name) for name, e in sums.items()])
    w = up_to_here(*pc, "_range")
    local = with_ranges.select("*", *[F.sum(e).over(w).alias(name) for name, e in sums.items()])
    totals = (with_ranges.where(F.col("_range") >= 0).groupBy(*[F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(pc)], F.col("_range").alias("_r"))
              .agg(*[F.sum(e).alias(f"_t_{name}") for name, e in sums.items()]))
    earlier = Window.partitionBy(*[f"_g{i}" for i in range(len(pc))] or [F.lit(0)]).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[f"_g{i}" for i in range(len(pc))], "_r",
                            *[F.sum(f"_t_{name}").over(earlier).alias(f"_o_{name}") for name in sums])
    on = reduce(lambda a, b: a & b, [local[f"`{c}`"].eqNullSafe(offsets[f"_g{i}"]) for i, c in enumerate(pc)],
                local["_range"] == offsets["_r"])
    joined = local.join(F.broadcast(offsets), on, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[(F.coalesce(F.col(f"_o_{name}"), F.lit(0)) + F.col(name)).alias(name) for name in sums])


def dense_index(
    df: DataFrame,
    order_cols: Sequence[str],
    out: str = "row_idx",
    partition_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position of each row within its ``partition_cols`` group,
    ordered by ``order_cols`` (ascending). ``num_partitions``: ranges to cut all rows into."""
    numbered = _cumulated(df, list(order_cols), {out: F.lit(1)}, list(partition_cols), num_partitions)
    return numbered.withColumn(out, (F.col(f"`{out}`") - 1).cast("long"))


def running_sums(
    df: DataFrame,
    order_cols: Sequence[str],
    sum_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    suffix: str = "_cum",
    num_partitions: int | None = None,
    ties: bool = False,
) -> DataFrame:
    """Add ``<c><suffix>`` = inclusive running sum of each ``sum_cols`` column within the
    ``partition_cols`` group in ``order_cols`` order. Collapse ties before calling, or have them
    summed up together with ``ties``."""
    sums = {f"{c}{suffix}": F.col(f"`{c}`") for c in sum_cols}
    return _cumulated(df, list(order_cols), sums, list(partition_cols), num_partitions, ties)
