"""Cleaning (P1-P4, K1): drop id, rename target, merge codes, exact de-duplication, cast.

De-duplication keeps the first-seen row deterministically: rows are grouped on all
cleaned columns and keep ``min(ID)`` as ``_row_order`` (the raw order key), taken
before the id is dropped. That group-by is the one full-row shuffle of the stage; its
partial aggregation collapses hot duplicate groups map-side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rowwise import col
from ..params import CleaningParams

ROW_ORDER = "_row_order"


def _require(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise KeyError(f"column {name!r} not found; have {df.columns}")



def clean_with_order(df: DataFrame, params: CleaningParams = CleaningParams()) -> tuple[DataFrame, DataFrame]:
    """Return ``(cleaned, counts)``: cleaned rows with ``_row_order`` and a one-row
    ``(n_before, n_after, n_removed)`` frame, both from the same grouped plan."""
    _require(df, params.id_column)
    merges = {c: (tuple(frm), to) for c, frm, to in params.category_merges}
    out_cols = []
    for c in df.columns:
        if c == params.id_column:
            continue
        name = params.target_column if c == params.target_column_raw else c
        e = f"`{c}`"
        if c in merges:
            frm, to = merges[c]
            e = f"CASE WHEN {e} IN ({', '.join(str(v) for v in frm)}) THEN {to} ELSE {e} END"
        out_cols.append(F.expr(e).alias(name))
    names = [params.target_column if c == params.target_column_raw else c for c in df.columns if c != params.id_column]
    merged = df.select(col(params.id_column).alias("_raw_id"), *out_cols)
    grouped = merged.groupBy(*[col(c) for c in names]).agg(
        F.min("_raw_id").alias(ROW_ORDER), F.count(F.lit(1)).alias("_copies"))
    # duplicates are told before the cast: truncation must not make rows equal; null fails loudly
    cleaned = grouped.select(*[
        F.expr(f"coalesce(CAST(`{c}` AS BIGINT), raise_error('cannot convert null in column {c} to integer'))").alias(c)
        for c in names], ROW_ORDER)
    counts = grouped.agg(
        F.sum("_copies").cast("long").alias("n_before"),
        F.count(F.lit(1)).cast("long").alias("n_after"),
    ).withColumn("n_removed", F.col("n_before") - F.col("n_after"))
    return cleaned, counts


def clean(df: DataFrame, params: CleaningParams = CleaningParams()) -> DataFrame:
    cleaned, _ = clean_with_order(df, params)
    return cleaned.drop(ROW_ORDER)
