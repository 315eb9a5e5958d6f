"""SQL-text builders for formulas used by both Spark (via ``F.expr``) and the DuckDB oracle.

One text per formula keeps both engines on the identical arithmetic (same operation
order, so the same IEEE results), and ``F.expr`` costs one JVM call instead of one per
Column operator when the plan is built.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(c: str) -> str:
    """Quote an identifier for Spark (backticks)."""
    return f"`{c}`"


def bin_index_sql(v: str, lo: str, step: str, nb: int) -> str:
    """Bin of v against edges lo + i*step (i = 1..nb-1): half-open bins, last closed."""
    return "(" + " + ".join(f"CAST({v} >= {lo} + {float(i)!r} * {step} AS INTEGER)" for i in range(1, nb)) + ")"


def kolmogorov_sql(d: str, n1: str, n2: str, terms: int = 12) -> str:
    """Two-sided asymptotic KS p-value with Stephens' factor, clipped to [0, 1]."""
    en = f"(CAST({n1} AS DOUBLE) * CAST({n2} AS DOUBLE) / CAST({n1} + {n2} AS DOUBLE))"
    z = f"((sqrt({en}) + 0.12 + 0.11 / sqrt({en})) * {d})"
    small = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0!r} / ({z} * {z}))" for k in range(1, terms + 1))
    large = " + ".join(f"{float((-1) ** (k - 1))!r} * exp({-2.0 * k * k!r} * {z} * {z})" for k in range(1, terms + 1))
    p = (f"CASE WHEN {z} <= 0 THEN 1.0 WHEN {z} < 1.18 THEN 1.0 - {math.sqrt(2 * math.pi)!r} / {z} * ({small}) "
         f"ELSE 2.0 * ({large}) END")
    return f"greatest(0.0, least(1.0, {p}))"


def sum_sql(cols: Sequence[str], quote=q) -> str:
    return "(" + " + ".join(quote(c) for c in cols) + ")"


def derived_feature_sql(quote=q) -> list[tuple[str, str]]:
    """(name, SQL) of the 10 behavioural features over the cleaned long columns.
    Cleaned columns hold no nulls (the cast step fails on null), so row means are sum/6."""
    from ..params import BILL_COLS, PAY_COLS, PAYAMT_COLS

    pay, bill, amt = sum_sql(PAY_COLS, quote), sum_sql(BILL_COLS, quote), sum_sql(PAYAMT_COLS, quote)
    avg_bill = f"(CAST({bill} AS DOUBLE) / 6.0)"
    delayed = " + ".join(f"CASE WHEN {quote(c)} > 0 THEN 1 ELSE 0 END" for c in PAY_COLS)
    return [
        ("pay_delay_max", f"CAST(greatest({', '.join(quote(c) for c in PAY_COLS)}) AS BIGINT)"),
        ("pay_delay_mean", f"CAST({pay} AS DOUBLE) / 6.0"),
        ("n_months_delayed", f"CAST({delayed} AS BIGINT)"),
        ("avg_bill", avg_bill),
        ("max_bill", f"CAST(greatest({', '.join(quote(c) for c in BILL_COLS)}) AS BIGINT)"),
        ("bill_trend", f"CAST({quote('BILL_AMT1')} - {quote('BILL_AMT6')} AS BIGINT)"),
        ("avg_pay_amt", f"CAST({amt} AS DOUBLE) / 6.0"),
        ("total_pay", f"CAST({amt} AS BIGINT)"),
        # avg_bill / LIMIT_BAL with +-inf and NaN mapped to 0: only a zero limit produces them
        ("util_ratio", f"CASE WHEN {quote('LIMIT_BAL')} = 0 THEN 0.0 ELSE {avg_bill} / CAST({quote('LIMIT_BAL')} AS DOUBLE) END"),
        ("pct_paid", f"greatest(0.0, least(2.0, CASE WHEN {bill} > 0 THEN CAST({amt} AS DOUBLE) / CAST({bill} AS DOUBLE) ELSE 0.0 END))"),
    ]


def expr(sql: str, name: str | None = None) -> Column:
    e = F.expr(sql)
    return e.alias(name) if name else e
