"""The credit table derived from the driver's customer/orders/lineitem tables.

One row per customer, 25 long columns in the raw credit layout. Six monthly slots map to
order years 2001..1996 (status, bill) and ship years 2001..1996 (payments).

Plan shape at scale: lineitem is filtered on ship date (pushed to the scan) and
pre-aggregated to one row per order before it meets orders, so the order join and the
per-customer aggregation each see at most one row per order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import BILL_COLS, PAY_COLS, PAYAMT_COLS, RAW_TARGET
from .tables import read_table

# fixed values: slot i of PAY_*/BILL_AMT*/PAY_AMT* is this calendar year
SLOT_YEARS = (2001, 2000, 1999, 1998, 1997, 1996)


def credit_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "year(o_orderdate) AS oy")
    lo, hi = min(SLOT_YEARS), max(SLOT_YEARS)
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .filter(f"l_shipdate >= TIMESTAMP '{lo}-01-01' AND l_shipdate < TIMESTAMP '{hi + 1}-01-01'")
        .selectExpr("l_orderkey", "year(l_shipdate) AS sy",
                    "CAST(floor(l_extendedprice * (1.0 - l_discount)) AS BIGINT) AS paid")
    )
    # one row per order: paid amount per ship-year slot
    per_order = lines.groupBy("l_orderkey").agg(*[
        F.expr(f"sum(CASE WHEN sy = {y} THEN paid END)").alias(f"pa{i}") for i, y in enumerate(SLOT_YEARS)
    ])
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    aggs: list[Column] = []
    for i, y in enumerate(SLOT_YEARS):
        aggs += [
            F.expr(f"count_if(oy = {y})").alias(f"n{i}"),
            F.expr(f"count_if(oy = {y} AND o_orderstatus = 'O')").alias(f"o{i}"),
            F.expr(f"max(CASE WHEN oy = {y} AND o_orderstatus = 'P' THEN 1 ELSE 0 END)").alias(f"p{i}"),
            F.expr(f"sum(CASE WHEN oy = {y} THEN CAST(floor(o_totalprice) AS BIGINT) END)").alias(f"b{i}"),
            F.expr(f"sum(pa{i})").alias(f"a{i}"),
        ]
    per_cust = joined.groupBy("o_custkey").agg(*aggs)
    c = customer.join(per_cust, customer.c_custkey == per_cust.o_custkey, "left")
    pays = [f"CAST(CASE WHEN coalesce(n{i}, 0) = 0 THEN -2 ELSE least(8, 2 * o{i} - 1 + p{i}) END AS BIGINT)"
            for i in range(len(SLOT_YEARS))]
    cols = [
        "CAST(c_custkey AS BIGINT) AS ID",
        "CAST(CASE WHEN c_acctbal <= 0 THEN 0 ELSE 10000 * (1 + c_custkey % 50) END AS BIGINT) AS LIMIT_BAL",
        "CAST(1 + c_custkey % 2 AS BIGINT) AS SEX",
        "CAST(c_custkey % 7 AS BIGINT) AS EDUCATION",
        "CAST(c_nationkey % 4 AS BIGINT) AS MARRIAGE",
        "CAST(21 + (c_custkey * 7919) % 59 AS BIGINT) AS AGE",
    ]
    cols += [f"{p} AS {n}" for p, n in zip(pays, PAY_COLS)]
    cols += [f"CAST(coalesce(b{i}, 0) AS BIGINT) AS {n}" for i, n in enumerate(BILL_COLS)]
    cols += [f"CAST(coalesce(a{i}, 0) AS BIGINT) AS {n}" for i, n in enumerate(PAYAMT_COLS)]
    cols.append(f"CAST(CASE WHEN 2 * {pays[0]} + {pays[1]} + (c_custkey * 31) % 7 >= 6 THEN 1 ELSE 0 END AS BIGINT) "
                f"AS `{RAW_TARGET}`")
    return c.selectExpr(*cols)


def with_duplicates(profile: DataFrame) -> DataFrame:
    """Add a copy of every row with ID % 100 = 0, its ID raised by 1e9 (exact duplicates once
    ID is dropped). One pass: each row emits itself and, when selected, its copy - a union
    of the profile with a filtered profile would plan the whole aggregation twice."""
    offsets = F.when(F.col("ID") % 100 == 0, F.array(F.lit(0).cast("long"), F.lit(1_000_000_000).cast("long"))) \
        .otherwise(F.array(F.lit(0).cast("long")))
    doubled = profile.select(F.explode(offsets).alias("_off"), "*")
    return doubled.select(*[(F.col("ID") + F.col("_off")).alias("ID") if c == "ID" else F.col(f"`{c}`")
                            for c in profile.columns])


def credit_profile_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrupted variant that must fail between / in-set / not-null checks (corrupt first, then copy)."""
    p = credit_profile(spark, sf_dir)
    fixes = {
        "AGE": "CASE WHEN ID % 211 = 7 THEN CAST(-5 AS BIGINT) ELSE AGE END",
        "SEX": "CASE WHEN ID % 307 = 11 THEN CAST(9 AS BIGINT) ELSE SEX END",
        "LIMIT_BAL": "CASE WHEN ID % 401 = 13 THEN CAST(NULL AS BIGINT) ELSE LIMIT_BAL END",
    }
    p = p.selectExpr(*[f"{fixes[c]} AS {c}" if c in fixes else f"`{c}`" for c in p.columns])
    return with_duplicates(p)
