"""Shared DuckDB SQL building blocks for the oracle: the credit table and its derived layers.

Every oracle statement is ``WITH <ctes> SELECT ...`` over the pre-registered driver views.
"""
from __future__ import annotations

from ..params import BILL_COLS, CLEAN_COLS, FEATURE_COLS, PAY_COLS, PAYAMT_COLS
from ..sources.credit import SLOT_YEARS


def _q(c: str) -> str:
    return f'"{c}"'


def credit_profile_cte() -> str:
    per_order = ",\n       ".join(
        f"sum(CASE WHEN year(l_shipdate) = {y} THEN CAST(floor(l_extendedprice * (1.0 - l_discount)) AS BIGINT) END) AS pa{i}"
        for i, y in enumerate(SLOT_YEARS))
    aggs = []
    for i, y in enumerate(SLOT_YEARS):
        aggs += [
            f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS n{i}",
            f"count(*) FILTER (WHERE year(o_orderdate) = {y} AND o_orderstatus = 'O') AS o{i}",
            f"max(CASE WHEN year(o_orderdate) = {y} AND o_orderstatus = 'P' THEN 1 ELSE 0 END) AS p{i}",
            f"sum(CASE WHEN year(o_orderdate) = {y} THEN CAST(floor(o_totalprice) AS BIGINT) END) AS b{i}",
            f"sum(pa{i}) AS a{i}",
        ]
    per_cust = ",\n       ".join(aggs)
    pays = [
        f"CAST(CASE WHEN coalesce(n{i}, 0) = 0 THEN -2 ELSE least(8, 2 * o{i} - 1 + p{i}) END AS BIGINT)"
        for i in range(6)
    ]
    cols = [
        "CAST(c_custkey AS BIGINT) AS \"ID\"",
        "CAST(CASE WHEN c_acctbal <= 0 THEN 0 ELSE 10000 * (1 + c_custkey % 50) END AS BIGINT) AS \"LIMIT_BAL\"",
        "CAST(1 + c_custkey % 2 AS BIGINT) AS \"SEX\"",
        "CAST(c_custkey % 7 AS BIGINT) AS \"EDUCATION\"",
        "CAST(c_nationkey % 4 AS BIGINT) AS \"MARRIAGE\"",
        "CAST(21 + (c_custkey * 7919) % 59 AS BIGINT) AS \"AGE\"",
    ]
    cols += [f"{p} AS {_q(n)}" for p, n in zip(pays, PAY_COLS)]
    cols += [f"CAST(coalesce(b{i}, 0) AS BIGINT) AS {_q(n)}" for i, n in enumerate(BILL_COLS)]
    cols += [f"CAST(coalesce(a{i}, 0) AS BIGINT) AS {_q(n)}" for i, n in enumerate(PAYAMT_COLS)]
    cols.append(f"CAST(CASE WHEN 2 * {pays[0]} + {pays[1]} + (c_custkey * 31) % 7 >= 6 THEN 1 ELSE 0 END AS BIGINT) AS \"default payment next month\"")
    select_cols = ",\n       ".join(cols)
    return f"""_per_order AS (
  SELECT l_orderkey,
       {per_order}
  FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '{min(SLOT_YEARS)}-01-01' AND l_shipdate < TIMESTAMP '{max(SLOT_YEARS) + 1}-01-01'
  GROUP BY l_orderkey
),
_per_cust AS (
  SELECT o_custkey,
       {per_cust}
  FROM orders LEFT JOIN _per_order ON o_orderkey = l_orderkey
  GROUP BY o_custkey
),
credit_profile AS (
  SELECT {select_cols}
  FROM customer LEFT JOIN _per_cust ON c_custkey = o_custkey
)"""


def duplicates_cte(src: str = "credit_profile", name: str = "credit_with_dups") -> str:
    return f"""{name} AS (
  SELECT * FROM {src}
  UNION ALL
  SELECT * REPLACE ("ID" + 1000000000 AS "ID") FROM {src} WHERE "ID" % 100 = 0
)"""


def dirty_cte() -> str:
    return """_dirty_base AS (
  SELECT * REPLACE (
    CAST(CASE WHEN "ID" % 211 = 7 THEN -5 ELSE "AGE" END AS BIGINT) AS "AGE",
    CAST(CASE WHEN "ID" % 307 = 11 THEN 9 ELSE "SEX" END AS BIGINT) AS "SEX",
    CAST(CASE WHEN "ID" % 401 = 13 THEN NULL ELSE "LIMIT_BAL" END AS BIGINT) AS "LIMIT_BAL")
  FROM credit_profile
),
""" + duplicates_cte("_dirty_base", "credit_profile_dirty")


def clean_cte() -> str:
    """Cleaned table keyed by the first-seen raw ID (``_first_id``)."""
    cols = ", ".join(_q(c) for c in CLEAN_COLS)
    src_cols = []
    for c in CLEAN_COLS:
        if c == "EDUCATION":
            src_cols.append('CAST(CASE WHEN "EDUCATION" IN (0, 5, 6) THEN 4 ELSE "EDUCATION" END AS BIGINT) AS "EDUCATION"')
        elif c == "MARRIAGE":
            src_cols.append('CAST(CASE WHEN "MARRIAGE" IN (0) THEN 3 ELSE "MARRIAGE" END AS BIGINT) AS "MARRIAGE"')
        elif c == "default":
            src_cols.append('CAST("default payment next month" AS BIGINT) AS "default"')
        else:
            src_cols.append(f"CAST({_q(c)} AS BIGINT) AS {_q(c)}")
    return duplicates_cte() + f""",
_merged AS (
  SELECT "ID" AS _raw_id, {", ".join(src_cols)} FROM credit_with_dups
),
cleaned AS (
  SELECT min(_raw_id) AS _first_id, {cols} FROM _merged GROUP BY ALL
)"""


def features_cte() -> str:
    from ..functions.sqlexpr import derived_feature_sql

    clean_cols = ", ".join(_q(c) for c in CLEAN_COLS)
    derived = ",\n       ".join(f"{sql} AS {_q(name)}" for name, sql in derived_feature_sql(_q))
    return clean_cte() + f""",
features AS (
  SELECT CAST(row_number() OVER (ORDER BY _first_id) - 1 AS BIGINT) AS customer_id,
       {clean_cols},
       {derived},
       TIMESTAMP '2024-01-01 00:00:00' AS event_time
  FROM cleaned
)"""


def split_cte(seed: int = 42, test_size: float = 0.2, val_size: float = 0.1) -> str:
    """Stratified 3-way split: per class, rank by md5(key:seed); counts per class by the
    largest-remainder rule (kept part allocated first, hold-out = class count - kept)."""
    val_rel = val_size / (1.0 - test_size)
    return features_cte() + f""",
_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "default" ORDER BY md5(CAST(customer_id AS VARCHAR) || ':{seed}'), customer_id) - 1 AS _rk
  FROM features
),
_cls AS (
  SELECT "default" AS _cls, count(*) AS _n FROM features GROUP BY 1
),
{_largest_remainder_sql("_cls", test_size, "_alloc_test")},
_rest AS (SELECT _cls, _keep AS _n FROM _alloc_test),
{_largest_remainder_sql("_rest", val_rel, "_alloc_val")},
split_assign AS (
  SELECT r.*, CASE WHEN r._rk < t._hold THEN 'test' WHEN r._rk < t._hold + v._hold THEN 'val' ELSE 'train' END AS split
  FROM _ranked r JOIN _alloc_test t ON r."default" = t._cls JOIN _alloc_val v ON r."default" = v._cls
)"""


def _largest_remainder_sql(src: str, frac: float, name: str) -> str:
    """Kept rows = N - ceil(N * frac) shared over classes: floor shares, the rest to the
    largest fractional parts (ties by class value); hold-out per class = n - kept."""
    return f"""_tot_{name} AS (
  SELECT CAST(sum(_n) AS BIGINT) - CAST(ceil(CAST(sum(_n) AS DOUBLE) * {frac!r}) AS BIGINT) AS _total,
         CAST(sum(_n) AS BIGINT) AS _all FROM {src}
),
_sh_{name} AS (
  SELECT s._cls, s._n, t._total,
         CAST(floor(t._total * s._n / CAST(t._all AS DOUBLE)) AS BIGINT) AS _fl,
         t._total * s._n / CAST(t._all AS DOUBLE) - floor(t._total * s._n / CAST(t._all AS DOUBLE)) AS _fr
  FROM {src} s CROSS JOIN _tot_{name} t
),
_rk_{name} AS (
  SELECT *, row_number() OVER (ORDER BY _fr DESC, _cls) AS _r,
         _total - sum(_fl) OVER () AS _left
  FROM _sh_{name}
),
{name} AS (
  SELECT _cls, _n, _fl + CASE WHEN _r <= _left THEN 1 ELSE 0 END AS _keep,
         _n - (_fl + CASE WHEN _r <= _left THEN 1 ELSE 0 END) AS _hold
  FROM _rk_{name}
)"""


FEATURE_LIST_SQL = ", ".join(_q(c) for c in FEATURE_COLS)
