"""Queries for the source, quality, cleaning and feature stages, with their oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.clean import clean_with_order
from ..params import CLEAN_COLS, DEFAULTS, RAW_COLS
from ..sources.credit import credit_profile, credit_profile_dirty
from . import oracle_base as O
from ..sources.tables import read_raw_csv, write_csv
from .stages import cleaned, features, layer_folder


# ---------------------------------------------------------------- spark side
def q_credit_profile(spark: SparkSession, sf: str) -> DataFrame:
    return credit_profile(spark, sf)


def q_credit_profile_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return credit_profile_dirty(spark, sf)


def q_credit_profile_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The raw layer as CSV with a header, scanned with the explicit raw schema."""
    path = layer_folder(spark, sf, "raw_csv")
    write_csv(credit_profile(spark, sf).select(*[F.col(f"`{c}`") for c in RAW_COLS]), path)
    return read_raw_csv(spark, path)


def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return Q.validate(credit_profile_dirty(spark, sf), DEFAULTS.quality)


def q_quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    good = Q.summarize(Q.validate(credit_profile(spark, sf), DEFAULTS.quality)).withColumn("batch", F.lit("credit_profile"))
    bad = Q.summarize(Q.validate(credit_profile_dirty(spark, sf), DEFAULTS.quality)).withColumn("batch", F.lit("credit_profile_dirty"))
    return good.unionByName(bad).select("batch", "success", "n_expectations", "n_failed")


def q_quality_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    return Q.bad_rows(credit_profile_dirty(spark, sf), DEFAULTS.quality)


def q_clean(spark: SparkSession, sf: str) -> DataFrame:
    c, _ = cleaned(spark, sf)
    return c.drop("_row_order")


def q_clean_report(spark: SparkSession, sf: str) -> DataFrame:
    _, counts = cleaned(spark, sf)
    return counts


def q_features(spark: SparkSession, sf: str) -> DataFrame:
    return features(spark, sf)


# ---------------------------------------------------------------- oracle side
def _rule_sql(rule: Q.Rule, cols: list[str]) -> str | None:
    c = f'"{rule.column}"'
    if rule.expectation == Q.EXPECT_COLUMN_COUNT:
        return None
    if rule.column not in cols:
        return "TRUE"
    if rule.expectation == Q.EXPECT_BETWEEN:
        lo, hi = rule.args
        parts = []
        if lo is not None:
            parts.append(f"{c} < {lo}")
        if hi is not None:
            parts.append(f"{c} > {hi}")
        return f"({c} IS NOT NULL AND ({' OR '.join(parts) or 'FALSE'}))"
    if rule.expectation == Q.EXPECT_IN_SET:
        return f"({c} IS NOT NULL AND {c} NOT IN ({', '.join(str(v) for v in rule.args)}))"
    return f"({c} IS NULL)"


def _report_sql(src: str, cols: list[str]) -> str:
    rules = Q.build_suite(DEFAULTS.quality)
    rows = []
    for r in rules:
        pred = _rule_sql(r, cols)
        if pred is None:
            ok = "TRUE" if len(cols) == r.args[0] else "FALSE"
            rows.append(f"SELECT {r.rule_id} AS rule_id, '{r.expectation}' AS expectation, '' AS \"column\", {ok} AS success, CAST(NULL AS BIGINT) AS n_failed_rows")
        else:
            present = "TRUE" if r.column in cols else "FALSE"
            rows.append(
                f"SELECT {r.rule_id}, '{r.expectation}', '{r.column}', "
                f"(count(*) FILTER (WHERE {pred})) = 0 AND {present}, CAST(count(*) FILTER (WHERE {pred}) AS BIGINT) FROM {src}")
    return "\nUNION ALL\n".join(rows)


def _bad_rows_sql(src: str, cols: list[str]) -> str:
    rules = [r for r in Q.build_suite(DEFAULTS.quality) if r.expectation != Q.EXPECT_COLUMN_COUNT]
    names = ", ".join(f"CASE WHEN {_rule_sql(r, cols)} THEN '{r.expectation}({r.column})' END" for r in rules)
    return f"""SELECT * EXCLUDE (_f), array_to_string(_f, ';') AS failed_rules, CAST(len(_f) AS INTEGER) AS n_failed_rules
FROM (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS _f FROM {src})
WHERE len(_f) > 0"""


def oracles() -> dict[str, str]:
    cp = O.credit_profile_cte()
    dirty = cp + ",\n" + O.dirty_cte()
    clean_cols = ", ".join(f'"{c}"' for c in CLEAN_COLS)
    return {
        "credit_profile_csv": f"WITH {cp} SELECT * FROM credit_profile",
        "credit_profile": f"WITH {cp} SELECT * FROM credit_profile",
        "credit_profile_dirty": f"WITH {dirty} SELECT * FROM credit_profile_dirty",
        "quality_report": f"WITH {dirty} {_report_sql('credit_profile_dirty', RAW_COLS)}",
        "quality_summary": f"""WITH {dirty},
_a AS ({_report_sql('credit_profile', RAW_COLS)}),
_b AS ({_report_sql('credit_profile_dirty', RAW_COLS)})
SELECT 'credit_profile' AS batch, bool_and(success) AS success, count(*) AS n_expectations, count(*) FILTER (WHERE NOT success) AS n_failed FROM _a
UNION ALL
SELECT 'credit_profile_dirty', bool_and(success), count(*), count(*) FILTER (WHERE NOT success) FROM _b""",
        "quality_bad_rows": f"WITH {dirty} {_bad_rows_sql('credit_profile_dirty', RAW_COLS)}",
        "clean": f"WITH {cp},\n{O.clean_cte()} SELECT {clean_cols} FROM cleaned",
        "clean_report": f"""WITH {cp},
{O.duplicates_cte()},
_n AS (SELECT count(*) AS n_before FROM credit_with_dups),
_d AS (SELECT count(*) AS n_after FROM (SELECT DISTINCT * EXCLUDE ("ID") REPLACE (
    CASE WHEN "EDUCATION" IN (0, 5, 6) THEN 4 ELSE "EDUCATION" END AS "EDUCATION",
    CASE WHEN "MARRIAGE" IN (0) THEN 3 ELSE "MARRIAGE" END AS "MARRIAGE") FROM credit_with_dups))
SELECT CAST(n_before AS BIGINT) AS n_before, CAST(n_after AS BIGINT) AS n_after, CAST(n_before - n_after AS BIGINT) AS n_removed FROM _n, _d""",
        "features": f"WITH {cp},\n{O.features_cte()} SELECT * FROM features",
    }


QUERIES = {
    "credit_profile": q_credit_profile,
    "credit_profile_csv": q_credit_profile_csv,
    "credit_profile_dirty": q_credit_profile_dirty,
    "quality_report": q_quality_report,
    "quality_summary": q_quality_summary,
    "quality_bad_rows": q_quality_bad_rows,
    "clean": q_clean,
    "clean_report": q_clean_report,
    "features": q_features,
}
