"""Data-quality expectations (E1-E11): rules are data, one aggregate pass runs them all.

Semantics of the rule kinds: bounds inclusive, ``None`` bound open; nulls are ignored by
``between`` and ``in_set``; a missing column fails its rule; the table rule compares the
column count from the schema (no data pass).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..params import QualityParams

# fixed values: expectation type names used in reports and gate messages
EXPECT_COLUMN_COUNT = "expect_table_column_count_to_equal"
EXPECT_BETWEEN = "expect_column_values_to_be_between"
EXPECT_IN_SET = "expect_column_values_to_be_in_set"
EXPECT_NOT_NULL = "expect_column_values_to_not_be_null"

REPORT_SCHEMA = "rule_id int, expectation string, column string, success boolean, n_failed_rows long"


@dataclass(frozen=True)
class Rule:
    rule_id: int
    expectation: str
    column: str
    args: tuple = ()


def build_suite(params: QualityParams = QualityParams()) -> list[Rule]:
    rules = [Rule(1, EXPECT_COLUMN_COUNT, "", (params.expected_column_count,))]
    for col, lo, hi in params.ranges:
        rules.append(Rule(len(rules) + 1, EXPECT_BETWEEN, col, (lo, hi)))
    for col, allowed in params.value_sets:
        rules.append(Rule(len(rules) + 1, EXPECT_IN_SET, col, tuple(allowed)))
    for col in params.not_null:
        rules.append(Rule(len(rules) + 1, EXPECT_NOT_NULL, col))
    return rules


def broken(rule: Rule, columns: list[str]) -> Column | None:
    """Row-level predicate: true where the row breaks the rule (None for table rules)."""
    if rule.expectation == EXPECT_COLUMN_COUNT:
        return None
    if rule.column not in columns:
        return F.lit(True)
    c = F.col(f"`{rule.column}`")
    if rule.expectation == EXPECT_BETWEEN:
        lo, hi = rule.args
        conds = []
        if lo is not None:
            conds.append(c < F.lit(lo))
        if hi is not None:
            conds.append(c > F.lit(hi))
        if not conds:
            return F.lit(False)
        out = conds[0]
        for x in conds[1:]:
            out = out | x
        return c.isNotNull() & out
    if rule.expectation == EXPECT_IN_SET:
        return c.isNotNull() & ~c.isin(list(rule.args))
    if rule.expectation == EXPECT_NOT_NULL:
        return c.isNull()
    raise ValueError(f"unknown expectation {rule.expectation}")


def _agg_columns(rules: list[Rule], columns: list[str]) -> list[Column]:
    aggs = []
    for r in rules:
        b = broken(r, columns)
        if b is not None:
            aggs.append(F.count_if(b).alias(f"r{r.rule_id}"))
    return aggs


def _report_from_counts(df: DataFrame, rules: list[Rule], counts_row: DataFrame) -> DataFrame:
    """Unpivot the one-row counts into the tidy report, adding table rules from the schema."""
    cols = list(df.columns)
    stack = []
    for r in rules:
        if r.expectation == EXPECT_COLUMN_COUNT:
            ok = len(cols) == r.args[0]
            n_failed = F.lit(None).cast("long")
            success = F.lit(ok)
        else:
            n_failed = F.col(f"r{r.rule_id}").cast("long")
            success = (n_failed == 0) & F.lit(r.column in cols)
        stack.append(F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.expectation).alias("expectation"),
            F.lit(r.column).alias("column"), success.alias("success"), n_failed.alias("n_failed_rows")))
    return counts_row.select(F.explode(F.array(*stack)).alias("r")).select("r.*")


def validate(df: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Run the suite in ONE aggregate pass; returns the report (one row per rule)."""
    rules = build_suite(params)
    aggs = _agg_columns(rules, list(df.columns))
    counts = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    return _report_from_counts(df, rules, counts)


def observe_suite(df: DataFrame, params: QualityParams = QualityParams()) -> tuple[DataFrame, Observation]:
    """Attach the suite to a pass that happens anyway (e.g. the validated-layer write):
    run ``write`` on the returned frame, then ``report_from_observation``."""
    rules = build_suite(params)
    obs = Observation("quality_suite")
    aggs = _agg_columns(rules, list(df.columns))
    return (df.observe(obs, *aggs) if aggs else df), obs


def report_from_observation(df: DataFrame, obs: Observation, params: QualityParams = QualityParams()) -> DataFrame:
    rules = build_suite(params)
    values = obs.get
    counted = [f"r{r.rule_id}" for r in rules if r.expectation != EXPECT_COLUMN_COUNT]
    absent = [name for name in counted if values.get(name) is None]
    if absent:
        raise QualityGateError(f"the observed pass has no counts for {absent}; the batch was not checked")
    spark = df.sparkSession
    row = spark.range(1).select(*[F.lit(int(values[name])).cast("long").alias(name) for name in counted])
    return _report_from_counts(df, rules, row)


def summarize(report: DataFrame) -> DataFrame:
    """Suite summary (E8): success, n_expectations, n_failed."""
    return report.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("n_expectations"),
        F.count_if(~F.col("success")).alias("n_failed"),
    )


class QualityGateError(ValueError):
    pass


def gate(report: DataFrame) -> None:
    """Raise when any expectation failed (E9). The report is small (one row per rule)."""
    rows = report.orderBy("rule_id").collect()
    broken_rules = ", ".join(f"{r['expectation']} on {r['column'] or 'the table'}" for r in rows if not r["success"])
    if broken_rules:
        raise QualityGateError(f"Data quality gate FAILED: the batch breaks {broken_rules}")


def _broken_names(df: DataFrame, params: QualityParams) -> Column:
    rules = [r for r in build_suite(params) if r.expectation != EXPECT_COLUMN_COUNT]
    cols = list(df.columns)
    return F.array_compact(F.array(*[F.when(broken(r, cols), F.lit(f"{r.expectation}({r.column})")) for r in rules]))


def good_rows(df: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Rows that break no row-level rule."""
    return df.filter(F.size(_broken_names(df, params)) == 0)


def bad_rows(df: DataFrame, params: QualityParams = QualityParams(), key: str = "ID") -> DataFrame:
    """Rows that break any row-level rule, with the names of the broken rules."""
    return (df.withColumn("_failed", _broken_names(df, params))
            .filter(F.size("_failed") > 0)
            .withColumn("failed_rules", F.concat_ws(";", "_failed"))
            .withColumn("n_failed_rules", F.size("_failed").cast("int"))
            .drop("_failed"))
