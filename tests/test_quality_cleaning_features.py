import math

import pytest
from pyspark.sql import functions as F

from riskline.operators import quality as Q
from riskline.operators.clean import clean, clean_with_order
from riskline.operators.features import engineer_features
from riskline.params import CLEAN_COLS, DERIVED_COLS, RAW_TARGET


def test_suite_passes_on_clean_batch(sample_raw_df):
    report = Q.validate(sample_raw_df)
    rows = report.collect()
    assert len(rows) == 11
    assert all(r["success"] for r in rows)
    s = Q.summarize(report).first()
    assert s["success"] and s["n_expectations"] == 11 and s["n_failed"] == 0
    Q.gate(report)  # no raise


def test_broken_batch_fails_and_gate_raises(sample_raw_df):
    broken = sample_raw_df.withColumn("AGE", F.when(F.col("ID") == 1, F.lit(-5)).otherwise(F.col("AGE")))
    report = Q.validate(broken)
    failed = [r for r in report.collect() if not r["success"]]
    assert [(r["expectation"], r["column"], r["n_failed_rows"]) for r in failed] == [(Q.EXPECT_BETWEEN, "AGE", 1)]
    with pytest.raises(ValueError, match="Data quality gate FAILED"):
        Q.gate(report)


def test_rule_semantics_nulls_and_missing_column(spark, sample_raw_df):
    # nulls are ignored by between/in-set, caught by not-null; a missing column fails its rule
    df = sample_raw_df.withColumn("SEX", F.lit(None).cast("long")).drop("MARRIAGE")
    rows = {(r["expectation"], r["column"]): r for r in Q.validate(df).collect()}
    assert rows[(Q.EXPECT_IN_SET, "SEX")]["success"]
    assert not rows[(Q.EXPECT_IN_SET, "MARRIAGE")]["success"]
    assert not rows[(Q.EXPECT_COLUMN_COUNT, "")]["success"]


def test_bad_rows_lists_broken_rules(sample_raw_df):
    df = sample_raw_df.withColumn("SEX", F.when(F.col("ID") == 2, F.lit(9)).otherwise(F.col("SEX")))
    bad = Q.bad_rows(df).collect()
    assert len(bad) == 1 and bad[0]["ID"] == 2 and "in_set(SEX)" in bad[0]["failed_rules"]


def test_observed_suite_rides_on_a_write(spark, sample_raw_df, tmp_dir):
    observed, obs = Q.observe_suite(sample_raw_df)
    observed.write.mode("overwrite").parquet(tmp_dir + "/validated")
    rep = Q.report_from_observation(sample_raw_df, obs)
    assert Q.summarize(rep).first()["n_failed"] == 0


def test_cleaning_contract(sample_raw_df):
    c = clean(sample_raw_df)
    assert "ID" not in c.columns and RAW_TARGET not in c.columns and "default" in c.columns
    assert c.columns == CLEAN_COLS
    assert c.count() == 4


def test_undocumented_codes_merged_pay_kept(spark, sample_raw_df):
    df = (sample_raw_df.withColumn("EDUCATION", F.when(F.col("ID") == 1, 5).when(F.col("ID") == 2, 6)
                                   .when(F.col("ID") == 3, 0).otherwise(F.col("EDUCATION")))
          .withColumn("MARRIAGE", F.when(F.col("ID") == 1, 0).otherwise(F.col("MARRIAGE")))
          .withColumn("PAY_0", F.when(F.col("ID") == 1, -2).otherwise(F.col("PAY_0"))))
    c = clean(df)
    assert {r[0] for r in c.select("EDUCATION").collect()} <= {1, 2, 3, 4}
    assert {r[0] for r in c.select("MARRIAGE").collect()} <= {1, 2, 3}
    assert -2 in {r[0] for r in c.select("PAY_0").collect()}


def test_dedup_keeps_first_and_counts(spark, sample_raw_df):
    doubled = sample_raw_df.unionByName(sample_raw_df.withColumn("ID", F.col("ID") + 100))
    cleaned, counts = clean_with_order(doubled)
    assert cleaned.count() == 4
    assert sorted(r["_row_order"] for r in cleaned.collect()) == [1, 2, 3, 4]
    c = counts.first()
    assert (c["n_before"], c["n_after"], c["n_removed"]) == (8, 4, 4)


def test_cast_fails_loudly_on_null(sample_raw_df):
    df = sample_raw_df.withColumn("AGE", F.when(F.col("ID") == 1, F.lit(None)).otherwise(F.col("AGE")))
    with pytest.raises(Exception, match="cannot convert null"):
        clean(df).collect()


def test_features(sample_raw_df):
    cleaned, _ = clean_with_order(sample_raw_df)
    f = engineer_features(cleaned)
    assert f.columns[0] == "customer_id" and f.columns[-1] == "event_time"
    assert len(f.columns) == 36
    for c in DERIVED_COLS:
        assert c in f.columns
    rows = {r["customer_id"]: r for r in f.collect()}
    assert sorted(rows) == [0, 1, 2, 3]  # dense, first-seen order
    r0 = rows[0]  # raw ID 1: bills 3913 x6, payments 0, limit 20000
    assert r0["avg_bill"] == pytest.approx(3913.0)
    assert r0["util_ratio"] == pytest.approx(3913.0 / 20000)
    assert r0["pct_paid"] == 0.0 and r0["bill_trend"] == 0
    r3 = rows[3]  # raw ID 4: all bills 0 -> guarded ratios are 0
    assert r3["pct_paid"] == 0.0 and r3["util_ratio"] == 0.0
    assert all(math.isfinite(r["util_ratio"]) for r in rows.values())
    r2 = rows[2]  # PAY -1 everywhere: no delayed month
    assert r2["n_months_delayed"] == 0 and r2["pay_delay_max"] == -1


def test_zero_limit_ratio_is_zero(spark, sample_raw_df):
    df = sample_raw_df.withColumn("LIMIT_BAL", F.when(F.col("ID") == 1, 0).otherwise(F.col("LIMIT_BAL")))
    cleaned, _ = clean_with_order(df)
    f = engineer_features(cleaned)
    assert f.filter(F.col("LIMIT_BAL") == 0).first()["util_ratio"] == 0.0
