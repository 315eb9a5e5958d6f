import numpy as np
import pytest
from pyspark.sql import functions as F

from riskline.operators.ordering import dense_index, running_sums
from riskline.operators.split import (
    exact_quantiles, feature_matrix, largest_remainder, seeded_sample, stratified_split)
from riskline.params import SplitParams


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_dense_index_matches_brute_force(spark, parts):
    rng = np.random.default_rng(0)
    keys = rng.permutation(500).tolist()
    grp = [k % 3 for k in keys]
    df = spark.createDataFrame(list(zip(keys, grp)), "k long, g long")
    got = {r["k"]: r["ix"] for r in dense_index(df, ["k"], "ix", ["g"], num_partitions=parts).collect()}
    for g in range(3):
        ks = sorted(k for k in keys if k % 3 == g)
        assert [got[k] for k in ks] == list(range(len(ks)))


@pytest.mark.parametrize("parts", [1, 5])
def test_running_sums_match_cumsum(spark, parts):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 10, 300).tolist()
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(vals)], "o long, v long, g long")
    out = {r["o"]: r["v_cum"] for r in running_sums(df, ["o"], ["v"], ["g"], num_partitions=parts).collect()}
    for g in range(2):
        idx = [i for i in range(300) if i % 2 == g]
        assert [out[i] for i in idx] == np.cumsum([vals[i] for i in idx]).tolist()


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("ranges", [None, 3, 40])
def test_running_sums_with_null_groups_and_hot_group(spark, ranges):
    rng = np.random.default_rng(3)
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 40}", float(rng.integers(0, 900)), i, int(rng.integers(0, 9)))
            for i in range(3000)]
    rows += [(None, None, 5000, 4), ("hot", None, 5001, 5), ("hot", float("inf"), 5002, 6)]
    df = spark.createDataFrame(rows, "g string, x double, i long, v long").repartition(7)
    out = running_sums(df, ["x", "i"], ["v"], ["g"], num_partitions=ranges)
    assert out.columns == ["g", "x", "i", "v", "v_cum"]
    got = {r["i"]: r["v_cum"] for r in out.collect()}
    want, total = {}, {}
    for g, x, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[2])):
        want[i] = total[g] = total.get(g, 0) + v
    assert got == want
    indexed = {r["i"]: r["at"] for r in dense_index(df, ["x", "i"], "at", ["g"], ranges).collect()}
    seen = {}
    for g, x, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[2])):
        assert indexed[i] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1


@pytest.mark.parametrize("order", ["s", "d", "t", "n", "f"])
def test_ranges_over_other_types(spark, order):
    df = spark.range(500).selectExpr(
        "id", "md5(cast(id as string)) s", "date_add(date'2020-01-01', cast(id * 7 % 501 as int)) d",
        "timestamp_micros(id * 7919 % 503) t", "cast(id * 13 % 509 as decimal(20, 3)) n", "cast(id * 17 % 521 as double) / 7 f")
    rows = sorted(df.collect(), key=lambda r: (r[order], r["id"]))
    got = {r["id"]: r["at"] for r in dense_index(df, [order, "id"], "at", num_partitions=9).collect()}
    assert [got[r["id"]] for r in rows] == list(range(500))
    assert running_sums(df.limit(0), [order], ["id"], num_partitions=9).count() == 0


def test_running_sums_exchange_the_rows_once(spark):
    """One exchange of rows and a broadcast of range totals; no checkpoint."""
    before = {r.id() for r in spark.sparkContext._jsc.getPersistentRDDs().values()}
    df = spark.range(2000).selectExpr("id % 3 g", "id x", "id % 5 v")
    whole = _plan(running_sums(df, ["x"], ["v"], ["g"]))
    assert whole.count("Exchange hashpartitioning") == 1 and "ExistingRDD" not in whole
    cut = _plan(running_sums(df, ["x"], ["v"], ["g"], num_partitions=50))
    rows, totals = cut.split("BroadcastExchange")[0], cut
    assert rows.count("Exchange hashpartitioning(g") == 1
    assert "Scan ExistingRDD" not in rows and "_range" in totals
    assert {r.id() for r in spark.sparkContext._jsc.getPersistentRDDs().values()} == before


def _synthetic(spark, n, rate=0.22, seed=0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < rate).astype(int)
    rows = [(i, float(rng.normal()), float(rng.normal()), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, f1 double, f2 double, default int")


def test_split_sizes_disjoint_and_stratified(spark):
    df = _synthetic(spark, 1000)
    s = stratified_split(df, SplitParams()).cache()
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 700, "val": 100, "test": 200}
    assert s.select("customer_id").distinct().count() == 1000
    overall = df.agg(F.avg("default")).first()[0]
    for r in s.groupBy("split").agg(F.avg("default").alias("rate")).collect():
        assert abs(r["rate"] - overall) < 0.03
    again = {r["customer_id"]: r["split"] for r in stratified_split(df, SplitParams()).collect()}
    assert again == {r["customer_id"]: r["split"] for r in s.collect()}  # reproducible


def test_split_unshuffled_and_unstratified(spark):
    df = _synthetic(spark, 500)
    s = stratified_split(df, SplitParams(stratify=False, shuffle=False))
    test_ids = sorted(r[0] for r in s.filter("split = 'test'").select("customer_id").collect())
    assert test_ids == list(range(400, 500))  # the last rows are held out
    with pytest.raises(ValueError):
        stratified_split(df, SplitParams(stratify=True, shuffle=False))


def test_largest_remainder_sums():
    out = largest_remainder({0: 781, 1: 219}, 0.2)
    assert sum(out.values()) == 200 and out == {0: 156, 1: 44}


def test_feature_matrix_drops_target_and_ids(spark):
    df = _synthetic(spark, 10).withColumn("event_time", F.current_timestamp())
    assert feature_matrix(df).columns == ["f1", "f2"]
    with pytest.raises(KeyError):
        feature_matrix(df.drop("default"))


def test_seeded_sample_exact_and_reproducible(spark):
    df = _synthetic(spark, 300)
    a = [r[0] for r in seeded_sample(df, 50).select("customer_id").collect()]
    b = [r[0] for r in seeded_sample(df, 50).select("customer_id").collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)
    assert seeded_sample(df, 1000).count() == 300


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(18, 80, 777).astype(float)
    df = spark.createDataFrame([(float(v),) for v in x], "AGE double")
    got = exact_quantiles(df, "AGE", [0.0, 0.5, 0.85, 0.95, 1.0])
    want = np.quantile(x, [0.0, 0.5, 0.85, 0.95, 1.0])
    assert got == pytest.approx(want.tolist())


def test_seeded_sample_is_a_filter(spark, monkeypatch):
    import hashlib

    from riskline.operators import split

    df = spark.range(3000).withColumnRenamed("id", "customer_id").repartition(6)
    want = sorted(range(3000), key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
    for size, rows in ((1, 4096), (700, 4096), (700, 1), (2999, 3), (3000, 10), (9000, 10)):
        monkeypatch.setattr(split, "CUT_ROWS", rows)
        monkeypatch.setattr(split, "CUT_DIGITS", 1)
        sample = seeded_sample(df, size)
        assert sorted(r[0] for r in sample.collect()) == sorted(want[:size])
        assert "TakeOrderedAndProject" not in _plan(sample) and "Limit" not in _plan(sample)
    assert seeded_sample(df, 0).count() == 0


def test_layers_are_read_by_partition_and_column(spark):
    from riskline.plans import queries_drift, queries_model, queries_profile, stages

    sf = "/root/testdata/sf0.001"
    corr = _plan(queries_profile.q_target_corr(spark, sf))
    assert "FileScan parquet" in corr and "PAY_AMT1" not in corr  # only the derived columns
    val = _plan(stages.split_table(spark, sf).filter("split = 'val'").select("customer_id"))
    assert "PartitionFilters: [isnotnull(split" in val
    scored = _plan(queries_model.scored(spark, sf, "val"))
    assert "FileScan parquet" in scored and "= val)" in scored.split("PartitionFilters")[1][:80]
    stages.reference_counts(spark, sf)
    bins = _plan(queries_drift.q_psi_bins(spark, sf))
    assert "ReadSchema: struct<feature:string,value:double,c:bigint>" in bins and "= train" not in bins  # the stored baseline stands for the training rows
