import datetime

from riskline.plans import stages
from riskline.plans.queries_profile import q_key_checks


def _tables(spark, folder):
    day = datetime.datetime(2001, 5, 1)
    spark.createDataFrame([(i, i % 25, 10.0 * i - 20) for i in range(1, 61)],
                          "c_custkey long, c_nationkey long, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(i, i % 50 + 1, "OPF"[i % 3], 100.0 + i, day) for i in range(200)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"
                          ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i % 200, 10.0 + i, 0.1, day) for i in range(400)],
                          "l_orderkey long, l_extendedprice double, l_discount double, l_shipdate timestamp"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_numbering_starts_from_layers_not_from_the_source_tables(spark, tmp_dir):
    sf = _tables(spark, tmp_dir)
    features = stages.features(spark, sf)
    assert {f.split("/")[-2] for f in features.inputFiles()} == {"cleaned"}
    split = stages.split_table(spark, sf, materialize=False)
    assert {f.split("/")[-2] for f in split.inputFiles()} == {"features"}
    assert split.count() == features.count() == stages.cleaned(spark, sf)[0].count()


def test_key_checks_join_the_source_tables_once(spark, tmp_dir, monkeypatch):
    sf = _tables(spark, tmp_dir)
    calls = []
    real = stages.credit_profile
    monkeypatch.setattr(stages, "credit_profile", lambda *a: calls.append(a) or real(*a))
    rows = {r["check"]: r["n_bad"] for r in q_key_checks(spark, sf).collect()}
    assert rows["splits_cover_all"] == 0 and rows["customer_id_unique"] == 0
    assert len(calls) == 1


def test_layers_get_shuffle_partitions_by_the_rows_of_the_source(spark, tmp_dir, monkeypatch):
    sf = _tables(spark, tmp_dir)
    key = "spark.sql.shuffle.partitions"
    given = spark.conf.get(key)
    monkeypatch.setattr(stages, "PARTITION_ROWS", 10, raising=False)  # 400 rows of lineitem
    seen = []
    real = stages.engineer_features
    monkeypatch.setattr(stages, "engineer_features", lambda *a: seen.append(spark.conf.get(key)) or real(*a))
    rows = stages.feature_table(spark, sf).sort("customer_id").collect()
    assert seen == ["40"] and spark.conf.get(key) == given
    monkeypatch.setattr(stages, "PARTITION_ROWS", 1_000, raising=False)
    assert stages.features(spark, sf).sort("customer_id").collect() == rows
    assert seen == ["40", given]


def test_a_failed_layer_leaves_the_setting_as_it_was(spark, tmp_dir, monkeypatch):
    sf = _tables(spark, tmp_dir)
    key = "spark.sql.shuffle.partitions"
    given = spark.conf.get(key)
    monkeypatch.setattr(stages, "PARTITION_ROWS", 10, raising=False)

    def build():
        assert spark.conf.get(key) == "40"
        raise RuntimeError("stop")

    try:
        stages.layer(spark, sf, "none", build)
    except RuntimeError:
        pass
    assert spark.conf.get(key) == given
