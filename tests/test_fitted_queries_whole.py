from pyspark.sql import functions as F

from riskline.operators import treeshap
from riskline.params import DEFAULTS, FEATURE_COLS
from riskline.plans import queries_fit as QF


def test_queries_fit_the_configured_trials(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(QF, "_LAYERS", {})
    monkeypatch.setattr(QF, "split_table", lambda *a: None)
    monkeypatch.setattr(QF.MD, "train_and_tune", lambda split, params, **k: seen.append(params) or ({}, {}, {}))
    QF.fitted(spark, "x")
    assert seen == [DEFAULTS.train] and DEFAULTS.train.trials == 15


def test_global_tree_attribution_takes_all_training_rows(spark, monkeypatch):
    rows = spark.range(1500).select(F.col("id").alias("customer_id"), F.lit("train").alias("split"),
                                    *[F.lit(1.0).alias(c) for c in FEATURE_COLS])
    seen = []

    def attribution(spark, model, df, features, scratch):
        seen.append(df.count())
        return df.select("customer_id", *features)

    monkeypatch.setattr(QF, "fitted", lambda *a: ({"RandomForest": None}, {"RandomForest": {"roc_auc": 1.0}}, {}))
    monkeypatch.setattr(QF, "split_table", lambda *a: rows)
    monkeypatch.setattr(treeshap, "tree_attribution", attribution)
    assert QF.q_global_tree_attribution(spark, "x").count() == len(FEATURE_COLS)
    assert seen == [1500]
