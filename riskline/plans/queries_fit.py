"""Queries over fitted models (rows-only checks: fitted numbers have no SQL form).

Fitting is the costly part: the configured ``TrainParams.trials`` of every family. The winners are
published once to the shared layer, found again by a digest of the training rows and parameters,
with one run-log entry and one registered version; the queries only read what was published.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as MD
from ..params import DEFAULTS
from ..session import scratch_root
from .stages import _LAYERS, split_table


def _root(spark, sf):
    return f"{scratch_root(spark)}/models/{os.path.basename(sf.rstrip('/'))}"


def fitted(spark: SparkSession, sf: str) -> tuple[dict, dict, dict]:
    """(models, metrics, best hyper-parameters) by family, from the published layer."""
    key = ("fitted", spark.sparkContext.applicationId, sf)
    if key not in _LAYERS:
        _LAYERS[key] = MD.train_and_tune(split_table(spark, sf), DEFAULTS.train, publish=_root(spark, sf) + "/winners")
    return _LAYERS[key]


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    _, metrics, _ = fitted(spark, sf)
    return MD.rank_families(MD.metrics_frame(spark, metrics), DEFAULTS.selection, list(DEFAULTS.train.candidate_models))


def _champion_family(spark: SparkSession, sf: str) -> str:
    return MD.champion(_ranked(spark, sf), DEFAULTS.selection).first()["champion_family"]


def _registered(spark: SparkSession, sf: str) -> DataFrame:
    """The registry's current aliases; the champion is logged and registered the first time only."""
    models, metrics, best = fitted(spark, sf)
    root = _root(spark, sf)
    name = DEFAULTS.selection.registered_model_name
    current = MD.current_aliases(spark, root + "/registry")
    if current.where(F.col("model_name") == name).first() is None:
        MD.log_runs(spark, root + "/runs", metrics, best, DEFAULTS.train.trials)
        MD.register(spark, root + "/registry", models[_champion_family(spark, sf)], root + "/store", name, DEFAULTS.predict.champion_alias)
        current = MD.current_aliases(spark, root + "/registry")
    return current


def q_model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Validation metrics per family, ranked by ROC-AUC."""
    return _ranked(spark, sf).select("family", *[F.round(c, 4).alias(c) for c in MD.METRICS], "rank")


def q_champion(spark: SparkSession, sf: str) -> DataFrame:
    """The champion and the ranking."""
    return MD.champion(_ranked(spark, sf), DEFAULTS.selection)


def q_registry_current(spark: SparkSession, sf: str) -> DataFrame:
    """The version that the champion's alias points at."""
    return _registered(spark, sf).select("model_name", "alias", "version").withColumn(
        "champion_family", F.lit(_champion_family(spark, sf)))


def q_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Top-15 impurity importances of each fitted tree family."""
    models, _, _ = fitted(spark, sf)
    rows = [(fam, i + 1, f, float(round(v, 6))) for fam, m in models.items()
            for i, (f, v) in enumerate(MD.feature_importances(m))]
    return spark.createDataFrame(rows, "family string, rank int, feature string, importance double")


def q_champion_scores(spark: SparkSession, sf: str) -> DataFrame:
    """B1/B2 with the fitted champion on the test split."""
    models, _, _ = fitted(spark, sf)
    test = split_table(spark, sf).filter(F.col("split") == "test")
    p = MD.positive_proba(models[_champion_family(spark, sf)], test)
    return p.select("customer_id", F.round("proba", 6).alias("default_proba"),
                    (F.col("proba") >= F.lit(DEFAULTS.predict.prediction_threshold)).cast("int").alias("prediction"))


def _tree_family(metrics: dict) -> str:
    """The champion when it is a tree ensemble, else the best tree family."""
    order = sorted(metrics, key=lambda f: -metrics[f][DEFAULTS.selection.primary_metric])
    return next(f for f in order if f != "LogisticRegression")


def q_tree_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """H2 (trees): TreeSHAP for every test row, one column per feature, plus base/output."""
    from ..operators.treeshap import tree_attribution
    from ..params import FEATURE_COLS

    models, metrics, _ = fitted(spark, sf)
    fam = _tree_family(metrics)
    test = split_table(spark, sf).filter(F.col("split") == "test")
    a = tree_attribution(spark, models[fam], test, FEATURE_COLS, _root(spark, sf) + "/treeshap")
    return a.select("customer_id", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in FEATURE_COLS],
                    F.round("base_value", 6).alias("base_value"), F.round("model_output", 6).alias("model_output"),
                    F.lit(fam).alias("family"))


def q_global_tree_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """H1: mean |TreeSHAP| per feature over all training rows."""
    from ..operators.scoring import global_attribution
    from ..operators.treeshap import tree_attribution
    from ..params import FEATURE_COLS

    models, metrics, _ = fitted(spark, sf)
    fam = _tree_family(metrics)
    train = split_table(spark, sf).filter(F.col("split") == "train")
    a = tree_attribution(spark, models[fam], train, FEATURE_COLS, _root(spark, sf) + "/treeshap")
    return global_attribution(a, FEATURE_COLS).withColumn("family", F.lit(fam))


QUERIES = {
    "tree_attribution": q_tree_attribution,
    "global_tree_attribution": q_global_tree_attribution,
    "model_comparison": q_model_comparison,
    "champion": q_champion,
    "registry_current": q_registry_current,
    "feature_importance": q_feature_importance,
    "champion_scores": q_champion_scores,
}


def oracles() -> dict[str, str]:
    return {}
