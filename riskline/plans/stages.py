"""Stage chain over the driver tables: raw -> cleaned -> features -> split -> baseline.

Up to the cleaned rows each function returns a lazy plan. The cleaned rows, the features, the split
and the baseline are parquet layers in the shared folder, written once per application by whoever
reads them first. Numbering rows looks at them several times (sizes, cuts, totals), so it starts
from a layer: else each look would join and group the source tables again.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_with_order
from ..operators.features import engineer_features
from ..params import DEFAULTS, Params
from ..sources.credit import credit_profile, with_duplicates


def raw_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_duplicates(credit_profile(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    return clean_with_order(raw_with_duplicates(spark, sf_dir), params.cleaning)


def features(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> DataFrame:
    c = layer(spark, sf_dir, "cleaned", lambda: cleaned(spark, sf_dir, params)[0], (), params)
    return engineer_features(c, params.features)


def feature_table(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> DataFrame:
    """The features as a layer, for who reads them more than once."""
    return layer(spark, sf_dir, "features", lambda: features(spark, sf_dir, params), (), params)


_LAYERS: dict = {}


def layer_folder(spark: SparkSession, sf_dir: str, name: str, params: Params = DEFAULTS) -> str:
    """Where this application keeps a layer built from ``sf_dir``, in the shared folder."""
    from hashlib import md5

    from ..session import scratch_root

    of = md5(f"{sf_dir}|{params}".encode()).hexdigest()[:16]
    return f"{scratch_root(spark)}/layers/{spark.sparkContext.applicationId}/{of}/{name}"


#: Rows of lineitem, the largest source, for each shuffle partition.
PARTITION_ROWS = 500_000


@contextmanager
def partitions_for(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """Within, shuffles have at least a partition for each ``PARTITION_ROWS`` rows of lineitem: with a
    fixed number of them, the rows that one task sorts and groups would grow with the tables. Where
    partitions are small, Spark joins them again."""
    from ..sources.tables import read_table

    rows = f"{sf_dir}|lineitem rows|{spark.sparkContext.applicationId}"
    if rows not in _LAYERS:
        _LAYERS[rows] = read_table(spark, sf_dir, "lineitem").count()
    key = "spark.sql.shuffle.partitions"
    given = spark.conf.get(key)
    spark.conf.set(key, max(int(given), -(-_LAYERS[rows] // PARTITION_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(key, given)


def layer(spark: SparkSession, sf_dir: str, name: str, build, partition_by: tuple = (), params: Params = DEFAULTS) -> DataFrame:
    """A parquet layer: built and written by the first caller, read by all. Readers get column
    pruning and, on ``partition_by``, partition pruning; lost executors cost them nothing."""
    from ..sources.tables import exists

    folder = layer_folder(spark, sf_dir, name, params)
    if folder not in _LAYERS or not exists(spark, f"{folder}/_SUCCESS"):
        with partitions_for(spark, sf_dir):
            made = build()
            made.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        _LAYERS[folder] = made.select(*[c for c in made.columns if c not in partition_by], *partition_by).schema
    return spark.read.schema(_LAYERS[folder]).parquet(folder)


def split_table(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS, materialize: bool = True) -> DataFrame:
    """Features + ``split`` (the model-input layer), parquet partitioned by ``split``."""
    from ..operators.split import stratified_split

    def build() -> DataFrame:
        return stratified_split(feature_table(spark, sf_dir, params), params.split)

    return layer(spark, sf_dir, "split", build, ("split",), params) if materialize else build()


def bias_threshold(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> float | None:
    """The exact quantile from which on a test row belongs to the drifted batch."""
    from ..operators.split import exact_quantiles

    key = (layer_folder(spark, sf_dir, "bias", params),)
    if key not in _LAYERS:
        s = split_table(spark, sf_dir, params)
        (_LAYERS[key],) = exact_quantiles(s.filter(s.split == "test"), params.drift.bias_column, [params.drift.bias_quantile])
    return _LAYERS[key]


def drift_inputs(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS):
    """(reference rows, test rows, clean batch, drifted batch) of the credit features, all whole:
    the clean batch is the test split, the drifted one its rows at or above the bias threshold."""
    from pyspark.sql import functions as F

    s = split_table(spark, sf_dir, params)
    test = s.filter(s.split == "test")
    drifted = test.filter(F.col(params.drift.bias_column) >= F.lit(bias_threshold(spark, sf_dir, params)))
    return s.filter(s.split == "train"), test, test, drifted


def drift_batches(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> DataFrame:
    """The test rows with a column ``batch``, once for each batch they belong to; one scan."""
    from ..operators.split import whole_batches

    s = split_table(spark, sf_dir, params)
    return whole_batches(s.filter(s.split == "test"), bias_threshold(spark, sf_dir, params), params.drift)


def reference_counts(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> DataFrame:
    """The stored baseline, as mergeable rows (feature, value, c) of the training split.
    Drift runs read it instead of the training rows."""
    from ..operators.drift import value_counts_long
    from ..params import FEATURE_COLS

    def build() -> DataFrame:
        s = split_table(spark, sf_dir, params)
        return value_counts_long(s.filter(s.split == "train"), FEATURE_COLS)

    return layer(spark, sf_dir, "baseline_counts", build, (), params)


def reference_moments(spark: SparkSession, sf_dir: str, params: Params = DEFAULTS) -> DataFrame:
    """The stored baseline's moments, one mergeable row (g, n, mean, m2) of the training split."""
    from ..operators.drift import moment_rows
    from ..params import FEATURE_COLS

    def build() -> DataFrame:
        s = split_table(spark, sf_dir, params)
        return moment_rows(s.filter(s.split == "train"), FEATURE_COLS)

    return layer(spark, sf_dir, "baseline_moments", build, (), params)
