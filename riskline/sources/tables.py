"""Readers for the driver tables and writers for the layered layout."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Layers of the reference layout; data flows down only.
LAYERS = (
    "01_raw", "02_intermediate", "03_primary", "04_feature",
    "05_model_input", "06_models", "07_model_output", "08_reporting",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def layer_path(root: str, layer: str, name: str, fmt: str = "parquet") -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}.{fmt}"


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """Report sink (S4): one JSON object per report row."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink (S5); read it back with ``read_csv(spark, path, df.schema)``."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def raw_schema() -> T.StructType:
    """Explicit schema of the raw credit layer (S1): 25 long columns."""
    from ..params import RAW_COLS

    return T.StructType([T.StructField(c, T.LongType(), True) for c in RAW_COLS])


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw scan re-aimed to CSV with a header row and the explicit raw schema."""
    return spark.read.schema(raw_schema()).option("header", True).csv(path)


def _file_system(spark: SparkSession, path: str):
    """Spark's file system for a path, and the path in its terms."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several writers one succeeds."""
    fs, at = _file_system(spark, path)
    fs.mkdirs(at.getParent())
    try:
        fs.create(at, False).close()
    except Exception as e:  # noqa: BLE001 - only told apart by the Java class
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True
