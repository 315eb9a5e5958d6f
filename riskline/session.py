"""Session helpers: build a local session for tests/bench, resolve the checkpoint folder.

On a cluster the session is given; we only read ``spark.checkpoint.dir`` from it.
A folder of our own is set only when that setting is missing (local tests and bench).
"""
from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskline") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("RISKLINE_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # local runs only: a fresh scratch folder per session
        conf_dir = tempfile.mkdtemp(prefix="riskline-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def ship_package(spark: SparkSession) -> None:
    """Put this package on the workers' path once per application, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_riskline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskline-pkg-"), "riskline-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("riskline", os.path.relpath(path, root)))
    sc.addPyFile(os.path.realpath(archive))
    sc._riskline_shipped = True


def prepare(spark: SparkSession) -> None:
    """What every query needs of its session."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables this library writes (feature groups, run log, registry)."""
    explicit = spark.conf.get("riskline.warehouse", None)
    if explicit:
        return explicit
    ensure_checkpoint_dir(spark)
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or os.path.dirname(spark.sparkContext.getCheckpointDir().rstrip("/")))
    return base.rstrip("/") + "/riskline-tables"
