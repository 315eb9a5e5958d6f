"""Feature groups as bucketed, versioned tables.

Layout: ``<root>/feature_group=<name>/version=<n>/part=<p>/`` with the rows of a primary key in one
part (a hash of the key) and, within a part, files by bucket of (primary key, event time). The
buckets are the same in all groups of a version, so the view joins them bucket by bucket without an
exchange. The parts are what an upsert rewrites: only those that a key of the new rows falls into.

A group's layout (columns, parts, buckets) is fixed when the version is first written, in one row
beside it; a session that doesn't know the table yet takes it from there.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..params import FeatureParams
from .tables import exists

PART = "part"
#: Rows that a part should hold; the number of parts is fixed with the version.
PART_ROWS = 20_000_000
MAX_PARTS = 4_096
LAYOUT = "ddl string, parts int, buckets int, key string, event_time string"


def group_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/feature_group={name}/version={version}"


def _layout_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/_layouts/{name}/version={version}"


def _table(root: str, name: str, version: int) -> str:
    return f"fg_{name}_v{version}_{hashlib.md5(root.rstrip('/').encode()).hexdigest()[:12]}"


def _part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(parts)).cast("int").alias(PART)


def project_group(features: DataFrame, columns: tuple, params: FeatureParams = FeatureParams()) -> DataFrame:
    """P10: primary key + event time + the group's columns."""
    return features.select(params.primary_key, params.event_time, *[F.col(f"`{c}`") for c in columns])


def _opened(spark: SparkSession, root: str, name: str, version: int):
    """The group's layout row, its table known to this session; None if the version was never written."""
    where = _layout_path(root, name, version)
    if not exists(spark, f"{where}/_SUCCESS"):
        return None
    layout = spark.read.schema(LAYOUT).parquet(where).first()
    table = _table(root, name, version)
    if not spark.catalog.tableExists(table):
        by = f"`{layout['key']}`, `{layout['event_time']}`"
        spark.sql(f"CREATE TABLE {table} ({layout['ddl']}, `{PART}` int) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (`{PART}`) "
                  f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {layout['buckets']} BUCKETS LOCATION '{group_path(root, name, version)}'")
        if exists(spark, group_path(root, name, version)):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return layout


def _write(spark: SparkSession, rows: DataFrame, root: str, name: str, version: int, layout) -> None:
    """Replace the parts that the rows fall into."""
    keys = [layout["key"], layout["event_time"]]
    table = _table(root, name, version)
    columns = [c for c in spark.table(table).columns if c != PART]
    placed = rows.select(*[F.col(f"`{c}`") for c in columns], _part_of(layout["key"], layout["parts"]))
    # a task holds one bucket of one part, so each has one file
    dealt = placed.repartition(layout["buckets"], *keys).sortWithinPartitions(PART, *keys)
    dealt.write.insertInto(table, overwrite=True)


def write_groups(features: DataFrame, root: str, params: FeatureParams = FeatureParams(),
                 num_partitions: int | None = None, parts: int | None = None) -> list[tuple[str, int]]:
    """Write every group under its version; returns ``(name, rows of the version)``.

    A version that is there already gets the rows by primary key: a row replaces the key's row
    unless that has a later event time, other keys stay. ``num_partitions`` (buckets) and
    ``parts`` hold for versions written first here."""
    spark = features.sparkSession
    out = []
    for name, cols in params.feature_groups:
        version = params.feature_group_version
        g = project_group(features, cols, params)
        layout = _opened(spark, root, name, version)
        if layout is None:
            buckets = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
            n = parts or max(1, min(MAX_PARTS, -(-g.count() // PART_ROWS)))
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in g.schema.fields)
            spark.createDataFrame([(ddl, n, buckets, params.primary_key, params.event_time)], LAYOUT).coalesce(1) \
                .write.mode("overwrite").parquet(_layout_path(root, name, version))
            layout = _opened(spark, root, name, version)
            _write(spark, g, root, name, version, layout)
        else:
            upsert_group(spark, root, name, version, g)
        out.append((name, int(read_group(spark, root, name, version).count())))
    return out


def upsert_group(spark: SparkSession, root: str, name: str, version: int, incoming: DataFrame) -> list[int]:
    """Insert or update rows by primary key; returns the parts that were rewritten.

    The new state of those parts is written aside first: a table can't be overwritten while it is
    read, and a lost executor must not find half of it replaced."""
    layout = _opened(spark, root, name, version)
    key, event_time = layout["key"], layout["event_time"]
    parts = layout["parts"]
    touched = [r[PART] for r in incoming.select(_part_of(key, parts)).distinct().collect()]  # at most the number of parts
    if not touched:
        return []
    table = spark.table(_table(root, name, version))
    columns = [c for c in table.columns if c != PART]
    old = table.where(F.col(PART).isin(touched)).select(*[F.col(f"`{c}`") for c in columns])
    new = upsert(old, incoming.select(*[F.col(f"`{c}`") for c in columns]), key, event_time)
    aside = f"{root.rstrip('/')}/_aside/{name}/version={version}"
    new.write.mode("overwrite").parquet(aside)
    _write(spark, spark.read.schema(new.schema).parquet(aside), root, name, version, layout)
    return sorted(touched)


def read_group(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """Read one group/version back."""
    if _opened(spark, root, name, version) is None:
        raise ValueError(f"feature group {name!r} has no version {version}")
    return spark.table(_table(root, name, version)).drop(PART)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, event_time: str) -> DataFrame:
    """Insert-or-update by key: keep the latest event time per key (incoming wins ties)."""
    both = existing.withColumn("_src", F.lit(0)).unionByName(incoming.withColumn("_src", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc(event_time), F.desc("_src"))
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")


def feature_view(spark: SparkSession, root: str, params: FeatureParams = FeatureParams()) -> DataFrame:
    """All groups joined on (primary key, event time), bucket by bucket."""
    keys = [params.primary_key, params.event_time]
    view = None
    for name, _ in params.feature_groups:
        g = read_group(spark, root, name, params.feature_group_version)
        view = g if view is None else view.join(g.hint("merge"), keys, "inner")
    return view


STATUS = "connected boolean, feature_groups_written string, rows_written long, read_back_rows long, note string"


def sync_status(spark: SparkSession, features: DataFrame, root: str, params: FeatureParams = FeatureParams(),
                read_back: str = "credit_demographic") -> DataFrame:
    """One status row - connected, groups written, rows written, rows read back, note.
    Side-output semantics: an error becomes the note instead of failing the run."""
    from ..functions.rowwise import clean_text

    try:
        written = write_groups(features, root, params)
        back = read_group(spark, root, read_back, params.feature_group_version).count()
        rows = max((r for _, r in written), default=0)
        row = (True, ",".join(n for n, _ in written), int(rows), int(back), f"All {len(written)} groups are stored and readable.")
    except Exception as exc:  # noqa: BLE001 - a side output never fails the run
        row = (False, "", 0, 0, f"The groups could not be stored: {type(exc).__name__}, {exc}")
    df = spark.createDataFrame([row], STATUS)
    return df.withColumn("note", clean_text(F.col("note")))
