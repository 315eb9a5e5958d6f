"""Windowed drift over the event stream table (T2 in batch form) and wide PCA drift."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqlexpr import bin_index_sql
from ..operators import drift as D
from ..params import DEFAULTS
from ..sources.tables import read_table

P = DEFAULTS.drift
# fixed values of the event-stream drift job: frozen first week, then daily windows
REFERENCE_END = "2024-01-08 00:00:00"
WINDOW = "1 day"


def events_long(spark: SparkSession, sf: str):
    ev = read_table(spark, sf, "events").select("ts", F.col("event_type").alias("feature"), F.col("value").cast("double"))
    cut = F.lit(REFERENCE_END).cast("timestamp_ntz")
    ref = ev.filter(F.col("ts") < cut).select("feature", "value")
    cur = ev.filter(F.col("ts") >= cut).select(F.window("ts", WINDOW).start.alias("window_start"), "feature", "value")
    return ref, cur


def q_events_window_psi(spark: SparkSession, sf: str) -> DataFrame:
    """Per day and event type: PSI of the value against the frozen first-week reference."""
    ref, cur = events_long(spark, sf)
    edges, ref_bins = D.frozen_reference(ref, P)
    return D.window_psi(D.window_bin_counts(cur, edges, P.buckets), ref_bins, P).withColumnRenamed("feature", "event_type")


def q_pca_recon_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """D6 at the embeddings' width: current batch = each label's rows, reference = all of them.
    One scan gives the moments per label; the reference's are their merge."""
    emb = read_table(spark, sf, "embeddings")
    width = emb.agg(F.max(F.size("embedding"))).first()[0] or 0  # taken from the data, so no dimension is lost
    dims = [f"e{i:02d}" for i in range(width)]
    wide = emb.select(F.concat(F.lit("label_"), F.col("label").cast("string")).alias("g"),
                      *[F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(dims)])
    groups = D.grouped_moments(wide, dims, "g")
    names = sorted(groups, key=lambda g: int(g.removeprefix("label_")))
    return D.pca_table(spark, D.merged_group(groups), groups, names, P)


def oracles() -> dict[str, str]:
    nb = P.buckets
    return {
        "events_window_psi": f"""WITH _ev AS (SELECT ts, event_type AS feature, CAST(value AS DOUBLE) AS value FROM events),
_ref AS (SELECT feature, value FROM _ev WHERE ts < TIMESTAMP '{REFERENCE_END}'),
_cur AS (SELECT date_trunc('day', ts) AS window_start, feature, value FROM _ev WHERE ts >= TIMESTAMP '{REFERENCE_END}'),
_edges AS (SELECT feature, min(value) AS lo, (max(value) - min(value)) / {float(nb)!r} AS step, count(*) AS n_ref FROM _ref GROUP BY feature),
_rc AS (SELECT r.feature, {bin_index_sql('r.value', 'e.lo', 'e.step', nb)} AS bin, count(*) AS c FROM _ref r JOIN _edges e USING (feature) GROUP BY ALL),
_rb AS (SELECT e.feature, CAST(g.bin AS INTEGER) AS bin,
               CASE WHEN coalesce(rc.c, 0) = 0 THEN {P.epsilon!r} ELSE CAST(rc.c AS DOUBLE) / CAST(e.n_ref AS DOUBLE) END AS e
        FROM _edges e CROSS JOIN range(0, {nb}) g(bin) LEFT JOIN _rc rc ON rc.feature = e.feature AND rc.bin = g.bin),
_cc AS (SELECT c.window_start, c.feature, {bin_index_sql('c.value', 'e.lo', 'e.step', nb)} AS bin, count(*) AS c
        FROM _cur c JOIN _edges e USING (feature) GROUP BY ALL),
_tot AS (SELECT window_start, feature, sum(c) AS n FROM _cc GROUP BY ALL),
_g AS (SELECT t.window_start, t.feature, t.n, rb.bin, rb.e,
              CASE WHEN coalesce(cc.c, 0) = 0 THEN {P.epsilon!r} ELSE CAST(cc.c AS DOUBLE) / CAST(t.n AS DOUBLE) END AS a
       FROM _tot t JOIN _rb rb ON rb.feature = t.feature
       LEFT JOIN _cc cc ON cc.window_start = t.window_start AND cc.feature = t.feature AND cc.bin = rb.bin)
SELECT window_start, feature AS event_type, CAST(n AS BIGINT) AS n, round(sum((a - e) * ln(a / e)), 6) AS psi,
       sum((a - e) * ln(a / e)) >= {P.psi_threshold!r} AS drift
FROM _g GROUP BY window_start, feature, n""",
    }


QUERIES = {
    "events_window_psi": q_events_window_psi,
    "pca_recon_embeddings": q_pca_recon_embeddings,
}
