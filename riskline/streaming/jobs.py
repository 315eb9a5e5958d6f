"""Structured Streaming jobs.

Each job takes a streaming DataFrame and sink locations and returns the started
``StreamingQuery``. Sinks are files under caller-given folders; checkpoints go to the
caller-given checkpoint location (on a cluster: under the shared checkpoint folder).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import drift as D
from ..operators import quality as Q
from ..params import DriftParams, QualityParams


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Commit a micro-batch's rows as ``path/batch_id=<n>``: a batch that runs again, after a failure
    between its writes and its commit, replaces its own folder and leaves the same rows."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def quality_gate_stream(stream: DataFrame, report_path: str, bad_rows_path: str, checkpoint: str,
                        params: QualityParams = QualityParams(), trigger: dict | None = None,
                        good_rows_path: str | None = None, halt: bool = False) -> StreamingQuery:
    """Run the suite on every micro-batch (one aggregate pass), keep its report, divert the rows
    breaking any rule to a side table and let the others through to ``good_rows_path``.

    halt: a batch that fails the gate stops the query with ``QualityGateError`` after its report and
    bad rows are written and before any of its rows are let through; a restarted query meets the
    same batch again. Rows without a verdict on themselves (table rules) never divert a row."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            report = Q.validate(batch, params)
            write_batch(report, report_path, batch_id)
            write_batch(Q.bad_rows(batch, params), bad_rows_path, batch_id)
            if halt:
                Q.gate(report.sparkSession.read.schema(report.schema).parquet(f"{report_path.rstrip('/')}/batch_id={batch_id}"))
            if good_rows_path:
                write_batch(Q.good_rows(batch, params), good_rows_path, batch_id)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def windowed_drift_stream(stream: DataFrame, edges: DataFrame, ref_bins: DataFrame, out_path: str, checkpoint: str,
                          ts_col: str = "ts", feature_col: str = "event_type", value_col: str = "value",
                          window: str = "1 day", watermark: str = "1 day", params: DriftParams = DriftParams(),
                          trigger: dict | None = None) -> StreamingQuery:
    """Tumbling windows with a watermark; per (window, feature, bin) counts against the
    frozen reference edges (stream-static broadcast join). In append mode a window's counts
    are emitted once, complete, after the watermark passes its end; each micro-batch then
    turns the closed windows into PSI rows."""
    from pyspark.sql.types import TimestampNTZType

    # watermarks need TIMESTAMP; wall-clock (NTZ) inputs are read in the session time zone
    ntz = isinstance(stream.schema[ts_col].dataType, TimestampNTZType)
    et = stream.withColumn("_et", F.col(ts_col).cast("timestamp") if ntz else F.col(ts_col))
    cur = (et.withWatermark("_et", watermark)
           .select(F.window("_et", window).alias("w"), F.col(feature_col).alias("feature"),
                   F.col(value_col).cast("double").alias("value")))
    binned = cur.join(F.broadcast(edges.select("feature", "lo", "step")), "feature").select(
        "w", "feature", D.bin_index("value", "lo", "step", params.buckets).alias("bin"))
    counts = binned.groupBy("w", "feature", "bin").agg(F.count(F.lit(1)).alias("c"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        start = F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start")
        closed = batch.select(start.alias("window_start"), "feature", "bin", "c")
        write_batch(D.window_psi(closed, ref_bins, params), out_path, batch_id)

    w = counts.writeStream.outputMode("append").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def scoring_stream(stream: DataFrame, score_fn, out_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Request stream -> aligned features -> score -> file sink (append).
    ``score_fn`` maps the streaming frame to the scored frame (e.g. a fitted pipeline's
    ``transform`` or the fixed scorer); it must be row-wise (no aggregation)."""
    scored = score_fn(stream)
    w = scored.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
