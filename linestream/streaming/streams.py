"""Streaming forms of the operators (STR-1..7).

* Row-level transforms (parse, document, geotag) are the same column code
  as in batch; the fence side of the geotag join is static and broadcast
  after its size check (stream-static join, stateless, no watermark).
* Bursts use ``session_window`` keyed by topic (a real column: Spark refuses
  a session window without one), append mode, watermark on the arrival
  time. A burst is emitted once its end (last arrival + gap) is at or below
  the watermark, as the original only reports a burst after the idle gap.
* Batch statistics use a tumbling ``window`` of the batch interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bursts as B
from ..operators import parse as P
from ..operators import registry as R
from ..operators.geotag import geotag
from ..sinks import writers as W


def arrival(df: DataFrame, delay: str, ms: str = "ms") -> DataFrame:
    """Event time = arrival time (STR-1), with a watermark ``delay`` behind the
    latest arrival: rows later than that are dropped (and reported)."""
    return df.withColumn("arrival", F.timestamp_millis(F.col(ms))).withWatermark("arrival", delay)


def stream_documents(lines: DataFrame) -> DataFrame:
    """STR-6: parse + document, per record."""
    typed = P.simfile_typed(lines)
    return typed.select("event_id", P.document(typed, P.SIMFILE_ATTRS).alias("doc"))


def stream_forward(records: DataFrame, name: str, **settings) -> DataFrame:
    """STR-6 by name: any registered transform over a record stream, empty
    lines dropped, all other columns kept for the sink."""
    return R.drop_empty(R.apply(name, records, **settings))


def stream_geotag(lines: DataFrame, fences: DataFrame) -> DataFrame:
    """STR-7: stream-static point-in-fence tagging."""
    typed = P.simfile_typed(lines).where("error is null").select("event_id", "lon", "lat")
    return geotag(typed, fences).select("event_id", "geotag")


def stream_bursts(lines: DataFrame, gap_ms: int, delay: str) -> DataFrame:
    """STR-2: ``topic, start_ms, end_ms, n`` per closed burst."""
    ev = arrival(lines, delay)
    g = ev.groupBy(F.session_window("arrival", f"{gap_ms} milliseconds"), "topic").agg(
        F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms"), F.count(F.lit(1)).alias("n"))
    return g.select("topic", "start_ms", "end_ms", "n")


def stream_batch_stats(lines: DataFrame, interval_ms: int, delay: str) -> DataFrame:
    """STR-3: per tumbling window of the batch interval."""
    ev = arrival(lines, delay)
    g = ev.groupBy(F.window("arrival", f"{interval_ms} milliseconds")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.unix_millis(F.col("window.start")).alias("window_start_ms"),
                    F.unix_millis(F.col("window.end")).alias("window_end_ms"), "n",
                    (F.lit(1000.0) * F.col("n").cast("double") / F.lit(float(interval_ms))).alias("rate"))


def keep_lines(path: str):
    """For ``foreachBatch``: the batch's records, with their latency, as one
    folder per batch id; a batch that runs again replaces its folder."""
    def each(batch: DataFrame, batch_id: int) -> None:
        B.latency_rows(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return each


def closed_burst_latency(spark, path: str, gap_ms: int) -> DataFrame:
    """AGG-2..4 over what `keep_lines` has stored so far: the bursts that the
    arrivals up to now have closed, with count, rate and average latency. Every
    report reads the whole store: the form for a stored stream of known length.
    For one that runs on, `live.closed_bursts` keeps a state of constant size."""
    rows = spark.read.parquet(path).drop("batch")
    return B.closed_by_arrivals(B.burst_latency_of(rows, gap_ms), gap_ms)


def keep_metrics(path: str, query: str, gap_ms: int):
    """For ``foreachBatch`` over `live.closed_bursts`: the bursts that an epoch
    closed, as its entry in the metrics ledger."""
    def each(bursts: DataFrame, epoch: int) -> None:
        W.metrics_write(bursts.withColumn("closed_ms", F.col("end_ms") + gap_ms), path, query, epoch)
    return each
