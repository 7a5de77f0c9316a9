"""Run a streaming plan over file stand-ins and read its output back.

The file replay stands in for a Kafka topic in queries and tests (no
Kafka broker or connector here); on a cluster the stream comes from
`sources.kafka.kafka_stream`, whose topic partitions give the parallelism.

Input lines are written once, range-partitioned by arrival time into many
files; the files' times are then set in that order, so ``maxFilesPerTrigger``
replays them as micro-batches of several files each. Output goes to a file
sink with its checkpoint in the shared folder: exactly-once, restartable after
a lost executor or driver.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import fresh_path
from .listeners import ProgressLog, finish, idle_reports, logged, stop_when_idle


def write_stream_files(df: DataFrame, order_col: str, batches: int) -> tuple[str, int]:
    """Write ``df`` in ranges of ``order_col`` into a new folder; returns it
    and the number of files that make up one micro-batch.

    Rows with equal order values share a file, so every micro-batch holds a
    later range than the one before it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "stream-in")
    each = max(1, -(-max(spark.sparkContext.defaultParallelism,
                         int(spark.conf.get("spark.sql.shuffle.partitions"))) // batches))
    df.repartitionByRange(batches * each, order_col).write.parquet(path)
    _in_order_of_names(spark, path)
    return path, each


def _in_order_of_names(spark: SparkSession, path: str) -> None:
    """The file source replays in order of file times; the writers finish in any order."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = fs.listFiles(folder, True), []
    while found.hasNext():
        files.append(found.next().getPath())
    for i, f in enumerate(sorted((f for f in files if f.getName().startswith("part-")), key=lambda f: f.toString())):
        fs.setTimes(f, 1_000_000_000_000 + 1000 * i, -1)


def write_stream_slices(df: DataFrame, slice_col: str) -> str:
    """Write one file per value of ``slice_col`` (numbers below 10^9, kept as a
    column), to be replayed a file at a time: micro-batches known beforehand."""
    path = fresh_path(df.sparkSession, "stream-slices")
    named = df.withColumn("_slice", F.format_string("%09d", F.col(slice_col).cast("long")))
    named.repartition("_slice").write.partitionBy("_slice").parquet(path)
    _in_order_of_names(df.sparkSession, path)
    return path


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def _trigger(writer, interval_ms: int | None):
    """Drain what is there, or run on at an interval (SRC-2)."""
    if interval_ms is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{interval_ms} milliseconds")


def start(writer, checkpoint: str, interval_ms: int | None = None) -> StreamingQuery:
    """Start a sink; ``interval_ms`` makes it a continuous run."""
    return _trigger(writer.option("checkpointLocation", checkpoint), interval_ms).start()


def progress(q: StreamingQuery) -> list[tuple[int, int, float, float]]:
    """``(batch, records, seconds, records per second)`` of the non-empty batches
    that Spark still remembers (the last hundred reports); a log has them all."""
    out = []
    for p in q.recentProgress:
        seconds = p.durationMs.get("triggerExecution", 0) / 1000
        if p.numInputRows:
            out.append((p.batchId, p.numInputRows, seconds, p.numInputRows / seconds if seconds else float("nan")))
    return out


def _finish(q: StreamingQuery, log: ProgressLog, what: str) -> None:
    finish(q, log)
    if log.late:
        warnings.warn(f"stream {what}: {log.late} rows came later than the watermark allows and were dropped", stacklevel=3)


def run_logged(stream: DataFrame, what: str, output_mode: str = "append") -> tuple[DataFrame, ProgressLog]:
    """Drain the available input into a parquet sink; its contents as a batch
    DataFrame, and the log with a row per micro-batch (AGG-7 live)."""
    spark = stream.sparkSession
    out = fresh_path(spark, f"{what}-out")
    q, log = logged(lambda: start(stream.writeStream.format("parquet").outputMode(output_mode).option("path", out), out + "-ckpt"),
                    spark, out + "-progress")
    _finish(q, log, what)
    return spark.read.schema(stream.schema).parquet(out), log


def run_until_idle(stream: DataFrame, what: str, interval_ms: int, polls: int = 10) -> DataFrame:
    """SRC-3: a continuous run into a parquet sink that ends by itself after
    ``polls`` triggers in a row without a record; returns the sink's contents."""
    spark = stream.sparkSession
    out = fresh_path(spark, f"{what}-out")
    with idle_reports(spark, interval_ms):
        q, log = logged(lambda: start(stream.writeStream.format("parquet").option("path", out), out + "-ckpt", interval_ms),
                        spark, out + "-progress")
    stop_when_idle(q, log, polls)
    return spark.read.schema(stream.schema).parquet(out)


def run_to_files(stream: DataFrame, what: str, output_mode: str = "append") -> DataFrame:
    """Drain the available input into a parquet sink; return the sink
    contents as a batch DataFrame."""
    return run_logged(stream, what, output_mode)[0]


def run_writer(writer, spark: SparkSession, what: str, checkpoint: str | None = None) -> ProgressLog:
    """Drain the available input through any sink's writer."""
    ckpt = checkpoint or fresh_path(spark, f"{what}-ckpt")
    q, log = logged(lambda: start(writer, ckpt), spark, fresh_path(spark, f"{what}-progress"))
    _finish(q, log, what)
    return log


def run_writer_until_idle(writer, spark: SparkSession, what: str, interval_ms: int, polls: int = 10) -> ProgressLog:
    """`run_until_idle` for any sink's writer."""
    with idle_reports(spark, interval_ms):
        q, log = logged(lambda: start(writer, fresh_path(spark, f"{what}-ckpt"), interval_ms), spark, fresh_path(spark, f"{what}-progress"))
    stop_when_idle(q, log, polls)
    return log


def run_foreach_batch(stream: DataFrame, what: str, fn) -> str:
    """Drain the input through ``fn(batch_df, batch_id)``; returns the
    checkpoint folder."""
    spark = stream.sparkSession
    ckpt = fresh_path(spark, f"{what}-ckpt")
    q, log = logged(lambda: start(stream.writeStream.foreachBatch(fn), ckpt), spark, ckpt + "-progress")
    _finish(q, log, what)
    return ckpt
