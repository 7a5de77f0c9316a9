"""Sinks (SNK-1..6): Kafka when available, file layouts otherwise.

* Kafka: ``key`` kept from the input record, ``value`` = output line.
* Bulk document index: newline-delimited JSON under ``index=<i>/type=<t>/``,
  each document stored as given under ``_source`` with a deterministic ``_id``
  built from ``topic-partition-offset``. An index is only added to: every run
  has a folder of its own below the type, a micro-batch one named by its
  number, which alone a replay overwrites. Of documents with one ``_id`` the
  one written last is read. `index_source` sends bulk requests of bounded
  number, bytes and time; `index_write` leaves files to Spark's text writer.
* Metrics table: a ledger with a folder per query and epoch, which a replay
  overwrites; read, it has one row per closed burst.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_write(df: DataFrame, brokers: str, topic: str):
    """SNK-1 (batch). Needs the Spark Kafka connector."""
    (df.select(F.col("key").cast("string"), F.col("value").cast("string"))
     .write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save())


def kafka_stream(stream: DataFrame, brokers: str, topic: str):
    """SNK-1 on a stream: a writer for `streaming.runner.start`, which adds the
    checkpoint and the trigger. Delivery is at least once, as in the original."""
    return (stream.select(F.col("key").cast("string"), F.col("value").cast("string"))
            .writeStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic))


def kafka_stand_in_write(df: DataFrame, path: str, mode: str = "append") -> str:
    """Same two columns (plus the record coordinates) as parquet."""
    df.write.mode(mode).parquet(path)
    return path


def doc_id(topic="topic", partition="partition", offset="offset"):
    return F.concat_ws("-", F.col(topic), F.col(partition).cast("string"), F.col(offset).cast("string"))


def bulk_lines(docs: DataFrame, doc_col: str = "doc", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``{"_id": "...", "_source": <document as given>}`` per line. A document
    that is not JSON fails the batch."""
    head = docs.select(F.to_json(F.struct(F.col(id_col).alias("_id"))).alias("_h"), doc_col, *(keep or []))
    line = F.concat(F.expr("substring(_h, 1, length(_h) - 1)"), F.lit(',"_source":'),
                    F.col(doc_col), F.lit("}"))
    wrong = F.try_parse_json(F.col(doc_col)).isNull()
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("not a JSON document: "), F.coalesce(F.col(doc_col), F.lit("null")))))
    return head.select(checked.otherwise(line).alias("value"), *(keep or []))


def bulk_requests(lines: Iterable[str], actions: int, most_bytes: int = 1 << 30, most_seconds: float = 5.0,
                  clock=time.monotonic) -> Iterator[list[str]]:
    """Cut a task's documents into bulk requests for a connector (call it in
    ``foreachPartition``): after ``actions`` documents, before ``most_bytes``,
    or when a document comes ``most_seconds`` after the request's first."""
    held: list[str] = []
    size, since = 0, 0.0
    for line in lines:
        n = len(line.encode())
        if held and (size + n > most_bytes or clock() - since >= most_seconds):
            yield held
            held, size = [], 0
        if not held:
            since = clock()
        held.append(line)
        size += n
        if len(held) >= actions:
            yield held
            held, size = [], 0
    if held:
        yield held


def index_write(docs: DataFrame, root: str, index: str, doc_type: str | None, doc_col: str = "doc", id_col: str = "doc_id",
                batch_id: int | None = None, run: str | None = None) -> str:
    """SNK-2 / SNK-3 / SNK-4: add documents to an index; returns its folder, or the type's.

    With ``doc_type`` None the documents' column ``type`` names their types.
    The run's folder is ``run=<run>`` (a new one by default), with ``batch_id``
    ``batch=<id>``; only that is overwritten, in the types that are written."""
    path = f"{root.rstrip('/')}/index={index}"
    kind, value = ("run", run or f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}") if batch_id is None else ("batch", str(batch_id))
    if doc_type is None:
        (bulk_lines(docs, doc_col, id_col, ["type"]).withColumn(kind, F.lit(value)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("type", kind).text(path))
        return path
    bulk_lines(docs, doc_col, id_col).write.mode("overwrite").text(f"{path}/type={doc_type}/{kind}={value}")
    return f"{path}/type={doc_type}"


def index_read(spark, path: str, source_schema: str, latest: bool = True) -> DataFrame:
    """Read a bulk layout back: ``_id`` and the parsed ``_source`` of all runs
    and batches below the type's folder; of several documents with one ``_id``
    the one in the file written last (``latest=False``: all of them)."""
    rows = spark.read.schema(f"_id string, _source struct<{source_schema}>").option("recursiveFileLookup", "true").json(path)
    if not latest:
        return rows.select("_id", "_source")
    written = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
    return (rows.select("_id", "_source", written.alias("_written")).groupBy("_id")
            .agg(F.max_by("_source", "_written").alias("_source")))


METRICS = "topic string, closed_ms long, count long, rate double, latency double"


def metrics_write(closed_bursts: DataFrame, path: str, query: str = "batch", epoch: int = 0) -> str:
    """SNK-6: one row per closed burst (`operators.bursts.closed`), as the entry of
    one epoch of one query, which it overwrites; the close time is the last
    arrival plus the idle gap that closed it."""
    (closed_bursts.select("topic", "closed_ms", F.col("n").alias("count"), "rate", F.col("avg_latency").alias("latency"))
     .write.mode("overwrite").parquet(f"{path}/query={query}/epoch={epoch}"))
    return path


def metrics_read(spark, path: str) -> DataFrame:
    """The table: ``topic, closed_ms, count, rate, latency``, one row per topic and
    close time however often it was reported (of several the fullest)."""
    rows = spark.read.schema(METRICS).option("recursiveFileLookup", "true").parquet(path)
    return (rows.groupBy("topic", "closed_ms").agg(F.max(F.struct("count", "rate", "latency")).alias("b"))
            .select("topic", "closed_ms", "b.count", "b.rate", "b.latency"))


def metrics_compact(spark, path: str, name: str = "compacted") -> int:
    """Merge all entries into one and remove them; returns how many there were. The
    merged entry is written first, so one that dies in between leaves rows that
    reading merges; an epoch replayed later is merged with it in the same way."""
    jvm = spark.sparkContext._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [e.getPath().toString() for q in fs.listStatus(to_path(path)) if q.isDirectory() for e in fs.listStatus(q.getPath()) if e.isDirectory()]
    if not old:
        return 0
    into = f"{path}/query={name}/epoch={time.time_ns() // 1_000_000}"
    metrics_read(spark, path).write.parquet(into)
    for folder in old:
        fs.delete(to_path(folder), True)
    return len(old)
