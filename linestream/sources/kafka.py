"""Record sources: Kafka when its connector is on the classpath, files otherwise.

Both give the Kafka record columns ``key, value, topic, partition, offset,
timestamp`` (strings for key and value). Progress is kept by the streaming
checkpoint, which replaces consumer-group offset commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def kafka_stream(spark: SparkSession, brokers: str, topics: str | list[str],
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """SRC-1 / SRC-2: subscribe to one topic or a comma-separated list.

    Needs the Spark Kafka connector; the error of a missing connector is
    raised unchanged when the stream is defined.
    """
    if isinstance(topics, list):
        topics = ",".join(topics)
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topics).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return as_records(r.load())


def kafka_bounded(spark: SparkSession, brokers: str, topic: str, partition: int = 0) -> DataFrame:
    """SRC-3: a bounded batch read of one partition, earliest to latest."""
    assign = '{"%s":[%d]}' % (topic, partition)
    df = (spark.read.format("kafka").option("kafka.bootstrap.servers", brokers)
          .option("assign", assign).option("startingOffsets", "earliest")
          .option("endingOffsets", "latest").load())
    return as_records(df)


def as_records(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def lines_as_records(lines: DataFrame) -> DataFrame:
    """Stand-in with the same columns, from a line view
    (``partition_id`` → partition, ``event_id`` → offset, ``ms`` → timestamp)."""
    return lines.select("key", "value", "topic", F.col("partition_id").alias("partition"),
                        F.col("event_id").alias("offset"), F.timestamp_millis("ms").alias("timestamp"))


def subscribe(records: DataFrame, topics: str | list[str]) -> DataFrame:
    """Keep the records of a topic list (a union of topics)."""
    if isinstance(topics, str):
        topics = [t.strip() for t in topics.split(",") if t.strip()]
    return records.where(F.col("topic").isin(topics))
