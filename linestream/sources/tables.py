"""Driver tables and the derived line streams built from them (FIXTURES.md §2).

The three line views carry Kafka-like columns
``(event_id, ms, topic, partition_id, key, value)``: ``topic`` is the event
type, ``partition_id`` a stand-in for the Kafka partition, ``ms`` the
arrival time in epoch milliseconds. Everything is a projection of the
``events`` table, so Catalyst prunes the scan to the columns used and the
work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_defaults

LINE_COLUMNS = ["event_id", "ms", "topic", "partition_id", "key", "value"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Input splits that are spread over the slots, at most.
FEW_SPLITS = 4


def spread(df: DataFrame) -> DataFrame:
    """A source of very few input splits (a small file or two, of one row group
    each) would run all per-row work in as many tasks; spread it round-robin
    over the slots. Any other input is left as it is, however many slots there
    are: a shuffle of every raw row costs more than idle slots."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): keep the scan as is
        return df
    if splits <= FEW_SPLITS and 4 * splits <= slots:
        return df.repartition(slots)
    return df


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`ev`: arrival ms, topic, partition, key and the formatted fields."""
    ensure_defaults(spark)
    ev = spread(table(spark, sf_dir, "events"))
    return ev.select(
        "event_id",
        F.expr("unix_millis(cast(ts as timestamp))").alias("ms"),
        F.col("event_type").alias("topic"),
        F.expr("cast(event_id % 4 as int)").alias("partition_id"),
        F.col("user_id").cast("string").alias("key"),
        "user_id",
        "event_type",
        F.expr("date_format(ts, 'dd-MMM-yyyy HH:mm:ss.SSS')").alias("dtg"),
        F.expr("date_format(ts, 'MM/dd/yyyy hh:mm:ss a')").alias("mdy"),
        F.expr("cast(cast((event_id*7919)%36000-18000 as decimal(7,0))"
               "*cast(0.01 as decimal(3,2)) as string)").alias("lon"),
        F.expr("cast(cast((event_id*104729)%18000-9000 as decimal(7,0))"
               "*cast(0.01 as decimal(3,2)) as string)").alias("lat"),
    )


def simfile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle position lines; planted errors: id `bad` (id % 50 = 1),
    missing bearing (% 50 = 2), quoted route holding a comma (% 10 = 0)."""
    ev = events_view(spark, sf_dir)
    value = F.expr("""concat_ws(',', cast(ms as string),
        case when event_id % 50 = 1 then 'bad' else cast(user_id as string) end, dtg,
        case when event_id % 10 = 0 then concat('"', event_type, ',X"') else concat(event_type, '-X') end,
        lon, lat,
        case when event_id % 50 = 2 then cast(event_id % 900 as string)
             else concat(cast(event_id % 900 as string), ',', cast(event_id % 360 as string)) end)""")
    return ev.select("event_id", "ms", "topic", "partition_id", "key", value.alias("value"))


def faa_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft position lines (18 fields, last one quoted); % 50 = 3 has no date."""
    ev = events_view(spark, sf_dir)
    value = F.expr("""concat_ws(',', 'FAA-Stream', cast(event_id as string),
        concat('FL', key), case when event_id % 50 = 3 then 'not-a-date' else mdy end, lon, lat,
        '82.66', '540', '350', 'A343', 'DLH', 'KPHL', 'EDDF', 'JET', 'COMMERCIAL', 'ACTIVE', 'GA',
        concat('"', lon, ',', lat, ',350.0"'))""")
    return ev.select("event_id", "ms", "topic", "partition_id", "key", value.alias("value"))


def latency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose last field is the send time; % 400 = 7 is not a number."""
    ev = events_view(spark, sf_dir)
    value = F.expr("""concat_ws(',', cast(event_id as string), event_type,
        case when event_id % 400 = 7 then 'oops' else cast(ms - (event_id*37) % 5000 as string) end)""")
    return ev.select("event_id", "ms", "topic", "partition_id", "key", value.alias("value"))


LINE_VIEWS = {"simfile_lines": simfile_lines, "faa_lines": faa_lines, "latency_lines": latency_lines}
