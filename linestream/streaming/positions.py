"""Every-Nth sampling on a stream (FLT-4, SNK-5 live).

A micro-batch is numbered in parallel, as in batch (`bursts.burst_positions`:
counts of time cells, offsets, row numbers inside); what goes on from the
batch before is one row per topic: the last arrival and the number the next
record of its burst gets. The first burst of a topic in a batch goes on with
that number if it starts within the gap.

The carry is a ledger with a folder per batch number: batch k reads that of
the batch before and writes its own, so a batch that runs again reads the same
carry and replaces its own output and its own carry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bursts as B
from ..operators.sizing import checked_broadcast, materialize

CARRY = "topic string, last_ms long, next long"


def _carry(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """What the batch before left: a row per topic seen so far."""
    path = f"{folder}/batch={batch_id - 1}"
    if batch_id == 0:
        return spark.createDataFrame([], CARRY)
    return spark.read.schema(CARRY).parquet(path)


def number_batch(batch: DataFrame, batch_id: int, gap_ms: int, carry: str) -> DataFrame:
    """The batch's records with ``burst`` and ``idx``, the 0-based position in
    their burst, counted on from the batches before; writes the batch's carry.
    Records are taken by (ms, event_id), those of a later batch after."""
    spark = batch.sparkSession
    rows = materialize(B.burst_positions(batch, gap_ms, ["topic"]))
    old, _ = checked_broadcast(_carry(spark, carry, batch_id).select(F.col("topic").alias("_t"), "last_ms", "next"))
    spans = rows.groupBy("topic", "burst").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi"), F.count(F.lit(1)).alias("n"))
    ends = spans.groupBy("topic").agg(F.min(F.struct("burst", "lo", "n")).alias("first"), F.max(F.struct("burst", "hi", "n")).alias("last"))
    # a topic with a carry only, one with rows only, or both
    met = ends.join(old, F.col("topic").eqNullSafe(F.col("_t")), "full")
    goes_on = F.col("first").isNotNull() & F.col("last_ms").isNotNull() & (F.col("first.lo") - F.col("last_ms") <= gap_ms)
    met = materialize(met.withColumn("_from", F.when(goes_on, F.col("next")).otherwise(F.lit(0)).cast("long")))
    topic = F.when(F.col("first").isNotNull(), F.col("topic")).otherwise(F.col("_t"))
    single = F.col("first.burst") == F.col("last.burst")
    met.select(topic.alias("topic"), F.greatest(F.col("last_ms"), F.col("last.hi")).alias("last_ms"),
               F.when(F.col("first").isNull(), F.col("next"))
               .otherwise(F.col("last.n") + F.when(single, F.col("_from")).otherwise(F.lit(0))).cast("long").alias("next")
               ).write.mode("overwrite").parquet(f"{carry}/batch={batch_id}")
    offsets, _ = checked_broadcast(met.where("first is not null and _from > 0")
                                   .select(F.col("topic").alias("_t"), F.col("first.burst").alias("_b"), "_from"))
    out = rows.join(offsets, F.col("topic").eqNullSafe(F.col("_t")) & (F.col("burst") == F.col("_b")), "left")
    return out.withColumn("idx", F.col("idx") + F.coalesce("_from", F.lit(0))).drop("_t", "_b", "_from")


def every_nth(n_th: int, gap_ms: int, folder: str, sink: Callable[[DataFrame], DataFrame] | None = None):
    """For ``foreachBatch``: every ``n_th`` record of each burst, through
    ``sink`` (a transform and its console lines, say), as one folder per batch
    below ``folder``/out; the carry is beside it."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = number_batch(batch, batch_id, gap_ms, f"{folder}/carry")
        kept = rows.where(F.pmod(F.col("idx"), F.lit(n_th)) == 0)
        (sink(kept) if sink else kept).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
    return each


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/out").drop("batch")
