"""Per-batch and per-run statistics (AGG-7..10, FLT-5) replayed from arrival times.

A micro-batch of interval ``I`` is the tumbling window ``ms div I``. Only
non-empty windows produce rows (FLT-5). A run is a maximal chain of
consecutive non-empty windows: a window whose predecessor is empty starts one
(an equi-join), and the start is carried on in two levels (`running`), so no
task has to see every window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bursts import bucket_of, rate
from .running import running_max
from .scan import segments
from .sizing import materialize


def batch_stats(rows: DataFrame, interval_ms: int, by: list[str] | None = None) -> DataFrame:
    """AGG-7: ``by..., window_start_ms, window_end_ms, n, rate``; the elapsed
    time of a replayed batch is its interval."""
    by = by or []
    w = rows.groupBy(*by, bucket_of(interval_ms).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(*by, (F.col("w") * interval_ms).alias("window_start_ms"),
                    ((F.col("w") + 1) * interval_ms).alias("window_end_ms"), "n",
                    (F.lit(1000.0) * F.col("n").cast("double") / F.lit(float(interval_ms))).alias("rate"))


def _batches(rows: DataFrame, interval_ms: int, by: list[str]) -> DataFrame:
    """The non-empty batches ``by..., w, n``, materialised (one scan of the rows)."""
    return materialize(rows.groupBy(*by, bucket_of(interval_ms).alias("w")).agg(F.count(F.lit(1)).alias("n")))


def _runs(rows: DataFrame, interval_ms: int, by: list[str]) -> DataFrame:
    """Runs of consecutive non-empty batches that an empty batch has ended:
    the run of the last batch of all is still open and not reported."""
    w = _batches(rows, interval_ms, by)
    before = w.select(*by, (F.col("w") + 1).alias("w"), F.lit(1).alias("_joins"))
    flagged = w.join(before, [*by, "w"], "left").withColumn("_start", F.when(F.col("_joins").isNull(), F.col("w")))
    runs = running_max(flagged, by, "w", F.col("_start"), "run").groupBy(*by, "run").agg(
        F.min("w").alias("_w0"), F.max("w").alias("_w1"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches"))
    last = w.agg(F.max("w")).first()[0]
    return runs.where(F.col("_w1") < F.lit(last).cast("long"))


def run_stats(rows: DataFrame, interval_ms: int, by: list[str] | None = None) -> DataFrame:
    """AGG-8: per ended run of non-empty batches: total records and the
    unweighted mean of the batch rates (``avg_rate``; batches are equally long,
    so it is the total over the run's time); ``start_ms`` / ``end_ms`` bound
    the run's windows."""
    by = by or []
    r = _runs(rows, interval_ms, by)
    mean = F.lit(1000.0) * F.col("n").cast("double") / (F.col("batches") * interval_ms).cast("double")
    return r.select(*by, (F.col("_w0") * interval_ms).alias("start_ms"),
                    ((F.col("_w1") + 1) * interval_ms).alias("end_ms"), "n", "batches", mean.alias("avg_rate"))


def microbatch_burst(rows: DataFrame, interval_ms: int, by: list[str] | None = None) -> DataFrame:
    """AGG-10: a burst starts at its first non-empty batch and ends at its
    last one (batch times = window ends); rate = total / (end - start). It is
    reported once an empty batch has ended it."""
    by = by or []
    r = _runs(rows, interval_ms, by)
    start = (F.col("_w0") + 1) * interval_ms
    end = (F.col("_w1") + 1) * interval_ms
    return r.select(*by, start.alias("start_ms"), end.alias("end_ms"), "n",
                    rate(F.col("n"), start, end).alias("rate"))


def running_burst_count(rows: DataFrame, interval_ms: int, gap_ms: int,
                        by: list[str] | None = None) -> DataFrame:
    """AGG-9: after each non-empty batch, the running count of its burst; and
    one row with 0 when a burst is reset.

    A burst ends when the next non-empty batch comes more than ``gap_ms``
    after the last one (batch times = window ends). The count goes back to 0
    with the first empty batch more than ``gap_ms`` after the last non-empty
    one, if there is one before the next non-empty batch or the end of all
    input. The other idle batches, which repeat a count, are left out: they
    grow with time and not with the input. Starts and sums come from one scan
    over the batch table (`scan`), resets from the same rows: a burst's reset is
    told by the batch that starts the next one, a group's last by its last batch.
    """
    by = ["topic"] if by is None else by
    w = _batches(rows, interval_ms, by)
    b = segments(w, by, "w", "n", gap_ms // interval_ms)
    ends = w.groupBy(*by).agg(F.max("w").alias("_w"))  # a row a group
    last = ends.agg(F.max("_w")).first()[0]
    idle = gap_ms // interval_ms + 1  # batches from the last non-empty one to the reset
    batch_ms, zero = (F.col("w") + 1) * interval_ms, F.lit(0).cast("long")
    count = F.struct(batch_ms.alias("batch_ms"), F.col("n").alias("n"), F.col("running").alias("running_n"))
    reset = F.struct(((F.col("previous") + idle + 1) * interval_ms).alias("batch_ms"), zero.alias("n"), zero.alias("running_n"))
    both = F.when(F.col("previous") + idle < F.col("w"), F.array(reset, count)).otherwise(F.array(count))
    counts = b.select(*by, F.inline(both))
    open_ends = ends.where(F.col("_w") + idle <= F.lit(last).cast("long"))
    return counts.unionByName(open_ends.select(*by, ((F.col("_w") + idle + 1) * interval_ms).alias("batch_ms"),
                                               zero.alias("n"), zero.alias("running_n")))
