"""Bursts: runs of records split where the arrival gap exceeds ``gap_ms``.

A burst closes when no record arrives for more than ``gap_ms`` (strict: a
gap of exactly ``gap_ms`` stays inside). Exact and distributed:

1. Bucket rows by ``ms div gap_ms``. Two rows of one bucket are less than a
   gap apart, so a bucket never holds a burst boundary. Aggregate per
   ``(topic, bucket)`` — a partial (map-side) aggregate, so a hot topic or a
   hot bucket is combined before the shuffle — and materialise: the raw rows
   are scanned once.
2. On the bucket table (bounded by time span / gap per topic, not by the row
   count) a bucket starts a burst when ``lo - previous hi > gap``; the burst
   id is the start bucket, carried forward with a two-level running ``max``.
3. Row-level facts (latency prefix, positions) come from sums per bucket or
   cell; only what a cut or a position needs is read from the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import last_field, strict_long
from .running import running_max, running_sum
from .sizing import checked_broadcast, materialize


def bucket_of(width_ms: int, ms: str = "ms") -> Column:
    """``floor(ms / width)`` in integer arithmetic, exact for negatives too."""
    return F.expr(f"({ms} - pmod({ms}, {width_ms})) div {width_ms}")


def rate(n: Column, start_ms: Column, end_ms: Column) -> Column:
    """Records per second over ``end - start``; NULL for a zero-length span."""
    return F.when(end_ms > start_ms,
                  (F.lit(1000.0) * n.cast("double")) / (end_ms - start_ms).cast("double"))


def bucket_table(rows: DataFrame, gap_ms: int, by: list[str], extra_aggs: list[Column] | None = None) -> DataFrame:
    """One row per non-empty ``(by, bucket)``: n, lo, hi, extras. The one scan
    of the raw rows; the result is materialised, all else runs on it."""
    agg = rows.withColumn("bucket", bucket_of(gap_ms)).groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("ms").alias("lo"), F.max("ms").alias("hi"), *(extra_aggs or []))
    return materialize(agg)


def with_burst(buckets: DataFrame, gap_ms: int, by: list[str]) -> DataFrame:
    """Add ``burst`` (the start bucket of its burst) to a bucket table.

    A bucket starts a burst when the bucket before it is empty (then the
    gap is at least ``gap + 1``) or when ``lo - previous hi > gap``: an
    equi-join with the bucket table shifted by one, no window. The burst id
    (the latest start at or before the bucket) is a running ``max``.
    """
    prev = buckets.select(*by, (F.col("bucket") + 1).alias("bucket"), F.col("hi").alias("_prev_hi"))
    start = F.col("_prev_hi").isNull() | ((F.col("lo") - F.col("_prev_hi")) > gap_ms)
    flagged = (buckets.join(prev, [*by, "bucket"], "left")
               .withColumn("_start", F.when(start, F.col("bucket"))).drop("_prev_hi"))
    return running_max(flagged, by, "bucket", F.col("_start"), "burst").drop("_start")


def burst_buckets(rows: DataFrame, gap_ms: int, by: list[str] | None = None,
                  extra_aggs: list[Column] | None = None) -> DataFrame:
    """``by, bucket, n, lo, hi, extras, burst`` in one scan of the rows."""
    by = ["topic"] if by is None else by
    return with_burst(bucket_table(rows, gap_ms, by, extra_aggs), gap_ms, by)


def bursts(rows: DataFrame, gap_ms: int, by: list[str] | None = None) -> DataFrame:
    """``by..., start_ms, end_ms, n`` — one row per burst (AGG-2)."""
    by = ["topic"] if by is None else by
    bb = burst_buckets(rows, gap_ms, by)
    return bb.groupBy(*by, "burst").agg(
        F.min("lo").alias("start_ms"), F.max("hi").alias("end_ms"),
        F.sum("n").alias("n")).drop("burst")


def burst_rates(rows: DataFrame, gap_ms: int, by: list[str] | None = None) -> DataFrame:
    """AGG-3: bursts plus ``rate = 1000 * n / (end - start)``."""
    return bursts(rows, gap_ms, by).withColumn(
        "rate", rate(F.col("n"), F.col("start_ms"), F.col("end_ms")))


def latency_rows(lines: DataFrame) -> DataFrame:
    """Send time = last field; latency = arrival - send; ``bad`` when the
    last field is not a strict integer."""
    sent = strict_long(last_field(F.col("value")))
    return lines.select(*[c for c in lines.columns if c != "value"],
                        (F.col("ms") - sent).alias("latency"), sent.isNull().alias("bad"))


def burst_latency(lines: DataFrame, gap_ms: int, by: list[str] | None = None) -> DataFrame:
    """AGG-4. Latencies add up until the first bad line of a burst (in
    arrival order ``(ms, event_id)``); the sum is divided by the whole count.

    Output: ``by..., start_ms, end_ms, n, rate, avg_latency, valid_n``. Whole
    buckets before the cut count with their sums; only the bucket that holds
    a burst's cut is read again.
    """
    return burst_latency_of(latency_rows(lines), gap_ms, by)


def burst_latency_of(rows: DataFrame, gap_ms: int, by: list[str] | None = None) -> DataFrame:
    """`burst_latency` of rows that carry ``latency`` and ``bad`` already."""
    by = ["topic"] if by is None else by
    bb = materialize(burst_buckets(rows, gap_ms, by, [
        F.min(F.when(F.col("bad"), F.struct("ms", "event_id"))).alias("first_bad"),
        F.coalesce(F.sum("latency"), F.lit(0)).alias("lat")]))
    cuts = (bb.groupBy(*by, "burst").agg(F.min("first_bad").alias("cut")).where("cut is not null")
            .withColumn("cut_bucket", F.expr(f"(cut.ms - pmod(cut.ms, {gap_ms})) div {gap_ms}")))
    whole = (bb.join(cuts, [*by, "burst"], "left")
             .withColumn("_whole", F.col("cut").isNull() | (F.col("bucket") < F.col("cut_bucket"))))
    summed = whole.groupBy(*by, "burst").agg(
        F.min("lo").alias("start_ms"), F.max("hi").alias("end_ms"), F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("_whole"), F.col("n"))), F.lit(0)).alias("_valid"),
        F.coalesce(F.sum(F.when(F.col("_whole"), F.col("lat"))), F.lit(0)).alias("_lat"))
    side, _ = checked_broadcast(cuts.select(*by, F.col("cut_bucket").alias("bucket"), "burst", "cut"))
    part = (rows.withColumn("bucket", bucket_of(gap_ms)).join(side, [*by, "bucket"])
            .where(F.struct("ms", "event_id") < F.col("cut"))
            .groupBy(*by, "burst").agg(F.count(F.lit(1)).alias("_valid2"), F.sum("latency").alias("_lat2")))
    out = summed.join(part, [*by, "burst"], "left")
    valid = F.col("_valid") + F.coalesce("_valid2", F.lit(0))
    lat = F.col("_lat") + F.coalesce("_lat2", F.lit(0))
    return out.select(*by, "start_ms", "end_ms", "n", valid.alias("valid_n"),
                      rate(F.col("n"), F.col("start_ms"), F.col("end_ms")).alias("rate"),
                      (lat.cast("double") / F.col("n").cast("double")).alias("avg_latency"))


#: Time cells in a bucket, and rows of a cell beyond which it is cut further.
CELLS = 64
HEAVY = 1_000_000


def burst_positions(rows: DataFrame, gap_ms: int, by: list[str] | None = None, heavy: int = HEAVY) -> DataFrame:
    """Every row with ``burst`` (start bucket) and ``idx``: its 0-based
    position inside the burst in arrival order ``(ms, event_id)``.

    Rows are numbered inside time cells (a bucket's 64th parts); the counts of
    the cells, taken in the one scan that also finds the bursts, give each cell
    its offset. A cell of more than ``heavy`` rows is cut into more, by time or
    (all in one millisecond) by id, so no task orders a hot bucket.
    """
    by = ["topic"] if by is None else by
    # cell numbers grow with time across buckets
    cell = F.expr(f"((ms - pmod(ms, {gap_ms})) div {gap_ms}) * {CELLS} + pmod(ms, {gap_ms}) * {CELLS} div {gap_ms}")
    rows = rows.withColumn("cell", cell)
    cells = materialize(rows.groupBy(*by, "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("ms").alias("lo"), F.max("ms").alias("hi"),
        F.min("event_id").alias("ilo"), F.max("event_id").alias("ihi")))
    buckets = (cells.withColumn("bucket", F.expr(f"(cell - pmod(cell, {CELLS})) div {CELLS}"))
               .groupBy(*by, "bucket").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    bursts_of = with_burst(buckets, gap_ms, by).select(*by, "bucket", "burst")
    cells = (cells.withColumn("bucket", F.expr(f"(cell - pmod(cell, {CELLS})) div {CELLS}"))
             .join(bursts_of, [*by, "bucket"]).drop("bucket"))
    summed = running_sum(cells, by, "cell", F.col("n"), "_up_to").withColumn("_before", F.col("_up_to") - F.col("n"))
    # the sum only grows, so the latest burst start's sum is the greatest
    first = F.min("_before").alias("_burst_before")
    starts = summed.groupBy(*by, "burst").agg(first)
    offsets = materialize(summed.join(starts, [*by, "burst"])
                          .select(*by, "cell", "burst", "n", "lo", "hi", "ilo", "ihi",
                                  (F.col("_before") - F.col("_burst_before")).alias("off")))
    order = ["ms", "event_id"]
    side, _ = checked_broadcast(offsets.select(*by, "cell", "burst", "off"))
    tagged = rows.join(side, [*by, "cell"])
    big = offsets.where(F.col("n") > heavy).withColumn("pieces", F.ceil(F.col("n") / heavy))
    if not big.take(1):
        inside = F.row_number().over(Window.partitionBy(*by, "cell").orderBy(*order)) - 1
        return tagged.withColumn("idx", F.col("off") + inside).drop("cell", "off")
    # at most rows / heavy cells
    cut, _ = checked_broadcast(big.select(*by, "cell", "lo", "hi", "ilo", "ihi", "pieces"))
    piece = (F.when(F.col("pieces").isNull(), 0)
             .when(F.col("hi") > F.col("lo"), F.expr("(ms - lo) * pieces div (hi - lo + 1)"))
             .otherwise(F.expr("(event_id - ilo) * pieces div (ihi - ilo + 1)")))
    tagged = tagged.join(cut, [*by, "cell"], "left").withColumn("piece", piece)
    counts = tagged.where("pieces is not null").groupBy(*by, "cell", "piece").agg(F.count(F.lit(1)).alias("_n"))
    more = counts.select(*by, "cell", "piece", (F.sum("_n").over(
        Window.partitionBy(*by, "cell").orderBy("piece")) - F.col("_n")).alias("_more"))
    inside = F.row_number().over(Window.partitionBy(*by, "cell", "piece").orderBy(*order)) - 1
    return (tagged.withColumn("_in", inside).join(more, [*by, "cell", "piece"], "left")
            .withColumn("idx", F.col("off") + F.coalesce("_more", F.lit(0)) + F.col("_in"))
            .drop("cell", "off", "lo", "hi", "ilo", "ihi", "pieces", "piece", "_in", "_more"))


def every_nth(rows: DataFrame, n_th: int, gap_ms: int, by: list[str] | None = None) -> DataFrame:
    """FLT-4: keep rows whose 0-based input position in the burst is a
    multiple of ``n_th``; the position restarts with every burst."""
    pos = burst_positions(rows, gap_ms, by)
    return pos.where(F.pmod(F.col("idx"), F.lit(n_th)) == 0)


def closed(bursts: DataFrame, gap_ms: int, now_ms: Column) -> DataFrame:
    """Bursts that are over at ``now_ms``: nothing came for the gap. Adds ``closed_ms``."""
    return bursts.withColumn("closed_ms", F.col("end_ms") + gap_ms).where(F.col("closed_ms") <= now_ms)


def closed_by_arrivals(bursts: DataFrame, gap_ms: int) -> DataFrame:
    """Bursts that the latest arrival has closed. Every record is in a burst, so
    that arrival is the latest end: the records are not read for it."""
    bursts = materialize(bursts)
    now = bursts.agg(F.max("end_ms")).first()[0]
    return closed(bursts, gap_ms, F.lit(now).cast("long"))
