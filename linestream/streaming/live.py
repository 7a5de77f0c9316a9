"""Bursts closed by the wall clock (STR-2 with AGG-2, AGG-3, AGG-4).

A topic that falls silent reports its burst once it has been idle for longer
than the gap, whether or not anything arrives elsewhere: a processing-time
timer per topic, on a state of constant size (start, last arrival, count,
latency sum, valid count, cut).

The records of a micro-batch are first summed per (topic, time cell), a cell
being a `CELLS`-th of the gap, so a hot topic is spread over the tasks and
its state meets one row per cell. A cell is shorter than the gap and holds no
burst boundary; as all its records meet in one task, the records before its
first bad line are known exactly, and cells in time order give the burst's
latency prefix. Nothing of an earlier micro-batch is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.bursts import CELLS, latency_rows

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

CELL_SCHEMA = "topic string, lo long, hi long, n long, lat long, valid long, cut boolean"
BURST_SCHEMA = "topic string, start_ms long, end_ms long, n long, rate double, avg_latency double, valid_n long"


@contextmanager
def rocksdb_state(spark):
    """Queries started inside keep their state in RocksDB (timers and typed state need it)."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's records of a micro-batch as one row per (topic, cell)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    t = t.sort_by([(c, "ascending") for c in ("topic", "cell", "ms", "event_id")])
    codes = t["topic"].combine_chunks().dictionary_encode()
    topic = pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False)
    cell, ms = t["cell"].to_numpy(), t["ms"].to_numpy()
    bad = t["bad"].to_numpy().astype(np.int64)
    latency = pc.fill_null(t["latency"], 0).to_numpy()
    starts = np.ones(len(ms), bool)
    starts[1:] = (topic[1:] != topic[:-1]) | (cell[1:] != cell[:-1])
    first = np.flatnonzero(starts)
    n = np.diff(first, append=len(ms))
    seen = np.cumsum(bad)
    valid = seen - np.repeat(seen[first] - bad[first], n) == 0  # no bad line in the cell up to here
    counted = np.add.reduceat(valid.astype(np.int64), first)
    yield pa.RecordBatch.from_arrays(
        [t["topic"].combine_chunks().take(pa.array(first)), pa.array(ms[first]), pa.array(ms[first + n - 1]), pa.array(n, pa.int64()),
         pa.array(np.add.reduceat(np.where(valid, latency, 0), first), pa.int64()), pa.array(counted), pa.array(counted < n)],
        names=["topic", "lo", "hi", "n", "lat", "valid", "cut"])


def cell_sums(lines: DataFrame, gap_ms: int) -> DataFrame:
    """``topic, lo, hi, n, lat, valid, cut`` per time cell of a micro-batch (or of a batch)."""
    cell = F.expr(f"((ms - pmod(ms, {gap_ms})) div {gap_ms}) * {CELLS} + pmod(ms, {gap_ms}) * {CELLS} div {gap_ms}")
    rows = latency_rows(lines).select("topic", cell.alias("cell"), "ms", "event_id", "latency", "bad")
    return rows.repartition("topic", "cell").mapInArrow(_sum_cells, CELL_SCHEMA)


class BurstProcessor(StatefulProcessor):
    """One topic's open burst."""

    def __init__(self, gap_ms: int, idle_ms: int):
        self.gap_ms, self.idle_ms = gap_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start long, last long, n long, lat long, valid long, cut boolean")

    def _report(self, topic, burst: list) -> Row:
        start, last, n, lat, valid, _ = burst
        return Row(topic=topic, start_ms=start, end_ms=last, n=n, rate=1000.0 * n / (last - start) if last > start else None,
                   avg_latency=lat / n, valid_n=valid)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        burst = list(self.open.get()) if self.open.exists() else None
        for lo, hi, n, lat, valid, cut in sorted((r.lo, r.hi, r.n, r.lat, r.valid, r.cut) for r in rows):
            if burst is not None and lo - burst[1] > self.gap_ms:
                yield self._report(key[0], burst)
                burst = None
            if burst is None:
                burst = [lo, hi, 0, 0, 0, False]
            burst[0], burst[1] = min(burst[0], lo), max(burst[1], hi)
            burst[2] += n
            if not burst[5]:
                burst[3] += lat
                burst[4] += valid
                burst[5] = cut
        self.open.update(tuple(burst))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # idle for longer than the gap, not as long
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        burst = list(self.open.get())
        self.open.clear()
        yield self._report(key[0], burst)

    def close(self) -> None:
        pass


def closed_bursts(lines: DataFrame, gap_ms: int, idle_ms: int | None = None) -> DataFrame:
    """``topic, start_ms, end_ms, n, rate, avg_latency, valid_n`` of a stream of
    lines (topic, ms, event_id, value), each burst once, when it ends: when a
    record comes more than ``gap_ms`` after the last, or when none has come for
    ``idle_ms`` of the wall clock (the gap, unless a replay is faster or slower
    than what it replays; then longer than a topic waits between two of the
    replay's micro-batches). Start it inside `rocksdb_state`, at an interval, in
    append mode. A record that comes late joins the open burst; records of one
    millisecond are taken by ``event_id``.
    """
    return cell_sums(lines, gap_ms).groupBy("topic").transformWithState(
        BurstProcessor(gap_ms, gap_ms if idle_ms is None else idle_ms), BURST_SCHEMA, "Append", "ProcessingTime")
