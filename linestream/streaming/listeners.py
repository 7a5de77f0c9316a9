"""What a running query says of itself: batch statistics (AGG-7 live), late
rows (STR-1), and the end of a bounded read by idleness (SRC-3).

A listener gets every progress event, however long the query runs; the
query's own `recentProgress` forgets all but the last hundred.
"""

from __future__ import annotations

import json
import threading
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

IDLE_REPORTS = "spark.sql.streaming.noDataProgressEventInterval"
PROGRESS_SCHEMA = ("query string, run string, batch long, at string, records long, seconds double, rate double, "
                   "late_rows long, state_rows long")


class ProgressLog(StreamingQueryListener):
    """Writes one row per progress event below ``path``: a file named by run
    and batch, so an event told twice replaces itself. Events of one query only
    (by its id, once `follow` has named it; before that they wait).

    Empty batches are kept out: they follow the clock, not the input. Late
    rows and totals are counted over all events.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.query_id: str | None = None
        self.waiting: list = []
        self.lock = threading.Lock()
        self.records = self.late = self.batches = self.idle = 0
        self.ended = threading.Event()
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(path))

    def follow(self, q: StreamingQuery) -> None:
        with self.lock:
            self.query_id = str(q.id)
            waiting, self.waiting = self.waiting, []
        for kind, event in waiting:
            self._take(kind, event)

    def _take(self, kind: str, event) -> None:
        with self.lock:
            if self.query_id is None:
                self.waiting.append((kind, event))
                return
        if str(event.progress.id if kind == "progress" else event.id) != self.query_id:
            return
        if kind == "ended":
            self.ended.set()
        elif kind == "idle":
            self.idle += 1
        else:
            self._progress(event.progress)

    def _progress(self, p) -> None:
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.late += late
        if not p.numInputRows:
            self.idle += 1
            return
        self.idle = 0
        self.batches += 1
        self.records += p.numInputRows
        seconds = p.durationMs.get("triggerExecution", 0) / 1000
        row = {"query": p.name, "run": str(p.runId), "batch": p.batchId, "at": p.timestamp, "records": p.numInputRows, "seconds": seconds,
               "rate": p.numInputRows / seconds if seconds else None, "late_rows": late,
               "state_rows": sum(s.numRowsTotal for s in p.stateOperators)}
        out = self._fs.create(self._path(f"{self.path}/{row['run']}-{row['batch']:012d}.json"), True)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._take("progress", event)

    def onQueryIdle(self, event) -> None:
        self._take("idle", event)

    def onQueryTerminated(self, event) -> None:
        self._take("ended", event)

    def read(self) -> DataFrame:
        """``query, run, batch, at, records, seconds, rate, late_rows, state_rows``, a row per non-empty batch."""
        return self.spark.read.schema(PROGRESS_SCHEMA).json(self.path)


def logged(writer_start, spark: SparkSession, path: str) -> tuple[StreamingQuery, ProgressLog]:
    """Start a query (``writer_start()`` returns it) with a progress log."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        q = writer_start()
    except Exception:
        spark.streams.removeListener(log)
        raise
    log.follow(q)
    return q, log


def finish(q: StreamingQuery, log: ProgressLog, patience: float = 60.0) -> None:
    """Wait for the query's end and for the listener to have heard of it."""
    try:
        q.awaitTermination()
        log.ended.wait(patience)
    finally:
        log.spark.streams.removeListener(log)
    if q.exception() is not None:
        raise q.exception()


def stop_when_idle(q: StreamingQuery, log: ProgressLog, polls: int = 10, every: float = 0.05) -> None:
    """SRC-3: end a continuous run after ``polls`` triggers in a row without a
    record (ten, as the bounded reader of the original)."""
    while q.isActive and log.idle < polls:
        time.sleep(every)
    if q.isActive:
        q.stop()
    finish(q, log)


@contextmanager
def idle_reports(spark: SparkSession, ms: int):
    """Queries started inside tell of idle triggers every ``ms`` (Spark's default is ten seconds)."""
    before = spark.conf.get(IDLE_REPORTS)
    spark.conf.set(IDLE_REPORTS, str(ms))
    try:
        yield
    finally:
        spark.conf.set(IDLE_REPORTS, before)
