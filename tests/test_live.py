"""Live operators: wall-clock bursts, listeners, bounded reads, positions and
sinks that go on over micro-batches, and what a failure leaves behind."""

import os
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from linestream.operators import bursts as B
from linestream.session import fresh_path
from linestream.streaming import listeners as LI
from linestream.streaming import live as L
from linestream.streaming import runner as RUN
from linestream.streaming import streams as S

LINES = "event_id long, ms long, topic string, value string"


def _random_lines(n=3000, seed=3, topics=("a", "b", None)):
    rnd = random.Random(seed)
    out, ms = [], 0
    for i in range(n):
        ms += rnd.choice([0, 0, 1, 7, 40, 90]) if rnd.random() < 0.99 else 1500
        value = f"x,{ms - rnd.randrange(50)}" if rnd.random() < 0.98 else "x,oops"
        out.append((i, ms, topics[0] if i % 3 else rnd.choice(topics), value))
    return out


def _stream(spark, df, slice_of):
    cut = df.withColumn("part", slice_of.cast("long"))
    return RUN.file_stream(spark, RUN.write_stream_slices(cut, "part"), df.schema)


def test_cells_hold_what_precedes_the_first_bad_line(spark):
    gap = 640  # cells of 10 ms
    df = spark.createDataFrame(_random_lines(), LINES).repartition(5)
    got = {(r.topic, r.lo // 10): tuple(r)[3:] for r in L.cell_sums(df, gap).collect()}
    want = {}
    for i, ms, topic, value in sorted(df.collect(), key=lambda r: (r[1], r[0])):
        n, lat, valid, cut = want.get((topic, ms // 10), (0, 0, 0, False))
        bad = value.endswith("oops")
        cut = cut or bad
        want[topic, ms // 10] = (n + 1, lat + (0 if cut else ms - int(value[2:])), valid + (not cut), cut)
    assert got == want


def _live_bursts(spark, df, gap, slice_of, idle_ms=700):
    with L.rocksdb_state(spark):
        out = RUN.run_until_idle(L.closed_bursts(_stream(spark, df, slice_of), gap, idle_ms), "live-test", 100, 12)
    return sorted(map(repr, map(tuple, out.collect())))


def _batch_bursts(df, gap):
    cols = ["topic", "start_ms", "end_ms", "n", "rate", "avg_latency", "valid_n"]
    return sorted(map(repr, map(tuple, B.burst_latency(df, gap).select(*cols).collect())))


def test_a_silent_topic_reports_its_burst(spark):
    """Input stops (for one topic early, for all at the end): the wall clock ends every burst, once."""
    gap = 1000
    df = spark.createDataFrame(_random_lines(1200, topics=("a", "b", "c")), LINES)
    early = df.where("topic <> 'c' or ms < 2000")  # c falls silent
    assert _live_bursts(spark, early, gap, F.expr("ms div 9000")) == _batch_bursts(early, gap)


def test_a_burst_over_many_batches_and_a_gap_of_exactly_the_limit(spark):
    rows = [(i, 100 * i, "t", f"x,{100 * i - 7}") for i in range(10)] + [(10, 900 + 500, "t", "x,oops"), (11, 1400, "t", "x,1"),
                                                                       (12, 1901, "t", "x,1900"), (13, 2402, "t", "x,2400")]
    df = spark.createDataFrame(rows, LINES)
    got = _live_bursts(spark, df, 500, F.expr("ms div 400"))
    assert got == _batch_bursts(df, 500) and len(got) == 3


def test_every_batch_is_logged_and_every_late_row_counted(spark):
    """150 micro-batches, one late row in most; the query itself remembers a hundred."""
    rows = [(i, 1000 * i, "t", "v") for i in range(150)] + [(1000 + i, 1, "t", "v") for i in range(1, 150)]
    df = spark.createDataFrame(rows, LINES)
    st = _stream(spark, df, F.expr("event_id % 1000")).select("ms", "topic")
    with pytest.warns(UserWarning, match="rows came later"):
        out, log = RUN.run_logged(S.stream_bursts(st, 500, "0 seconds"), "many")
    kept = out.agg(F.sum("n")).first()[0]
    seen = log.read()
    assert seen.count() == log.batches == 150
    assert seen.agg(F.sum("records")).first()[0] == log.records == len(rows)
    # all rows are in a reported burst, in the last (open) one, or late
    assert log.late == seen.agg(F.sum("late_rows")).first()[0] == len(rows) - kept - 1
    assert log.late > 140


def _event(run, batch, records, query="q", late=0):
    return SimpleNamespace(progress=SimpleNamespace(
        id=query, runId=run, name="n", batchId=batch, timestamp="2024-01-01", numInputRows=records, durationMs={"triggerExecution": 500},
        stateOperators=[SimpleNamespace(numRowsDroppedByWatermark=late, numRowsTotal=3)]))


def test_a_log_keeps_to_its_query_and_replaces_repeats(spark):
    log = LI.ProgressLog(spark, fresh_path(spark, "log"))
    log.onQueryProgress(_event("r", 0, 5))  # before the query is known
    log.onQueryProgress(_event("other", 0, 9, query="p"))
    log.follow(SimpleNamespace(id="q"))
    for e in (_event("r", 1, 7), _event("r", 1, 7), _event("r", 2, 0), _event("s", 2, 4, late=2)):
        log.onQueryProgress(e)
    got = sorted((r.run, r.batch, r.records, r.rate, r.late_rows) for r in log.read().collect())
    assert got == [("r", 0, 5, 10.0, 0), ("r", 1, 7, 14.0, 0), ("s", 2, 4, 8.0, 2)]


def test_a_bounded_read_of_nothing_ends(spark):
    df = spark.createDataFrame([(1, 1, "t", "v")], LINES)
    st = _stream(spark, df, F.lit(0)).where("topic = 'none'")
    assert RUN.run_until_idle(st, "nothing", 100, 3).count() == 0


# ---------------------------------------------------------------- the index as a data source


def _docs(spark, ids):
    return spark.createDataFrame([(str(i), '{"v": %d}' % i) for i in ids], "doc_id string, doc string")


def _visible(path):
    import glob
    import os

    return sorted(f for f in glob.glob(path.replace("file:", "") + "/**/*.txt", recursive=True)
                  if not any(p.startswith("_") for p in f.split(os.sep)))


def test_bulk_requests_through_the_sink(spark):
    from linestream.sinks import index_source as IX
    from linestream.sinks import writers as W

    root = fresh_path(spark, "bulk")
    lines = W.bulk_lines(_docs(spark, range(100))).coalesce(1)
    path = IX.bulk_write(lines, root, "i", "by-number", actions=30)
    assert [sum(1 for _ in open(f)) for f in _visible(path)] == [30, 30, 30, 10]
    path = IX.bulk_write(lines, root, "i", "by-bytes", actions=1000, bytes=300)
    files = _visible(path)
    assert len(files) > 10 and all(len(open(f).read()) - open(f).read().count("\n") <= 300 for f in files)
    path = IX.bulk_write(lines, root, "i", "by-time", actions=1000, seconds=0)
    assert len(_visible(path)) == 100  # each document comes later than no seconds


def test_a_second_run_adds_to_the_index(spark):
    from linestream.sinks import index_source as IX
    from linestream.sinks import writers as W

    root = fresh_path(spark, "adds")
    for write in (lambda d, t: W.index_write(d, root, "i", t), lambda d, t: IX.bulk_write(W.bulk_lines(d), root, "i", t)):
        for ids in (range(0, 60), range(40, 100)):
            path = write(_docs(spark, ids), "t")
        back = W.index_read(spark, path, "v: bigint")
        assert sorted(int(r._id) for r in back.collect()) == list(range(100))
        assert back.where("_id <> cast(_source.v as string)").count() == 0
    assert W.index_read(spark, path, "v: bigint", latest=False).count() == 240
    # other types stay when documents name their types
    typed = _docs(spark, range(5)).selectExpr("*", "'u' as type")
    W.index_write(typed, root, "i", None)
    W.index_write(typed.where("doc_id > '2'"), root, "i", None)
    assert W.index_read(spark, f"{root}/index=i/type=u", "v: bigint").count() == 5
    assert W.index_read(spark, path, "v: bigint").count() == 100


def test_the_latest_document_of_an_id_is_read(spark):
    import time

    from linestream.sinks import writers as W

    root = fresh_path(spark, "latest")
    for v in (1, 2):
        path = W.index_write(spark.createDataFrame([("a", '{"v": %d}' % v)], "doc_id string, doc string"), root, "i", "t")
        time.sleep(1.1)
    assert [tuple(r) for r in W.index_read(spark, path, "v: bigint").selectExpr("_id", "_source.v").collect()] == [("a", 2)]


def test_a_failed_run_leaves_nothing_visible(spark):
    from linestream.sinks import index_source as IX
    from linestream.sinks import writers as W

    root = fresh_path(spark, "fails")
    path = IX.bulk_write(W.bulk_lines(_docs(spark, range(10))), root, "i", "t")
    before = _visible(path)
    docs = _docs(spark, range(10, 2000)).repartition(4).withColumn("doc", F.when(F.col("doc_id") == "1500", F.lit("{")).otherwise(F.col("doc")))
    with pytest.raises(Exception, match="not a JSON document"):
        IX.bulk_write(W.bulk_lines(docs), root, "i", "t", actions=10)
    assert _visible(path) == before and W.index_read(spark, path, "v: bigint").count() == 10
    staged = IX.IndexWriter(IX.options(root, "i", "t", 10)).staged.replace("file:", "")  # as a driver that died leaves it
    os.makedirs(staged)
    with open(f"{staged}/part-00000-x-000000.txt", "w") as f:
        f.write('{"_id":"99","_source":{"v": 99}}\n')
    assert W.index_read(spark, path, "v: bigint").count() == 10
    with pytest.raises(Exception, match="append"):
        W.bulk_lines(_docs(spark, [1])).write.format(IX.FORMAT).options(**IX.options(root, "i", "t", 10)).mode("overwrite").save()


# ---------------------------------------------------------------- what a failure leaves behind (STR-5)


def _forget_last_commit(spark, checkpoint):
    """As if the driver had died between the sink's write and the commit of the last batch."""
    import glob
    import os

    folder = checkpoint.replace("file:", "") + "/commits"
    last = max(int(os.path.basename(f)) for f in glob.glob(folder + "/[0-9]*"))
    for f in (f"{folder}/{last}", f"{folder}/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    return last


def _records(spark, n=90):
    df = spark.createDataFrame([(i, 100 * i, "t", f"x,{100 * i}") for i in range(n)], LINES)
    return df, _stream(spark, df, F.expr("ms div 3000"))


def test_an_epoch_of_the_index_that_is_replayed_adds_nothing(spark):
    from linestream.sinks import index_source as IX
    from linestream.sinks import writers as W

    df, st = _records(spark)
    root, ckpt = fresh_path(spark, "replayed"), fresh_path(spark, "replayed-ckpt")
    docs = st.selectExpr("cast(event_id as string) as doc_id", "concat('{\"v\": ', event_id, '}') as doc")

    def run():
        RUN.run_writer(IX.bulk_stream(W.bulk_lines(docs), root, "i", "t", "s", 10), spark, "replayed", ckpt)

    run()
    path = f"{root}/index=i/type=t"
    assert W.index_read(spark, path, "v: bigint", latest=False).count() == 90
    assert _forget_last_commit(spark, ckpt) == 2
    run()
    assert W.index_read(spark, path, "v: bigint", latest=False).count() == 90


def test_a_file_sink_is_exactly_once_and_a_topic_at_least_once(spark):
    from linestream.sinks import writers as W

    df, st = _records(spark)
    out, ckpt = fresh_path(spark, "once"), fresh_path(spark, "once-ckpt")
    for _ in range(2):
        RUN.run_writer(st.writeStream.format("parquet").option("path", out), spark, "once", ckpt)
        _forget_last_commit(spark, ckpt)
    RUN.run_writer(st.writeStream.format("parquet").option("path", out), spark, "once", ckpt)
    assert spark.read.schema(df.schema).parquet(out).count() == 90

    topic, ckpt = fresh_path(spark, "topic"), fresh_path(spark, "topic-ckpt")
    fail = {"at": 1}

    def send(batch, batch_id):
        W.kafka_stand_in_write(batch, topic)
        if batch_id == fail["at"]:
            fail["at"] = None
            raise RuntimeError("died after the sink's write")

    with pytest.raises(Exception, match="died after"):
        RUN.run_writer(st.writeStream.foreachBatch(send), spark, "topic", ckpt)
    RUN.run_writer(st.writeStream.foreachBatch(send), spark, "topic", ckpt)
    back = spark.read.parquet(topic)
    assert back.select("event_id").distinct().count() == 90 and back.count() == 120  # one batch of 30 came twice


def test_bursts_go_on_after_a_failure(spark):
    """State and timers come back with the checkpoint: each burst once, with all its records."""
    gap = 1000
    df = spark.createDataFrame(_random_lines(900, topics=("a", "b", "c")), LINES)
    st = _stream(spark, df, F.expr("ms div 9000"))
    out, ckpt = fresh_path(spark, "after"), fresh_path(spark, "after-ckpt")
    for last in (False, True):
        with L.rocksdb_state(spark):
            writer = L.closed_bursts(st, gap, 700).writeStream.format("parquet").option("path", out)
            q, log = LI.logged(lambda w=writer: RUN.start(w, ckpt, 100), spark, fresh_path(spark, "after-log"))
        while q.isActive and not last and log.batches < 1:
            pass
        if not last:
            q.stop()
            LI.finish(q, log)
    LI.stop_when_idle(q, log, 12)
    got = spark.read.schema(L.BURST_SCHEMA).parquet(out)
    assert sorted(map(repr, map(tuple, got.collect()))) == _batch_bursts(df, gap)


# ---------------------------------------------------------------- segmented prefix scan (AGG-9)


@pytest.mark.parametrize("fan", [1, 3, 16, 1024])
def test_segments_in_one_pass(spark, fan):
    from linestream.operators.scan import segments

    rnd = random.Random(fan)
    want, rows = {}, []
    for g in ("a", "b", None):
        k, before, total = -40, None, 0
        for _ in range(120):
            k += rnd.choice([1, 1, 2, 5, 40])
            v = rnd.randrange(9)
            starts = before is None or k - before > 4
            total = v if starts else total + v
            rows.append((g, k, v))
            want[g, k] = (before, starts, total)
            before = k
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(5)
    got = {(r.g, r.k): (r.previous, r.starts, r.running) for r in segments(df, ["g"], "k", "v", 4, fan).collect()}
    assert got == want
    one = spark.createDataFrame([r for r in rows if r[0] == "a"], "g string, k long, v long")
    got = {r.k: (r.previous, r.starts, r.running) for r in segments(one, [], "k", "v", 4, fan).collect()}
    assert got == {k: v for (g, k), v in want.items() if g == "a"}


def test_running_count_reads_its_batches_once(spark):
    from linestream.operators.batches import running_burst_count
    from linestream.sources import tables as T

    out = running_burst_count(T.latency_lines(spark, "/root/testdata/sf0.001"), 60_000, 900_000)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # the scan, and the groups' last batches beside it; both sides of the scan's join share one exchange
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 5
    assert final.count("Scan ExistingRDD") <= 3


# ---------------------------------------------------------------- positions over micro-batches (FLT-4)


@pytest.mark.parametrize("slices", ["ms div 1000000", "ms div 7000", "ms div 900"])
def test_positions_go_on_for_any_cut_into_batches(spark, slices):
    from linestream.streaming import positions as PO

    df = spark.createDataFrame(_random_lines(400, topics=("a", "b", "c")), LINES).select("event_id", "ms", "topic")
    folder = fresh_path(spark, "nth")
    RUN.run_foreach_batch(_stream(spark, df, F.expr(slices)), "nth", PO.every_nth(3, 1000, folder))
    got = sorted((repr(r.topic), r.event_id, r.idx) for r in PO.read(spark, folder).collect())
    burst, idx, last, want = {}, {}, {}, []
    for i, ms, topic in sorted(df.collect(), key=lambda r: (r[1], r[0])):
        idx[topic] = idx[topic] + 1 if topic in last and ms - last[topic] <= 1000 else 0
        last[topic] = ms
        if idx[topic] % 3 == 0:
            want.append((repr(topic), i, idx[topic]))
    assert got == sorted(want)


def test_a_numbered_batch_that_runs_again_gives_the_same(spark):
    from linestream.streaming import positions as PO

    folder = fresh_path(spark, "nth-again")
    each = PO.every_nth(2, 100, folder)
    batches = [spark.createDataFrame([(10 * b + i, 10 * (10 * b + i), "t") for i in range(5)], "event_id long, ms long, topic string")
               for b in range(3)]
    for b in (0, 1, 1, 2, 2):
        each(batches[b], b)
    assert sorted((r.event_id, r.idx) for r in PO.read(spark, folder).collect()) == \
        [(0, 0), (2, 2), (4, 4), (11, 6), (13, 8), (20, 10), (22, 12), (24, 14)]


# ---------------------------------------------------------------- metrics ledger (SNK-6, AGG-11)


def test_an_epoch_told_twice_is_one_row_per_burst(spark):
    from linestream.sinks import writers as W

    bursts = spark.createDataFrame([("a", 100, 5, 1.5, 2.0), ("b", 90, 1, None, 0.0)],
                                   "topic string, closed_ms long, n long, rate double, avg_latency double")
    path = fresh_path(spark, "ledger")
    for query, epoch in (("q", 0), ("q", 0), ("other", 0)):  # a replay, and a second query that saw the same
        W.metrics_write(bursts, path, query, epoch)
    W.metrics_write(bursts.where("topic = 'a'").withColumn("closed_ms", F.lit(300).cast("long")), path, "q", 1)
    want = [("a", 100, 5, 1.5, 2.0), ("a", 300, 5, 1.5, 2.0), ("b", 90, 1, None, 0.0)]
    assert sorted(map(tuple, W.metrics_read(spark, path).collect())) == want
    assert W.metrics_compact(spark, path) == 3
    assert sorted(map(tuple, W.metrics_read(spark, path).collect())) == want
    W.metrics_write(bursts, path, "q", 0)  # a replay after the compaction
    assert sorted(map(tuple, W.metrics_read(spark, path).collect())) == want
    assert W.metrics_compact(spark, path) == 2 and W.metrics_read(spark, path).count() == 3
