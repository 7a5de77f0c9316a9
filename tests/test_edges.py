"""Hand-written edge tables (FIXTURES.md §4) and brute-force checks."""

import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from linestream.functions import text as X
from linestream.operators import bursts as B
from linestream.operators import geotag as G
from linestream.operators import parse as P
from linestream.operators import batches as BA
from linestream.operators.sequence import slice_of, with_sequence
from linestream.sinks import writers as W
from linestream.session import fresh_path

TOKEN_CASES = [
    ("a,b,c", ["a", "b", "c"]),
    ("a,,b", ["a", ",b"]),
    (",x", [",x"]),
    ("a,", ["a"]),
    ("a,,", ["a", ","]),
    ('x,"p,q",y', ["x", "p,q", "y"]),
    ('""', [""]),
    ('"abc', ["abc"]),
    ('"a""b"', ["a", "b"]),
    (' "x,y",z', [' "x', 'y"', "z"]),
    ('"abc"def,g', ["abc", "def", "g"]),
    ("", []),
]


def test_tokenizer_edge_table(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(TOKEN_CASES)], "i int, value string")
    got = {r.i: r.t for r in df.select("i", X.tokenize(F.col("value")).alias("t")).collect()}
    for i, (_, want) in enumerate(TOKEN_CASES):
        assert got[i] == want, TOKEN_CASES[i]


def test_strict_integers(spark):
    df = spark.createDataFrame([(" 12 ",), ("+5",), ("-7",), ("1.0",), ("99999999999",), ("",)], "s string")
    rows = df.select(X.strict_long("s").alias("l"), X.strict_int("s").alias("i")).collect()
    assert [r.l for r in rows] == [None, 5, -7, None, 99999999999, None]
    assert [r.i for r in rows] == [None, 5, -7, None, None, None]


def test_doubles(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("1e400",), ("1.",), ("-0.5",), ("x",)], "s string")
    got = [r.d for r in df.select(X.to_double("s").alias("d")).collect()]
    assert math.isnan(got[0]) and got[1] == math.inf and got[2] == math.inf
    assert got[3:] == [1.0, -0.5, None]


def test_non_finite_is_an_error(spark):
    line = "1,2,d,r,NaN,1.0,3.0,4.0"
    df = spark.createDataFrame([(1, line)], "event_id long, value string")
    assert P.simfile_typed(df).first().error == "non_finite"


def test_date_marker_parity(spark):
    df = spark.createDataFrame([("06/22/2013 12:02:00 AM",), ("06/22/2013 03:00:00 PM",),
                                ("13/22/2013 03:00:00 PM",), ("not-a-date",)], "s string")
    got = [r.ms for r in df.select(P.parse_mdy_ms(F.col("s")).alias("ms")).collect()]
    assert got[0] == 1371902520000  # 2013-06-22 12:02:00 UTC, marker ignored
    assert got[1] == 1371870000000  # 2013-06-22 03:00:00 UTC
    assert got[2] is None and got[3] is None
    honest = df.select(P.parse_mdy_ms(F.col("s"), honor_marker=True).alias("ms")).collect()
    assert honest[0].ms == 1371859320000 and honest[1].ms == 1371913200000


def test_gap_boundary(spark):
    df = spark.createDataFrame([(1, 0, "t"), (2, 5000, "t"), (3, 10001, "t")], "event_id long, ms long, topic string")
    got = sorted((r.start_ms, r.n) for r in B.bursts(df, 5000).collect())
    assert got == [(0, 2), (10001, 1)]


def test_burst_spanning_buckets_and_rates(spark):
    rows = [(i, ms, "t") for i, ms in enumerate([4999, 5000, 9999, 14998, 30000])]
    df = spark.createDataFrame(rows, "event_id long, ms long, topic string")
    got = sorted((r.start_ms, r.end_ms, r.n, r.rate) for r in B.burst_rates(df, 5000).collect())
    assert got == [(4999, 14998, 4, 1000.0 * 4 / 9999), (30000, 30000, 1, None)]


def test_latency_prefix(spark):
    # send times: ms - 10 except the third line, which is bad; the fifth is
    # good again but comes after the first bad line of its burst
    vals = ["a,990", "a,1990", "a,oops", "a,3990", "a,4990", "a,99990"]
    ms = [1000, 2000, 3000, 4000, 5000, 100000]
    df = spark.createDataFrame([(i, m, "t", v) for i, (m, v) in enumerate(zip(ms, vals))],
                               "event_id long, ms long, topic string, value string")
    got = sorted((r.start_ms, r.n, r.valid_n, r.avg_latency) for r in B.burst_latency(df, 5000).collect())
    assert got == [(1000, 5, 2, 20.0 / 5), (100000, 1, 1, 10.0)]


def test_every_nth_restarts_per_burst(spark):
    ms = [0, 1, 2, 3, 4, 100000, 100001, 100002, 100003]
    df = spark.createDataFrame([(i, m, "t") for i, m in enumerate(ms)], "event_id long, ms long, topic string")
    got = sorted(r.event_id for r in B.every_nth(df, 3, 5000).collect())
    assert got == [0, 3, 5, 8]


def test_sequence_is_exact_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [(("hot" if i % 3 == 0 else f"g{i % 11}"), rnd.randrange(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, id long")
    got = with_sequence(df, ["k", "id"], "pos", group_cols=["g"], slices=16).collect()
    want = {}
    for g in set(r[0] for r in rows):
        for p, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            want[r[2]] = p
    assert {r.id: r.pos for r in got} == want


def test_runs_report_what_an_empty_batch_has_ended(spark):
    ws = [1, 2, 3, 7, 8, 10, 20, 21]
    df = spark.createDataFrame([(w * 10 + 3,) for w in ws], "ms long")
    got = sorted((r.start_ms // 10, r.end_ms // 10 - 1, r.n) for r in BA.run_stats(df, 10).collect())
    assert got == [(1, 3, 3), (7, 8, 2), (10, 10, 1)]  # the last run is still open
    assert len(BA.microbatch_burst(df, 10).collect()) == 3


def test_running_count_goes_back_to_zero(spark):
    # batches of 10 ms, gap 20: after a batch that ends at t the reset comes at t + 30, if nothing came before
    df = spark.createDataFrame([(m, "t") for m in (5, 6, 15, 95, 96, 105, 135)], "ms long, topic string")
    got = sorted((r.batch_ms, r.n, r.running_n) for r in BA.running_burst_count(df, 10, 20).collect())
    assert got == [(10, 2, 2), (20, 1, 3), (50, 0, 0), (100, 2, 2), (110, 1, 3), (140, 1, 1)]
    far = spark.createDataFrame([(5, "t"), (1000, "u")], "ms long, topic string")
    got = sorted((r.topic, r.batch_ms, r.running_n) for r in BA.running_burst_count(far, 10, 20).collect())
    assert got == [("t", 10, 1), ("t", 40, 0), ("u", 1010, 1)]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 50])
def test_slice_of_counts_the_bounds(spark, n):
    bounds = [10 * i for i in range(n)]
    got = spark.range(-15, 10 * n + 15).select("id", slice_of(F.col("id"), bounds).alias("s")).collect()
    assert all(r.s == sum(b <= r.id for b in bounds) for r in got)


@pytest.mark.parametrize("fan", [1, 3, 1000])
def test_running_values_in_two_levels(spark, fan):
    from linestream.operators import running as RU

    rnd = random.Random(fan)
    rows = [(g, k, rnd.randrange(100)) for g in "ab" for k in sorted(rnd.sample(range(-50, 200), 40))]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    out = RU.previous(df, ["g"], "k", "v", "p", fan)
    out = RU.running_sum(out, ["g"], "k", F.col("v"), "s", fan)
    out = RU.running_max(out, ["g"], "k", F.when(F.col("v") > 50, F.col("v")), "m", fan)
    got = {(r.g, r.k): (r.p, r.s, r.m) for r in out.collect()}
    for g in "ab":
        before, total, top = None, 0, None
        for _, k, v in (r for r in rows if r[0] == g):
            total += v
            top = max(top or v, v) if v > 50 else top
            assert got[g, k] == (before, total, top)
            before = v


def _square(x0, y0, x1, y1, reverse=False):
    pts = [[x0, y0], [x0, y1], [x1, y1], [x1, y0]]
    if reverse:
        pts = pts[::-1]
    return pts + [pts[0]]


FENCES = [
    (0, "A", [_square(0, 0, 10, 10), _square(4, 4, 6, 6, reverse=True)]),  # with a hole
    (1, "B", [_square(5, 5, 15, 15)]),
    # concave L: (20,0)-(30,0)-(30,4)-(24,4)-(24,10)-(20,10)
    (2, "C", [[[20, 0], [30, 0], [30, 4], [24, 4], [24, 10], [20, 10], [20, 0]]]),
]


def _fences(spark, fences=FENCES):
    return spark.createDataFrame([(p, n, [[[float(c) for c in pt] for pt in r] for r in rings])
                                  for p, n, rings in fences],
                                 "pos long, name string, rings array<array<array<double>>>")


def test_geometry_edge_cases(spark):
    pts = [(1, 0.0, 5.0), (2, 0.0, 0.0), (3, 5.0, 5.0), (11, 5.5, 5.5), (4, 2.0, 2.0), (5, 8.0, 8.0),
           (6, 50.0, 50.0), (7, 27.0, 7.0), (8, 22.0, 7.0), (9, 12.0, 12.0), (10, 24.0, 6.0)]
    df = spark.createDataFrame(pts, "event_id long, lon double, lat double")
    got = {r.event_id: r.geotag for r in G.geotag(df, _fences(spark)).collect()}
    assert got == {1: "", 2: "", 3: "", 11: "B", 4: "A", 5: "A,B", 6: "", 7: "", 8: "C", 9: "B", 10: ""}


def test_duplicate_names_last_wins(spark):
    fences = FENCES + [(3, "A", [_square(100, 100, 110, 110)])]
    d = {r.name: r.pos for r in G.dedupe_fences(_fences(spark, fences)).collect()}
    assert d == {"A": 3, "B": 1, "C": 2}


def test_known_areas(spark):
    """The share of a fine lattice inside a polygon is its area, known beforehand."""
    polygons = [("square", [_square(0, 0, 10, 10)], 100.0), ("hole", [_square(0, 0, 10, 10), _square(2, 2, 5, 6, reverse=True)], 88.0),
                ("L", [[[0, 0], [10, 0], [10, 4], [4, 4], [4, 10], [0, 10], [0, 0]]], 64.0),
                ("triangle", [[[0, 0], [10, 0], [0, 10], [0, 0]]], 50.0), ("diamond", [[[5, 0], [10, 5], [5, 10], [0, 5], [5, 0]]], 50.0)]
    grid = spark.range(400).select("id", (F.col("id") % 20 * 0.5 + 0.2501).alias("lon"),
                                   (F.floor(F.col("id") / 20) * 0.5 + 0.2499).alias("lat"))
    fences = _fences(spark, [(i, n, r) for i, (n, r, _) in enumerate(polygons)])
    pairs = G.point_in_fence_pairs(grid, fences, ["id"], row_key="id").groupBy("name").count().collect()
    got = {r["name"]: r["count"] / 4 for r in pairs}
    for name, _, area in polygons:
        assert abs(got[name] - area) <= 2.6, name  # the slanted sides' lattice points


def _inside(px, py, rings):
    """Winding number (brute force, points on no boundary)."""
    turns = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            side = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
            if y1 <= py < y2 and side > 0:
                turns += 1
            elif y2 <= py < y1 and side < 0:
                turns -= 1
    return turns != 0


def test_fence_sizes_do_not_blow_up_the_cells(spark):
    fences = [(k, f"F{k}", [_square(k, k / 2, k + 0.01, k / 2 + 0.01)]) for k in range(99)]
    fences.append((99, "world", [_square(-180, -90, 180, 90)]))
    prepared = G.prepare(_fences(spark, fences))
    assert G.fence_cells(prepared).count() <= 9 * 100
    pts = spark.createDataFrame([(1, 3.005, 1.505), (2, 3.02, 1.505), (3, 98.005, 49.005)], "event_id long, lon double, lat double")
    got = {r.event_id: r.geotag for r in G.geotag(pts, _fences(spark, fences)).collect()}
    assert got == {1: "F3,world", 2: "world", 3: "F98,world"}


def test_one_name_twice_gives_one_tag(spark):
    fences = [(0, "A", [_square(0, 0, 10, 10)]), (1, "A", [_square(5, 5, 20, 20)])]
    pts = spark.createDataFrame([(1, 6.0, 6.0), (2, 1.0, 1.0)], "event_id long, lon double, lat double")
    assert {r.event_id: r.geotag for r in G.geotag(pts, _fences(spark, fences)).collect()} == {1: "A", 2: ""}


def test_last_wins_across_files_of_any_size(spark):
    from linestream.sources import fences as FS

    path = fresh_path(spark, "two-files")
    many = [(k, "A" if k == 0 else f"N{k}", [_square(0, 0, 1, 1)]) for k in range(3)]
    later = [(100, "A", [_square(2, 2, 3, 3)])] + [(101 + k, f"M{k}", [_square(0, 0, 1, 1)] * 20) for k in range(30)]
    FS.write_fence_lines(_fences(spark, many).coalesce(1), path + "/a")
    FS.write_fence_lines(_fences(spark, later).coalesce(1), path + "/b")
    good, bad = G.load_fences(spark, [path + "/a", path + "/b"], FS.FIELD_NAME, multiline=False)
    assert {r.name: r.pos for r in G.dedupe_fences(good).collect()}["A"] == 100 and bad.count() == 0


@pytest.mark.parametrize("salted", [False, True])
def test_random_points_against_brute_force(spark, monkeypatch, salted):
    rnd = random.Random(11)
    fences = []
    for k in range(12):
        cx, cy, r = rnd.uniform(-50, 50), rnd.uniform(-50, 50), rnd.uniform(2, 25)
        n = rnd.randrange(3, 9)
        ring = [[round(cx + r * math.cos(2 * math.pi * i / n), 3), round(cy + r * math.sin(2 * math.pi * i / n), 3)]
                for i in range(n)]
        fences.append((k, f"F{k:02d}", [ring + [ring[0]]]))
    pts = [(i, round(rnd.uniform(-80, 80), 2), round(rnd.uniform(-80, 80), 2)) for i in range(3000)]
    if salted:  # force the shuffle (non-broadcast) path
        import linestream.operators.sizing as S
        monkeypatch.setattr(S, "DEFAULT_MAX_BROADCAST_UNITS", 0)
    df = spark.createDataFrame(pts, "event_id long, lon double, lat double")
    got = {r.event_id: r.geotag for r in G.geotag(df, _fences(spark, fences), salt=4).collect()}
    pairs = {(r.event_id, r.name) for r in G.point_in_fence_pairs(df, _fences(spark, fences), ["event_id"]).collect()}
    want_pairs = {(i, name) for i, x, y in pts for _, name, rings in fences if _inside(x, y, rings[0:1])}
    want = {i: ",".join(sorted(n for j, n in want_pairs if j == i)) for i, _, _ in pts}
    assert got == want
    assert pairs == want_pairs


def test_a_second_run_replaces_the_first(spark):
    docs = spark.range(1234).select(F.col("id").cast("string").alias("doc_id"),
                                    F.to_json(F.struct(F.col("id").alias("v"))).alias("doc")).repartition(3)
    root = fresh_path(spark, "bulk-test")
    for _ in range(2):
        path = W.index_write(docs, root, "i", "t")
    assert len(glob.glob(path.replace("file:", "") + "/*.txt")) <= 3
    back = W.index_read(spark, path, "v: bigint")
    assert back.count() == back.select("_id").distinct().count() == 1234
    assert back.where(F.col("_id") == F.col("_source.v").cast("string")).count() == 1234
    for _ in range(2):  # a micro-batch that runs again
        W.index_write(docs, root, "i", "mb", batch_id=7)
    assert W.index_read(spark, f"{root}/index=i/type=mb", "v: bigint").count() == 1234


def test_a_document_that_is_no_json_fails_the_batch(spark):
    docs = spark.createDataFrame([("1", '{"v": 1}'), ("2", '{"v": ')], "doc_id string, doc string")
    with pytest.raises(Exception, match="not a JSON document"):
        W.index_write(docs, fresh_path(spark, "bad-json"), "i", "t")


def test_bulk_requests_end_by_number_bytes_and_time():
    now = iter(range(0, 1000)).__next__
    assert [len(x) for x in W.bulk_requests(map(str, range(10)), 4, clock=lambda: 0)] == [4, 4, 2]
    assert [len(x) for x in W.bulk_requests(["x" * 40] * 5, 100, most_bytes=100, clock=lambda: 0)] == [2, 2, 1]
    assert [len(x) for x in W.bulk_requests(["x"] * 12, 100, most_seconds=3, clock=now)] == [3, 3, 3, 3]
    assert list(W.bulk_requests([], 5)) == []


def test_filters_on_kept_columns_reach_the_scan(spark):
    from linestream.operators import parse as P
    from linestream.sources import tables as T

    lines = T.simfile_lines(spark, "/root/testdata/sf0.001")
    out = P.simfile_typed(lines, keep=["event_id", "topic"]).where("topic = 'click' and event_id < 100 and error is null")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(event_id,100)" in plan and "EqualTo(event_type,click)" in plan
    assert plan.count("Generate inline") == 1


def _scans(spark, fn):
    """Scans of the raw table in the plans that run: those written by checkpoint() and the last."""
    seen = []
    original = type(spark.range(0)).checkpoint

    def counted(self, *a, **k):
        seen.append(self._jdf.queryExecution().optimizedPlan().toString().count("parquet"))
        return original(self, *a, **k)

    type(spark.range(0)).checkpoint = counted
    try:
        out = fn()
        seen.append(out._jdf.queryExecution().optimizedPlan().toString().count("parquet"))
    finally:
        type(spark.range(0)).checkpoint = original
    return sum(seen)


@pytest.mark.parametrize("name, most", [("burst_count", 1), ("burst_rate", 1), ("burst_latency", 2), ("every_nth", 2),
                                        ("run_stats", 1), ("microbatch_burst", 1), ("running_burst_count", 1)])
def test_raw_rows_are_scanned_at_most(spark, name, most):
    from linestream.plans.catalog import QUERIES

    assert 1 <= _scans(spark, lambda: QUERIES[name](spark, "/root/testdata/sf0.001")) <= most


def test_positions_in_a_hot_cell(spark):
    rows = [(i, 1000, "t") for i in range(500)] + [(500 + i, 1000 + i, "t") for i in range(500)] + [(2000, 90_000, "t")]
    df = spark.createDataFrame(rows, "event_id long, ms long, topic string")
    for heavy in (10**6, 37):
        got = {r.event_id: r.idx for r in B.burst_positions(df, 6400, heavy=heavy).collect()}
        order = sorted(rows[:1000], key=lambda r: (r[1], r[0]))
        assert got == {r[0]: i for i, r in enumerate(order)} | {2000: 0}


def test_only_closed_bursts(spark):
    df = spark.createDataFrame([(1, 0, "t"), (2, 100, "t"), (3, 6000, "u")], "event_id long, ms long, topic string")
    got = B.closed(B.bursts(df, 5000), 5000, F.lit(6000)).collect()
    assert [(r.topic, r.closed_ms) for r in got] == [("t", 5100)]


def test_no_local_folder_on_a_cluster(spark):
    from linestream import session as SE

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SE.shared_dir(Session())


def _streamed(spark, ms, plan):
    from linestream.streaming import runner as RUN

    df = spark.createDataFrame([(i, m, "t", f"x,{m - 5}") for i, m in enumerate(ms)], "event_id long, ms long, topic string, value string")
    path, each = RUN.write_stream_files(df, "ms", 3)
    return df, plan(RUN.file_stream(spark, path, df.schema, each))


def test_stream_keeps_milliseconds_and_shuffled_rows(spark):
    from linestream.streaming import runner as RUN
    from linestream.streaming import streams as S

    ms = [0, 2300, 4600, 100_000, 200_000]
    rnd = random.Random(5)
    for gap, arrivals in ((2500, ms), (2500, rnd.sample(ms, 5)), (5000, [0, 5000, 10_001, 50_000])):
        df, st = _streamed(spark, arrivals, lambda s: S.stream_bursts(s, gap, "0 seconds"))
        got = sorted(map(tuple, RUN.run_to_files(st, "t").collect()))
        want = B.closed(B.bursts(df, gap), gap, F.lit(max(arrivals))).drop("closed_ms")
        assert got == sorted(map(tuple, want.collect()))
    df, st = _streamed(spark, [5, 99, 100, 250, 1000], lambda s: S.stream_batch_stats(s, 100, "0 seconds"))
    got = sorted(map(tuple, RUN.run_to_files(st, "t").collect()))
    assert got == [(0, 100, 2, 20.0), (100, 200, 1, 10.0), (200, 300, 1, 10.0)]


def test_late_rows_are_reported(spark):
    from linestream.streaming import runner as RUN
    from linestream.streaming import streams as S

    path = fresh_path(spark, "late")
    for i, ms in enumerate([[0, 1000], [50_000], [100_000], [10], [200_000]]):
        df = spark.createDataFrame([(m, "t") for m in ms], "ms long, topic string")
        df.coalesce(1).write.mode("append").parquet(path)
    st = S.stream_bursts(RUN.file_stream(spark, path, df.schema, 1), 500, "0 seconds")
    with pytest.warns(UserWarning, match="1 rows came later"):
        RUN.run_to_files(st, "late")


def test_a_run_at_an_interval_and_its_progress(spark):
    import time

    from linestream.streaming import runner as RUN
    from linestream.streaming import streams as S

    lines = spark.createDataFrame([(i, 10 * i, "t", f"a,{10 * i - 3}") for i in range(30)],
                                  "event_id long, ms long, topic string, value string")
    path, each = RUN.write_stream_files(lines, "ms", 3)
    store = fresh_path(spark, "interval")
    q = RUN.start(RUN.file_stream(spark, path, lines.schema, each).writeStream.foreachBatch(S.keep_lines(store)),
                  store + "-ckpt", interval_ms=100)
    end = time.time() + 60
    while sum(p[1] for p in RUN.progress(q)) < 30 and time.time() < end:
        time.sleep(0.2)
    seen = RUN.progress(q)
    q.stop()
    assert sum(p[1] for p in seen) == 30 and len(seen) >= 2
    assert S.closed_burst_latency(spark, store, 10_000).count() == 0  # still open


def test_fence_lines_round_trip(spark):
    from linestream.sources import fences as FS
    path = FS.write_fence_lines(_fences(spark), fresh_path(spark, "fence-lines"))
    good, bad = G.load_fences(spark, path, FS.FIELD_NAME, multiline=False)
    assert sorted(r.name for r in good.collect()) == ["A", "B", "C"] and bad.count() == 0


def test_geotag_transform_with_its_settings(spark):
    from linestream.operators import registry as R
    from linestream.sources import fences as FS

    lines = spark.createDataFrame([(1, "1,2,d,r,6.5,6.5,1.0,2.0"), (2, "1,2,d,r,50.0,50.0,1.0,2.0"), (3, "bad")], "event_id long, value string")
    document = FS.write_fence_document(_fences(spark), fresh_path(spark, "doc"))
    by_line = FS.write_fence_lines(_fences(spark), fresh_path(spark, "lines"))
    want = {r.event_id: r.value for r in R.apply("GeoTag", lines, fences=_fences(spark)).collect()}
    assert '"geotag":"A,B"' in want[1] and want[2] == "" and "error" in want[3]
    for settings in ({"fence_path": document}, {"fence_path": by_line, "multiline": False}):
        out = R.apply("geotag", lines, field_name=FS.FIELD_NAME, **settings)
        assert {r.event_id: r.value for r in out.collect()} == want
    kept = R.apply("geotag", lines, fences=_fences(spark), filter=False).where("event_id = 2").first().value
    assert '"geotag":""' in kept
    with pytest.raises(ValueError, match="fence_path"):
        R.apply("geotag", lines)


def test_bursts_across_super_buckets(spark):
    # gap 10: buckets of width 10; fan 4 puts 4 buckets in a super-bucket, so
    # bursts cross super-buckets and some super-buckets hold no start
    ms = [0, 9, 18, 27, 36, 45, 54, 63, 72, 200, 205, 300]
    df = spark.createDataFrame([(i, m, "t") for i, m in enumerate(ms)], "event_id long, ms long, topic string")
    from linestream.operators import running as RU
    RU_fan = RU.running_max.__defaults__
    RU.running_max.__defaults__ = (4,)
    try:
        bb = B.burst_buckets(df, 10)
    finally:
        RU.running_max.__defaults__ = RU_fan
    got = sorted((r.bucket, r.burst) for r in bb.collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0), (20, 20), (30, 30)]
