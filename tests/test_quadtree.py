"""Quadtree leaves against the test over all edges; plans whatever the fences' sizes."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linestream.operators import geotag as G
from linestream.operators import quadtree as Q

FENCE = "pos long, name string, rings array<array<array<double>>>"


def _all_edges(px, py, edges):
    """Strictly inside by every edge of the fence."""
    inside = False
    for x1, y1, x2, y2 in edges.tolist():
        if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return False
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            inside = not inside
    return inside


def _by_leaves(px, py, index):
    for (lx, ly, cx, cy), (edges, ends, bit) in index.items():
        if (math.floor(px / 2.0 ** lx), math.floor(py / 2.0 ** ly)) == (cx, cy):
            n = bit + sum(y > py for y in ends)
            for x1, y1, x2, y2 in edges.tolist():
                if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                    return False
                n += (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)
            return n % 2 == 1
    return False


def _index(edges):
    found = [(tuple(where), (e, ends, bit)) for *where, e, ends, bit in Q.leaves(edges)]
    assert len({k for k, _ in found}) == len(found)
    return dict(found)


places = st.tuples(st.integers(-8, 8), st.integers(-8, 8))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(places, min_size=3, max_size=12), min_size=1, max_size=3), st.integers(1, 6))
def test_leaves_equal_all_edges(rings, most):
    """Rings on a small lattice: shared corners, crossings, edges along cell borders, points on boundaries."""
    edges = Q.edges_of([[[float(x), float(y)] for x, y in r] for r in rings])
    if not len(edges):
        return
    before, Q.MOST_EDGES = Q.MOST_EDGES, most
    finest, Q.FINEST = Q.FINEST, -4
    try:
        index = _index(edges)
        for x in range(-18, 19, 3):
            for y in range(-18, 19, 3):
                assert _by_leaves(x / 2, y / 2, index) == _all_edges(x / 2, y / 2, edges)
        rnd = random.Random(1)
        for _ in range(40):
            x, y = rnd.uniform(-9, 9), rnd.uniform(-9, 9)
            assert _by_leaves(x, y, index) == _all_edges(x, y, edges)
    finally:
        Q.MOST_EDGES, Q.FINEST = before, finest


def _round(n, rough, cx=3.0, cy=-7.0, seed=1):
    rnd = random.Random(seed)
    return [[cx + r * math.cos(a), cy + r * math.sin(a)] for a, r in
            ((2 * math.pi * i / n, 20 + 5 * math.sin(40 * math.pi * i / n) + rough * rnd.random()) for i in range(n))]


def _all_edges_at_once(px, py, edges):
    x1, y1, x2, y2 = edges.T
    with np.errstate(divide="ignore", invalid="ignore"):
        return int((((y1 > py) != (y2 > py)) & (px < x1 + (py - y1) * (x2 - x1) / (y2 - y1))).sum()) % 2 == 1


COAST = _round(100_000, 0.001)
COMB = [[i / 500, (i % 2) * 9.0] for i in range(99_998)] + [[200.0, -1.0], [0.0, -1.0]]
SPIKES = _round(30_000, 3.0)


@pytest.mark.parametrize("ring, few", [(COAST, True), (COMB, True), (SPIKES, False)])
def test_a_fence_of_many_edges_tests_a_few_per_point(ring, few):
    edges = Q.edges_of([ring])
    index = _index(edges)
    if few:
        assert max(len(e) for e, _, _ in index.values()) <= Q.MOST_EDGES
    assert max(len(ends) for _, ends, _ in index.values()) <= 2 * max(len(e) for e, _, _ in index.values())
    assert sum(len(e) for e, _, _ in index.values()) <= (Q.MOST_LISTED + 4) * len(edges)
    levels = {k[:2] for k in index}
    assert len(levels) <= 30
    rnd = random.Random(4)
    for _ in range(300):
        px, py = rnd.uniform(edges[:, 0].min(), edges[:, 0].max()), rnd.uniform(edges[:, 1].min(), edges[:, 1].max())
        found = [index[k] for lx, ly in levels if (k := (lx, ly, math.floor(px / 2.0 ** lx), math.floor(py / 2.0 ** ly))) in index]
        assert len(found) <= 1
        n = 0
        if found:
            own, ends, bit = found[0]
            n = bit + sum(y > py for y in ends) + sum((b > py) != (d > py) and px < a + (py - b) * (c - a) / (d - b) for a, b, c, d in own.tolist())
        assert (n % 2 == 1) == _all_edges_at_once(px, py, edges)


def _eight_sizes(spark):
    """Fences of eight sizes around one place; ragged ones of many edges among them."""
    rows = []
    for k in range(8):
        r = 4.0 ** (k - 4)
        rows.append((k, f"S{k}", [[[-r, -r], [-r, r], [r, r], [r, -r], [-r, -r]]]))
    rows.append((8, "ragged", [_round(5000, 0.01)]))
    return spark.createDataFrame(rows, FENCE), rows


@pytest.mark.parametrize("shuffled", [False, True])
def test_fences_of_all_sizes_against_all_edges(spark, monkeypatch, shuffled):
    if shuffled:
        import linestream.operators.sizing as S
        monkeypatch.setattr(S, "DEFAULT_MAX_BROADCAST_UNITS", 0)
    rnd = random.Random(9)
    pts = [(i, rnd.choice([1, 8, 60]) * rnd.uniform(-1, 1), rnd.choice([1, 8, 60]) * rnd.uniform(-1, 1)) for i in range(400)]
    pts += [(400, 1.0, 0.5), (401, 0.0, 0.0), (402, None, 1.0), (403, 1.0, None), (404, 0.25, -0.25), (405, float("nan"), 1.0)]
    pts += [(500 + i, 0.1, 0.1) for i in range(200)]  # many at one place
    fences, rows = _eight_sizes(spark)
    edges = {name: Q.edges_of(rings) for _, name, rings in rows}
    df = spark.createDataFrame(pts, "event_id long, lon double, lat double")
    want = {i: sorted(n for n, e in edges.items() if x is not None and y is not None and x == x and _all_edges(x, y, e)) for i, x, y in pts}
    got = {r.event_id: r.geotag for r in G.geotag(df, fences).collect()}
    assert got == {i: ",".join(n) for i, n in want.items()}
    pairs = sorted((r.event_id, r.name) for r in G.point_in_fence_pairs(df, fences, ["event_id"]).collect())
    assert pairs == sorted((i, n) for i, names in want.items() for n in names)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shuffled", [False, True])
def test_one_scan_and_one_join_for_eight_sizes(spark, monkeypatch, tmp_path, shuffled):
    if shuffled:
        import linestream.operators.sizing as S
        monkeypatch.setattr(S, "DEFAULT_MAX_BROADCAST_UNITS", 0)
    df = spark.range(1000).selectExpr("id as event_id", "id / 100D as lon", "id / 70D as lat")
    df.write.parquet(str(tmp_path / "pts"))
    pts = spark.read.parquet(str(tmp_path / "pts"))
    fences, _ = _eight_sizes(spark)
    pairs = _plan(G.point_in_fence_pairs(pts, fences, ["event_id"]))
    assert pairs.count("FileScan parquet") == 1
    assert pairs.count("Join") == 1 and pairs.count("Exchange hashpartitioning") <= 2
    tags = _plan(G.geotag(pts, fences))
    if shuffled:
        # points to cells, leaves to cells, names to places, points to places
        assert tags.count("Exchange hashpartitioning") <= 4 and tags.count("Join") == 2
    else:
        assert tags.count("FileScan parquet") == 1 and tags.count("Exchange hashpartitioning") == 0


def test_fences_without_a_place(spark):
    rows = [(0, "empty", []), (1, "none", None), (2, "null point", [[[0.0, None], [1.0, 1.0], [2.0, 0.0]]]), (3, "point", [[[1.0, 1.0]]]),
            (4, "infinite", [[[0.0, 0.0], [float("inf"), 1.0], [2.0, 0.0]]]), (5, "good", [[[0.0, 0.0], [0.0, 2.0], [2.0, 2.0], [2.0, 0.0]]])]
    pts = spark.createDataFrame([(1, 1.0, 1.5), (2, 1.0, 1.0), (3, 5.0, 5.0)], "event_id long, lon double, lat double")
    got = {r.event_id: r.geotag for r in G.geotag(pts, spark.createDataFrame(rows, FENCE)).collect()}
    assert got == {1: "good", 2: "good", 3: ""}
    none = spark.createDataFrame(rows[:2], FENCE)
    assert {r.geotag for r in G.geotag(pts, none).collect()} == {""} and G.point_in_fence_pairs(pts, none, ["event_id"]).count() == 0
