"""Fences as quadtree leaves that carry only the edges near them.

A fence starts as the cells of a power-of-two grid about as large as itself
(nine at most). The cell with the most edges is cut into four along its longer
side (or across it, if that lists far fewer edges twice), and so on until all hold `MOST_EDGES` at most; so
a leaf holds a few edges whatever the fence's size, and a leaf wholly inside
holds none. A fence so ragged that cutting only repeats its edges stops at
`MOST_LISTED` listed edges per edge, which bounds the leaves by its size.
What lies beyond a leaf to its right reaches the even-odd test as one bit and
a few heights:

A ray from a point of the leaf towards +x crosses an edge to the right of the
leaf exactly if one end of the edge is above the ray and the other is not. Over
all such edges that is a sum of "this end is above the ray", in which an end
that two of them share cancels out. An end above (or below) the whole leaf
counts the same for all its points: it goes into the bit. The few ends left,
at the heights of the leaf, are kept and compared with the point. So the test
is the same comparison as over all edges, with the same result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Power of two of the smallest cells, in degrees; levels go up from it by STEP.
FINEST, STEP = -20, 2
#: A leaf with more edges is cut further, unless the fence's leaves list so many edges for each of its own.
MOST_EDGES, MOST_LISTED = 16, 8

LEAF_SCHEMA = ("lx int, ly int, cx long, cy long, name string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>, "
               "ends array<double>, bit int")


def edges_of(rings: list | None) -> np.ndarray | None:
    """(n, 4) edges x1, y1, x2, y2 of all rings, each closed; None if a place is missing or not finite."""
    parts = []
    for ring in rings or []:
        if not ring:
            continue
        if any(p is None or len(p) < 2 or p[0] is None or p[1] is None for p in ring):
            return None
        p = np.array([q[:2] for q in ring], np.float64)
        parts.append(np.hstack([p, np.roll(p, -1, axis=0)]))
    e = np.concatenate(parts) if parts else np.zeros((0, 4))
    return e[(e[:, 0] != e[:, 2]) | (e[:, 1] != e[:, 3])] if np.isfinite(e).all() else None


def level_of(side: float) -> int:
    """The level whose cells are at least as long as `side`."""
    level = math.ceil(math.log2(max(side, 2.0 ** FINEST)))
    return FINEST + -(-(level - FINEST) // STEP) * STEP


def _above(ys: np.ndarray, low: float, high: float) -> tuple[int, np.ndarray]:
    """The ends above the cell as a bit, and those at its heights that do not cancel out."""
    inside, times = np.unique(ys[(ys >= low) & (ys < high)], return_counts=True)
    return int((ys >= high).sum() & 1), inside[times % 2 == 1]


def leaves(edges: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray, np.ndarray, int]]:
    """lx, ly, cx, cy, edges, ends, bit of every leaf that is not wholly outside."""
    x1, y1, x2, y2 = edges.T
    left, right, low, high = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)
    level = level_of(max(right.max() - left.min(), high.max() - low.min()))

    def cell(lx: int, ly: int, cx: int, cy: int, near: np.ndarray, ends: np.ndarray, bit: int) -> tuple:
        """A cell from what is known of one around it: the edges near, and what lies to the right."""
        x, x_end, y, y_end = cx * 2.0 ** lx, (cx + 1) * 2.0 ** lx, cy * 2.0 ** ly, (cy + 1) * 2.0 ** ly
        beyond = near[left[near] >= x_end]
        more, ends = _above(np.concatenate([ends, y1[beyond], y2[beyond]]), y, y_end)
        own = near[(left[near] < x_end) & (right[near] >= x) & (low[near] < y_end) & (high[near] >= y)]
        return lx, ly, cx, cy, own, ends, bit ^ more

    def listed(lo: np.ndarray, hi: np.ndarray, own: np.ndarray, level: int, c: int) -> int:
        """Edges that four parts of a cell would list."""
        size = 2.0 ** (level - STEP)
        first, last = np.floor(lo[own] / size), np.floor(hi[own] / size)
        n = 1 << STEP
        return int((np.minimum(last, c * n + n - 1) - np.maximum(first, c * n) + 1).sum())

    def parts(lx: int, ly: int, cx: int, cy: int, own: np.ndarray, ends: np.ndarray, bit: int) -> list[tuple]:
        n = 1 << STEP
        by_x = listed(left, right, own, lx, cx) if lx > FINEST else math.inf
        by_y = listed(low, high, own, ly, cy) if ly > FINEST else math.inf
        # the longer side (so few pairs of levels are in use), unless that lists far more
        if by_x <= (1.5 if lx >= ly else 1 / 1.5) * by_y:
            return [cell(lx - STEP, ly, cx * n + i, cy, own, ends, bit) for i in range(n)]
        return [cell(lx, ly - STEP, cx, cy * n + i, own, ends, bit) for i in range(n)]

    everything, none, size = np.arange(len(edges)), np.zeros(0), 2.0 ** level
    heap: list[tuple] = []
    total = 0
    todo = [cell(level, level, cx, cy, everything, none, 0)
            for cx in range(math.floor(left.min() / size), math.floor(right.max() / size) + 1)
            for cy in range(math.floor(low.min() / size), math.floor(high.max() / size) + 1)]
    while todo or heap:
        for c in todo:
            lx, ly, cx, cy, own, ends, bit = c
            if len(own) > MOST_EDGES and max(lx, ly) > FINEST:
                heapq.heappush(heap, (-len(own), lx, ly, cx, cy, c))
                total += len(own)
            elif len(own) or len(ends) or bit:
                yield lx, ly, cx, cy, edges[own], ends, bit
                total += len(own)
        if not heap:
            return
        c = heapq.heappop(heap)[-1]
        if total > MOST_LISTED * len(edges) + 4 * MOST_EDGES:
            yield *c[:4], edges[c[4]], *c[5:]
            todo = []
        else:
            total -= len(c[4])
            todo = parts(*c)


def _leaf_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = LEAF_SCHEMA.split(", ")
    edge = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(edge), pa.list_(pa.float64()), pa.int32()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        lx, ly, cx, cy, name, edges, ends, bit = zip(*rows, strict=True)
        flat = np.concatenate(edges)
        offsets = pa.array(np.cumsum([0, *map(len, edges)]), pa.int32())
        listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(edge)))
        return pa.RecordBatch.from_arrays(
            [pa.array(lx, types[0]), pa.array(ly, types[1]), pa.array(cx, types[2]), pa.array(cy, types[3]), pa.array(name, types[4]), listed,
             pa.array([e.tolist() for e in ends], types[6]), pa.array(bit, types[7])], names=[f.split()[0] for f in fields])

    for batch in batches:
        held: list[tuple] = []
        for name, rings in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            edges = edges_of(rings)
            if edges is None or not len(edges):
                continue
            for lx, ly, cx, cy, own, ends, bit in leaves(edges):
                held.append((lx, ly, cx, cy, name, own, ends, bit))
                if len(held) >= 10_000:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)


def fence_leaves(fences: DataFrame) -> DataFrame:
    """The leaves of ``name, rings``, one fence a row. Fences without an edge, or
    with a missing or infinite coordinate, have none (they contain no point)."""
    return fences.select("name", "rings").mapInArrow(_leaf_batches, LEAF_SCHEMA)


def cell_of(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level)).cast("long")


def inside_leaf(px: Column, py: Column, leaf: Column) -> Column:
    """Is a point of the leaf's cell strictly inside the fence (boundary excluded, holes honoured)?"""
    crossed = F.aggregate(
        leaf["edges"], leaf["bit"],
        lambda n, e: n + F.when(((e.y1 > py) != (e.y2 > py)) & (px < e.x1 + (py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)), 1).otherwise(0))
    odd = F.aggregate(leaf["ends"], crossed, lambda n, y: n + F.when(y > py, 1).otherwise(0)) % 2 == 1
    on_edge = F.exists(
        leaf["edges"],
        lambda e: ((e.x2 - e.x1) * (py - e.y1) == (e.y2 - e.y1) * (px - e.x1))
        & (px >= F.least(e.x1, e.x2)) & (px <= F.greatest(e.x1, e.x2))
        & (py >= F.least(e.y1, e.y2)) & (py <= F.greatest(e.y1, e.y2)))
    return odd & ~on_edge
