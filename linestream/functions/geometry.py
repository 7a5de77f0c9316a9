"""Geometry as column expressions: point export and point-in-polygon.

A polygon is JSON rings, ``rings: array<array<array<double>>>`` (outer rings
and holes, each a closed list of ``[x, y]``). It is turned once per fence
into an edge list and a bounding box; the test for a point is then pure
higher-order-function code (``exists`` / ``aggregate``) that stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the spatial reference written with every point (WGS 84).
WGS84_WKID = 4326


def point_struct(lon: Column, lat: Column, wkid: int = WGS84_WKID) -> Column:
    """Point geometry as ``{x, y, spatialReference: {wkid}}``."""
    return F.struct(lon.alias("x"), lat.alias("y"),
                    F.struct(F.lit(wkid).alias("wkid")).alias("spatialReference"))


def ring_edges(rings: Column) -> Column:
    """``array<struct<x1,y1,x2,y2>>`` over all rings. The closing edge is
    included even if the ring is not explicitly closed (for a closed ring
    it is a zero-length edge, which changes neither test)."""
    def ring_to_edges(r):
        n = F.size(r)
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                r[i][0].alias("x1"), r[i][1].alias("y1"),
                r[F.pmod(i + 1, n)][0].alias("x2"), r[F.pmod(i + 1, n)][1].alias("y2")),
        )
    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), ring_to_edges))


def rings_bbox(rings: Column) -> Column:
    """``struct<minx,miny,maxx,maxy>`` of all ring points."""
    pts = F.flatten(rings)
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def on_boundary(px: Column, py: Column, edges: Column) -> Column:
    """True when the point lies exactly on one of the edges."""
    return F.exists(
        edges,
        lambda e: ((e.x2 - e.x1) * (py - e.y1) == (e.y2 - e.y1) * (px - e.x1))
        & (px >= F.least(e.x1, e.x2)) & (px <= F.greatest(e.x1, e.x2))
        & (py >= F.least(e.y1, e.y2)) & (py <= F.greatest(e.y1, e.y2)),
    )


def crossings(px: Column, py: Column, edges: Column) -> Column:
    """Number of edges a ray from the point towards +x crosses (even-odd)."""
    return F.aggregate(
        edges, F.lit(0),
        lambda acc, e: acc + F.when(
            ((e.y1 > py) != (e.y2 > py))
            & (px < e.x1 + (py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)), 1).otherwise(0),
    )


def within(px: Column, py: Column, edges: Column, bbox: Column) -> Column:
    """Point strictly inside the polygon (boundary excluded, holes honoured)."""
    in_box = (px > bbox.minx) & (px < bbox.maxx) & (py > bbox.miny) & (py < bbox.maxy)
    # cheapest test first; the edge walk for the boundary runs only for
    # points that the crossing count puts inside
    return in_box & (crossings(px, py, edges) % 2 == 1) & ~on_boundary(px, py, edges)
