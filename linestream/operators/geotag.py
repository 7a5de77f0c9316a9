"""Point-in-fence join (JOIN-1, JOIN-2, AGG-5, FLT-2) as an equi-join on quadtree cells.

The original tests every point against every fence. Here each fence is cut
once into quadtree leaves (`quadtree`): a leaf carries the few edges near it,
so a fence of 100,000 edges tests a few of them per point. Leaves lie on a
handful of grid levels; a point falls in one cell of each level in use.

* ``point_in_fence_pairs`` lists a point's cells of all levels once and joins
  them with the leaves: one scan, one join, whatever the number of levels.
* ``geotag`` with leaves small enough to broadcast (their size, in edges and
  name characters, is counted first) groups the leaves of a cell into one
  array and looks a point up once per level: left joins without a shuffle or
  an aggregation over points, so the same plan is stateless on a stream.
* Beyond the bound, ``geotag`` sends only the coordinates to the cells of all
  levels (one join), groups the names by coordinate, and joins the points
  with that: the points are read twice and their side is exchanged three
  times, whatever the number of levels.
* A hot cell of a shuffled join is spread over ``salt`` tasks, and AQE splits
  what is still too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quadtree import cell_of, fence_leaves, inside_leaf
from .sizing import checked_broadcast, materialize

FEATURE_SCHEMA = ("pos long, geometry struct<rings: array<array<array<double>>>>, "
                  "attributes map<string, string>")
FENCE_SCHEMA = ("features array<struct<geometry: struct<rings: array<array<array<double>>>>, "
                "attributes: map<string, string>>>")


def load_fences(spark, path: str, field_name: str, multiline: bool = True):
    """SRC-6: read a fence document ``{"features": [...]}`` (or, with
    ``multiline=False``, one feature object per line, which splits across
    tasks and carries its ``pos``: the form for large sets; a document is read
    by one task). Returns ``(fences, errors)``: ``pos, name, rings`` for good
    features and ``pos, error`` for features without polygon, name or place."""
    if multiline:
        doc = spark.read.option("multiLine", True).schema(FENCE_SCHEMA).json(path)
        feats = doc.select(F.posexplode("features").alias("pos", "f"))
    else:
        # the order of the features across files is what they carry as `pos`
        feats = spark.read.schema(FEATURE_SCHEMA).json(path).select("pos", F.struct("geometry", "attributes").alias("f"))
    named = feats.select(F.col("pos").cast("long").alias("pos"), F.col("f.attributes").getItem(field_name).alias("name"),
                         F.col("f.geometry.rings").alias("rings"))
    bad = (F.col("rings").isNull() | (F.size("rings") == 0))
    err = F.when(bad, F.lit("no_polygon")).when(F.col("name").isNull(), F.lit("no_name")) \
        .when(F.col("pos").isNull(), F.lit("no_pos"))
    tagged = named.withColumn("error", err)
    return (tagged.where("error is null").drop("error"),
            tagged.where("error is not null").select("pos", "error"))


def dedupe_fences(fences: DataFrame) -> DataFrame:
    """JOIN-2: one fence per name; the last one in document order wins."""
    return (fences.groupBy("name")
            .agg(F.max_by(F.struct("pos", "rings"), F.col("pos")).alias("w"))
            .select(F.col("w.pos").alias("pos"), "name", F.col("w.rings").alias("rings")))


def prepare(fences: DataFrame) -> DataFrame:
    """``name, rings``: of fences with one name only the last counts (JOIN-2)."""
    return dedupe_fences(fences).select("name", "rings")


def fence_cells(prepared: DataFrame) -> DataFrame:
    """The quadtree leaves ``lx, ly, cx, cy, name, edges, ends, bit``; at most nine for a small fence."""
    return fence_leaves(prepared)


def _weight() -> Column:
    """The size of a leaf, for the broadcast's check: its edges, and the characters of its name."""
    return F.size("edges") + F.size("ends") + F.length("name") + 1


def _levels(cells: DataFrame) -> list[tuple[int, int]]:
    """The grid levels (of x and y) in use: a few for small fences, two for each cut of a large one."""
    return sorted(tuple(r) for r in cells.select("lx", "ly").distinct().collect())


def _cells_of_points(points: DataFrame, levels: list[tuple[int, int]], lon: str, lat: str) -> DataFrame:
    """A row for each level: the cell the point is in."""
    keys = F.array(*[F.struct(F.lit(lx).alias("lx"), F.lit(ly).alias("ly"), cell_of(F.col(lon), F.lit(lx)).alias("cx"),
                              cell_of(F.col(lat), F.lit(ly)).alias("cy")) for lx, ly in levels])
    return points.select("*", F.inline(keys))


def _meet(points: DataFrame, cells: DataFrame, small: bool, salt: int) -> DataFrame:
    """Join points (with their cells) and leaves; a shuffled hot cell goes to ``salt`` tasks."""
    keys = ["lx", "ly", "cx", "cy"]
    if small:
        return points.join(F.broadcast(cells), keys)
    if salt > 1:
        points = points.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in points.columns if c not in keys]), F.lit(salt)))
        cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys = [*keys, "_salt"]
    return points.join(cells, keys)


def _in_leaf(x: str, y: str) -> Column:
    return inside_leaf(F.col(x), F.col(y), F.struct("edges", "ends", "bit"))


def _is_place(x: Column, y: Column) -> Column:
    return x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)


def geotag(points: DataFrame, fences: DataFrame, lon: str = "lon", lat: str = "lat",
           salt: int = 16, row_key: str = "event_id") -> DataFrame:
    """AGG-5: add ``geotag``: comma-joined names (sorted) of the fences that
    strictly contain the point; ``""`` when none (or a coordinate is missing)."""
    cells, small = checked_broadcast(fence_cells(prepare(fences)), weight=_weight())
    levels = _levels(cells)
    if not levels:
        return points.withColumn("geotag", F.lit(""))
    if small or points.isStreaming:
        return _tag_by_level(points, cells, small, levels, lon, lat, salt, row_key)
    places = points.select(F.col(lon).alias("_x"), F.col(lat).alias("_y")).where(_is_place(F.col("_x"), F.col("_y")))
    met = _meet(_cells_of_points(places, levels, "_x", "_y"), cells, False, salt)
    names = met.where(_in_leaf("_x", "_y")).groupBy("_x", "_y").agg(F.collect_set("name").alias("_names"))
    out = points.join(names, (F.col(lon) == F.col("_x")) & (F.col(lat) == F.col("_y")), "left")
    found = F.coalesce(F.col("_names"), F.array().cast("array<string>"))
    return out.withColumn("geotag", F.array_join(F.array_sort(found), ",")).drop("_x", "_y", "_names")


def _tag_by_level(points: DataFrame, cells: DataFrame, small: bool, levels: list[tuple[int, int]], lon: str, lat: str, salt: int,
                  row_key: str) -> DataFrame:
    px, py = F.col(lon), F.col(lat)
    side = cells.groupBy("lx", "ly", "cx", "cy").agg(F.collect_list(F.struct("name", "edges", "ends", "bit")).alias("_fences"))
    side = materialize(side)
    names, out = [], points
    for lx, ly in levels:
        keys, own = ["_cx", "_cy"], side.where((F.col("lx") == lx) & (F.col("ly") == ly)).select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "_fences")
        out = out.withColumn("_cx", F.when(_is_place(px, py), cell_of(px, F.lit(lx)))).withColumn("_cy", cell_of(py, F.lit(ly)))
        if small:
            own = F.broadcast(own)
        elif salt > 1:
            out = out.withColumn("_salt", F.pmod(F.xxhash64(F.col(row_key)), F.lit(salt)))
            own = own.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
            keys = [*keys, "_salt"]
        out = out.join(own, keys, "left").drop(*keys)
        hits = F.filter(F.coalesce(F.col("_fences"), F.array()), lambda f: inside_leaf(px, py, f))
        names.append(f"_names{len(names)}")
        out = out.withColumn(names[-1], F.transform(hits, lambda f: f["name"])).drop("_fences")
    found = F.concat(*[F.col(n) for n in names])
    return out.withColumn("geotag", F.array_join(F.array_sort(found), ",")).drop(*names)


def point_in_fence_pairs(points: DataFrame, fences: DataFrame, keep: list[str],
                         lon: str = "lon", lat: str = "lat", salt: int = 16,
                         row_key: str = "event_id") -> DataFrame:
    """JOIN-1 as pairs: ``keep..., name`` for every (point, fence) with the
    point strictly inside. A fence's leaves do not overlap, so each pair
    appears once."""
    cells, small = checked_broadcast(fence_cells(prepare(fences)), weight=_weight())
    pts = points.select(*keep, F.col(lon).alias("_x"), F.col(lat).alias("_y")).where(_is_place(F.col("_x"), F.col("_y")))
    levels = _levels(cells)
    if not levels:
        return pts.select(*keep, F.lit("").alias("name")).where("1 = 0")
    met = _meet(_cells_of_points(pts, levels, "_x", "_y"), cells.withColumnRenamed("name", "_name"), small, salt)
    return met.where(_in_leaf("_x", "_y")).select(*keep, F.col("_name").alias("name"))
