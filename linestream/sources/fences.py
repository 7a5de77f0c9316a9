"""Fence sets derived from ``nation`` (FIXTURES.md §3) and their JSON document.

Fence ``k`` is a diamond of radius 30 centred at ``(-170.0025 + 14k,
-60.005 + 30 (k % 5))``; odd keys carry a diamond hole of radius 4 (ring
reversed). Centres are computed in decimal and rounded to double once, so
the coordinates equal the ones DuckDB derives in its oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .tables import table

# Fixed values of the derived fence set.
OUTER_RADIUS = 30
HOLE_RADIUS = 4
FIELD_NAME = "iata_faa"


def _coord(centre_sql: str, offset: int) -> Column:
    return F.expr(f"cast({centre_sql} + ({offset}) as double)")


_CX = "(cast(-170.0025 as decimal(10,4)) + 14 * k)"
_CY = "(cast(-60.005 as decimal(10,4)) + 30 * (k % 5))"


def _diamond(r: int, reverse: bool) -> Column:
    pts = [(r, 0), (0, r), (-r, 0), (0, -r)]
    if reverse:
        pts = pts[::-1]
    pts = pts + [pts[0]]
    return F.array(*[F.array(_coord(_CX, dx), _coord(_CY, dy)) for dx, dy in pts])


def nation_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pos, k, name, rings`` — one fence per nation row."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    rings = F.when(F.col("k") % 2 == 1,
                   F.array(_diamond(OUTER_RADIUS, False), _diamond(HOLE_RADIUS, True))) \
        .otherwise(F.array(_diamond(OUTER_RADIUS, False)))
    return n.select(F.col("k").cast("long").alias("pos"), "k", "name", rings.alias("rings"))


def with_repeated_names(fences: DataFrame) -> DataFrame:
    """Append, after all originals, a second fence for every key ``k % 5 = 0``
    that reuses the name of ``k`` with the diamond of ``k + 2``."""
    extra = (fences.where(F.col("k") % 5 == 2)
             .select((F.lit(1000) + F.col("k")).alias("pos"), (F.col("k") - 2).alias("src_k"), "rings"))
    names = fences.select(F.col("k").alias("src_k"), "name")
    return fences.select("pos", "name", "rings").unionByName(
        extra.join(names, "src_k").select("pos", "name", "rings"))


def write_fence_document(fences: DataFrame, path: str, field_name: str = FIELD_NAME) -> str:
    """Write ``{"features":[{"geometry":{"rings":...},"attributes":{field:name}}]}``
    in ``pos`` order as one JSON text file. A fence set is one document by
    format (it is small: it is held in memory by every consumer)."""
    feat = F.struct(F.struct(F.col("rings").alias("rings")).alias("geometry"),
                    F.struct(F.col("name").alias(field_name)).alias("attributes"))
    doc = (fences.select(F.struct("pos", feat.alias("f")).alias("pf"))
           .agg(F.sort_array(F.collect_list("pf")).alias("pfs"))
           .select(F.to_json(F.struct(F.transform("pfs", lambda x: x.f).alias("features"))).alias("value")))
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


def fence_document_path(spark: SparkSession, fences: DataFrame) -> str:
    return write_fence_document(fences, fresh_path(spark, "fences"))


def write_fence_lines(fences: DataFrame, path: str, field_name: str = FIELD_NAME) -> str:
    """The same features, one JSON object per line with its ``pos``, in many
    files: the form for large fence sets (``load_fences(..., multiline=False)``)."""
    line = F.struct("pos", F.struct(F.col("rings").alias("rings")).alias("geometry"),
                    F.struct(F.col("name").alias(field_name)).alias("attributes"))
    fences.select(F.to_json(line).alias("value")).write.mode("overwrite").text(path)
    return path


def fence_lines_path(spark: SparkSession, fences: DataFrame) -> str:
    return write_fence_lines(fences, fresh_path(spark, "fence-lines"))
