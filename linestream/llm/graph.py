"""Connected components of a link table by alternating large and small stars.

Every round is two grouped joins over links between distinct nodes and is
written to the shared folder; the table never leaves the cluster. A hub's
links are reduced per task before they meet (min) and its join partition is
one that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, F.col("u") == F.col("w"))
            .select(F.col("m").alias("u"), "v").where("u < v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    # links point from the smaller u to the larger v
    low = links.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), "m")
    joined = links.join(low, F.col("v") == F.col("w"))
    own = low.select(F.col("m").alias("u"), F.col("w").alias("v"))
    return joined.where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v")).unionByName(own).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (its component's smallest node) for every node but the roots.

    `links`: pairs of different nodes, in any order, repeats allowed.
    """
    edges = written(links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(),
                    "links")
    before = None
    while True:
        sign = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = sign
        edges = written(_small_star(_large_star(edges)), "links")
