"""Running values of a sequence in one pass up and down (a segmented prefix scan).

The rows of a group are cut into stretches of `FAN` key values. Up: windows
inside a stretch give each row its place in the stretch's segments, and a
stretch is folded to one element (first and last key, does a segment start
inside it, the sum since the last start). Across: a window over the elements,
one row a stretch, says what came before each. Down: a row adds that, if its
segment goes on from the stretch before. Both sides of the last join are dealt
by the stretch, so the rows are read and exchanged once; no task orders more
than `FAN` rows, or more than values / `FAN` stretches, of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAN = 1024


def segments(rows: DataFrame, by: list[str], key: str, value: str, gap: int, fan: int = FAN) -> DataFrame:
    """Add `previous` (the key before; null for a group's first row), `starts`
    (a segment starts here: no row before, or its key is more than `gap` lower)
    and `running` (the sum of `value` in the segment up to here).

    `key` is an integer, unique in its group; a null in `by` is a group too."""
    cut = rows.withColumn("_s", F.expr(f"({key} - pmod({key}, {fan})) div {fan}"))
    inside = Window.partitionBy(*by, "_s").orderBy(key)
    local = cut.withColumn("_p", F.lag(key).over(inside))
    local = local.withColumn("_start", F.col("_p").isNotNull() & (F.col(key) - F.col("_p") > gap))
    local = local.withColumn("_seg", F.sum(F.col("_start").cast("int")).over(inside))
    local = local.withColumn("_run", F.sum(value).over(Window.partitionBy(*by, "_s", "_seg").orderBy(key)))
    up = local.groupBy(*by, "_s").agg(F.min(key).alias("_first"), F.max(key).alias("_last"), F.max("_seg").alias("_cuts"),
                                      F.max_by("_run", key).alias("_open"))
    order = (Window.partitionBy(*by) if by else Window).orderBy("_s")  # a row a stretch
    across = up.withColumn("_before", F.lag("_last").over(order))
    across = across.withColumn("_joins", F.col("_before").isNotNull() & (F.col("_first") - F.col("_before") <= gap))
    fresh = (F.col("_cuts") > 0) | ~F.col("_joins")  # the sum behind this stretch is its own, from its last start
    across = across.withColumn("_block", F.sum(fresh.cast("int")).over(order))
    across = across.withColumn("_sum", F.sum("_open").over(Window.partitionBy(*by, "_block").orderBy("_s")))
    across = across.withColumn("_carry", F.when(F.col("_joins"), F.lag("_sum").over(order)).otherwise(F.lit(0)))
    keys = [*by, "_s"]
    side = across.select(*[F.col(c).alias(f"{c}_2") for c in keys], "_before", "_joins", "_carry")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_2")) for c in keys])
    down = local.join(side, same)
    return down.select(*rows.columns, F.coalesce("_p", "_before").alias("previous"),
                       (F.col("_start") | (F.col("_p").isNull() & ~F.col("_joins"))).alias("starts"),
                       (F.col("_run") + F.when(F.col("_seg") == 0, F.col("_carry")).otherwise(F.lit(0))).alias("running"))
