"""Running values along an integer key, in two levels.

A plain window over a group orders the whole group in one task. Here the key
is cut into stretches of `fan` values: a window runs inside each stretch, one
row per stretch carries what came before it, so no task orders more than
`fan` rows, or more than `rows / fan` stretches, of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 1024


def _two_level(df: DataFrame, by: list[str], key: str, name: str, local: Column, last: Column, carry, join,
               fan: int) -> DataFrame:
    cut = df.withColumn("_s", F.expr(f"({key} - pmod({key}, {fan})) div {fan}"))
    inside = Window.partitionBy(*by, "_s").orderBy(key)
    stretches = cut.groupBy(*by, "_s").agg(last.alias("_last"))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_s")
    carried = stretches.select(*by, "_s", carry(F.col("_last"), before).alias("_carry"))
    return (cut.withColumn("_local", local.over(inside) if name == "_prev" else local.over(
                inside.rowsBetween(Window.unboundedPreceding, 0)))
            .join(carried, [*by, "_s"]).withColumn(name, join(F.col("_local"), F.col("_carry")))
            .drop("_s", "_local", "_last", "_carry"))


def previous(df: DataFrame, by: list[str], key: str, value: str, name: str, fan: int = FAN) -> DataFrame:
    """Add `name`: `value` of the row before, in `key` order (keys are unique per group)."""
    out = _two_level(df, by, key, "_prev", F.lag(value), F.max_by(value, key),
                     lambda last, w: F.lag(last).over(w), F.coalesce, fan)
    return out.withColumnRenamed("_prev", name)


def running_max(df: DataFrame, by: list[str], key: str, value: Column, name: str, fan: int = FAN) -> DataFrame:
    """Add `name`: the greatest `value` up to this row."""
    return _two_level(df, by, key, name, F.max(value), F.max(value),
                      lambda last, w: F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.greatest, fan)


def running_sum(df: DataFrame, by: list[str], key: str, value: Column, name: str, fan: int = FAN) -> DataFrame:
    """Add `name`: the sum of `value` up to this row, itself included."""
    return _two_level(df, by, key, name, F.sum(value), F.sum(value),
                      lambda last, w: F.sum(last).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                      lambda a, b: a + F.coalesce(b, F.lit(0)), fan)
