"""Exact row positions and islands without a single-task window.

A window with an ORDER BY but no PARTITION BY (or with a hot partition key)
moves a whole group into one task. Here the leading numeric order column is
cut into slices at approximate quantiles (one sketch pass; the bounds become
literals, so every later evaluation of the plan slices identically). Then

* ``row_number()`` runs per ``(group, slice)`` — each slice holds about
  ``1 / slices`` of the rows, even when one group holds a third of them;
* a table with one row per ``(group, slice)`` gives each slice its offset
  (a running sum over at most ``slices`` rows per group).

The position is exact; only the balance of the slices is approximate (rows
sharing one value of the leading order column stay in one slice).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of an order; raise it with the rows (a slice is sorted in one task).
SLICES = 256


def slice_of(x: Column, bounds: list) -> Column:
    """Index of the slice holding ``x``: the number of sorted bounds ``<= x``.

    The bounds are array literals in two levels (about the square root of
    their number each), so the expression stays small however many there are.
    """
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    kind = "double" if any(isinstance(b, float) for b in bounds) else "bigint"

    def literal(values: list) -> Column:
        return F.lit(values).cast(f"array<{kind}>")

    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    upper = literal([g[0] for g in groups])
    below = F.lit([[float(v) if kind == "double" else v for v in g] for g in groups]).cast(f"array<array<{kind}>>")

    def inside(g: Column) -> Column:
        own = F.size(F.filter(F.get(below, g - 1), lambda b: b <= x))
        return F.when(g > 0, (g - 1) * step + own).otherwise(0)

    # bound once: the group's number is used in several places
    return F.transform(F.array(F.size(F.filter(upper, lambda b: b <= x))), inside).getItem(0)


def quantile_bounds(df: DataFrame, col: str, slices: int) -> list:
    if slices <= 1:
        return []
    probs = [i / slices for i in range(1, slices)]
    qs = df.approxQuantile(col, probs, 1.0 / (4 * slices))
    return sorted(set(q for q in qs if q is not None))


def with_sequence(df: DataFrame, order_cols: list[str], name: str = "seq",
                  group_cols: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row within ``group_cols``
    in ``order_cols`` order. ``order_cols[0]`` must be numeric and the
    order columns must identify a row within its group."""
    group_cols = group_cols or []
    n = slices or SLICES
    bounds = quantile_bounds(df, order_cols[0], n)
    sliced = df.withColumn("_slice", slice_of(F.col(order_cols[0]), bounds))
    keys = [*group_cols, "_slice"]
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)) - 1
    counts = sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    spec = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy("_slice") \
        .rowsBetween(Window.unboundedPreceding, 0)
    # one row per non-empty (group, slice): at most `slices` rows per group
    offsets = counts.select(*keys, (F.sum("_n").over(spec) - F.col("_n")).alias("_off"))
    return (sliced.withColumn("_rn", rn)
            .join(offsets, keys)
            .withColumn(name, F.col("_off") + F.col("_rn"))
            .drop("_slice", "_rn", "_off"))
