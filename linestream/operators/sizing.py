"""Materialise a small side and broadcast it only when its size is proven.

The side is written with a reliable `checkpoint()` into the shared folder the
cluster names (never `localCheckpoint`), which also cuts its lineage, so a lost
executor does not recompute the upstream scan. Its size is then counted from
the written copy; above the bound the caller's join stays a shuffle join
(with AQE skew-join splitting hot partitions).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

DEFAULT_MAX_BROADCAST_UNITS = int(os.environ.get("LINESTREAM_MAX_BROADCAST_UNITS", "2000000"))


def materialize(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checked_broadcast(df: DataFrame, max_units: int | None = None,
                      weight: Column | None = None) -> tuple[DataFrame, bool]:
    """Return ``(side, broadcast?)``.

    ``weight`` measures one row (for example the number of polygon edges it
    carries); by default every row weighs 1.
    """
    bound = DEFAULT_MAX_BROADCAST_UNITS if max_units is None else max_units
    side = materialize(df)
    w = F.lit(1) if weight is None else weight
    units = side.agg(F.coalesce(F.sum(w.cast("long")), F.lit(0))).first()[0]
    if units <= bound:
        return F.broadcast(side), True
    return side, False
