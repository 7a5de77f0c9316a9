"""Shared helpers of the training-data operators: inputs, row keys, written tables.

Intermediates that a job reads more than once are written as Parquet into the
shared folder the cluster names (`spark.checkpoint.dir`), so a lost executor
costs a re-read and never a recomputation with other results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_defaults, fresh_path, ship_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_defaults(spark)
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_or_empty(name: str) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def written(df: DataFrame, what: str) -> DataFrame:
    """Write a table below the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = fresh_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions so that each holds about `rows_each` rows, never fewer than
    the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_each), 1)


def let(value: Column, body) -> Column:
    """Bind an expression once and use it many times inside one row
    (`body` gets a column that is not evaluated again for each use)."""
    return F.transform(F.array(value), body).getItem(0)
