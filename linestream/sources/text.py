"""SRC-5: text files of lines, read in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their position key ``(file, block start, row in task)``.

    The row id is taken right at the scan, where a task reads its block in
    file order, so sorting by the key gives the order of the files' lines
    (files in name order)."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """LIM-1: the first ``n`` lines. The files are taken in name order, twice
    as many each time, until they hold ``n`` lines; the rest is not read."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = fs.listStatus(folder)  # the listing that a read of the folder needs as well; no file is opened
    files = sorted(f.getPath().toString() for f in listed
                   if f.isFile() and f.getLen() > 0 and not f.getPath().getName().startswith(("_", ".")))
    if not files:
        return spark.read.schema("value string").text(path).limit(n)
    take = 1
    while take < len(files) and spark.read.text(files[:take]).limit(n).count() < n:
        take *= 2
    return text_lines(spark, files[:take]).orderBy("_file", "_block", "_row").limit(n).select("value")
