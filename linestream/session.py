"""Session helpers: one place for the settings every query relies on.

Queries never create a session themselves; they receive one. They only
pin the settings their results depend on (UTC session time zone) and
find the shared folder for materialised intermediates.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "linestream") -> SparkSession:
    """Session for tests and the bench (local mode). On a cluster the
    submitter's session is used instead and only `ensure_defaults` runs."""
    master = master or os.environ.get("LINESTREAM_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LINESTREAM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; leave every other setting to the cluster."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    ship_code(spark)
    return spark


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_code(spark: SparkSession) -> None:
    """Let the session hand this package to its Python workers, unless they
    find it anyway (on PYTHONPATH, or started in its folder)."""
    package = os.path.dirname(os.path.abspath(__file__))
    root, app = os.path.dirname(package), spark.sparkContext.applicationId
    known = [os.path.abspath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p]
    if root in known or app in _shipped:
        return
    folder = tempfile.TemporaryDirectory()  # the driver serves the archive from here while it lives
    _shipped[app] = folder
    spark.sparkContext.addPyFile(shutil.make_archive(
        os.path.join(folder.name, os.path.basename(package)), "zip", root, os.path.basename(package)))


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints (must be shared storage).

    Read from the session; only when it is unset in local mode a folder is
    created and registered, so later `checkpoint()` calls find it too. On a
    cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            # a folder of this machine is shared by all tasks in local mode only
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="linestream-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new, unique folder name below the shared folder (not created)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{what}-{uuid.uuid4().hex[:12]}"
