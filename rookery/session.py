"""Session factory and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None
# Paths that scratch_dir has named and drop_scratch has not yet deleted.
_MADE: list[str] = []


def build_session(app: str = "rookery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    Partition counts are left to the cluster unless given; AQE coalesces small ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Window state holds one row per open (window, tag): keep it off the JVM heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    Only a local master may use a temporary folder of one machine, since there the driver and the
    executors share it. Other local paths are taken on trust: they may be mounted everywhere.
    """
    global _LOCAL_SCRATCH
    shared = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if shared:
        path = os.path.realpath(shared.removeprefix("file:")) if _on_this_machine(shared) else ""
        own = os.path.realpath(tempfile.gettempdir())
        if not local and os.path.commonprefix([path + "/", own + "/"]) == own + "/":
            raise ValueError(f"spark.checkpoint.dir is {shared}, which is local to one machine")
        return shared.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="rookery-")
    return _LOCAL_SCRATCH


def _on_this_machine(path: str) -> bool:
    """Whether a path says so itself; one without a scheme is left to the cluster's file system."""
    return path.startswith("file:")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root; the folder itself is made by the first write."""
    path = os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")
    _MADE.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what ``scratch_dir`` has named so far, when all results are read; returns how many were there."""
    dropped = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        dropped += bool(files.delete(path, True))
    return dropped
