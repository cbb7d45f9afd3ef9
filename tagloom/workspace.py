"""Scratch paths in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir`` (where that is unset and the session runs on one
    machine, as in tests, under a temporary folder); it is removed when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tagloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/xml/{name}-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, path)
    return path


def _drop(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may have ended
        pass
