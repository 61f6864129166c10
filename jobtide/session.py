"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# AQE sizes the shuffles, turns a small side into a broadcast by its measured
# size, and splits a hot key of a sort-merge join over several tasks.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Recording the Python line of every expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the plans are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one machine, may go without that setting; it takes its warehouse.
    The folder goes when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the folder deleted when the application ends; a Connect session leaves it to its server."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
