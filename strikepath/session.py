"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM does not compile methods above 8,000 bytes of code. Wide projections
    # then run faster as split expressions than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a Python call site for every column costs more than small plans do.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "strikepath", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone: weeks, days and 15-minute windows are all UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local-mode session may fall back to the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="strikepath-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
