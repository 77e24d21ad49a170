"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every new session should carry. They are defaults only: a key that
# the launcher set, or a session that is already there, keeps its own value.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    app_name: str = "tillroll",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset so the launcher's values apply.
    """
    builder = SparkSession.builder.appName(app_name)
    SparkContext._ensure_initialized()
    launched = SparkConf()  # with what the launcher set
    local = master or launched.get("spark.master", "")
    if master:
        builder = builder.master(master)
    if local.startswith("local") and not launched.contains("spark.driver.memory"):
        # Local mode runs everything in the driver JVM.
        builder = builder.config("spark.driver.memory", "8g")
    if SparkSession.getActiveSession() is None:
        for key, value in _DEFAULTS.items():
            if not launched.contains(key):
                builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: HotSpot never compiles a method above this size; Spark's own limit lets generated code grow far beyond it.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def compiled_only(spark: SparkSession) -> SparkSession:
    """The session, with operators fused only as far as the JVM compiles the
    fused method: a join, the building of the lines and their parsing in one
    method run interpreted, at a multiple of the time. A value that someone set
    stays."""
    name, value = HUGE_METHOD
    if spark.conf.get(name, None) in (None, "65535"):
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session. Only in local mode, where one machine does everything, do we
    create one ourselves when it is unset, and register it, so later calls
    agree; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tillroll-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return os.path.join(base, *parts) if parts else base
