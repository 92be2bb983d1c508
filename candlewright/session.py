"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

NEW_YORK = "America/New_York"

JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int = 8, app: str = "candlewright", **extra: str) -> SparkSession:
    """A single-JVM session for tests and benches. Clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **JOB_SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def in_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: every operator keeps instants and converts to New York explicitly."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, used for streaming state and for tables that cut lineage.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="candlewright-")
    return _local_root


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, never reused path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for a stateful stream.

    State partitions are fixed for the life of a stream and every micro-batch commits all of them, so
    they follow the cores instead of the batch shuffle setting.
    """
    own = in_utc(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return own
