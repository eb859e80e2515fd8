"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Parallelism is left to adaptive execution: it merges small shuffle partitions and splits skewed
# ones. The session zone is UTC because ISO texts without an offset are read in it. The JVM does not
# compile methods above 8,000 bytes of bytecode; the wide event rows exceed that in one generated
# method, and below the limit Spark splits the work over smaller ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # States on local disk with their changes in the checkpoint, not in the memory of the JVM.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Only a new session can have this: call-site tracing of Columns doubles the time to build a plan.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "subscriber_analytics", **extra: str) -> SparkSession:
    """Session with both sets of settings; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what can be set on a session that exists already."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """New, unused path below the cluster's shared folder (``spark.checkpoint.dir``).

    A machine-local folder is used only where that setting is absent and Spark runs in one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
