"""Session defaults and the shared work folder."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(app_name: str = "scoreloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and timestamps pinned to UTC.

    Streaming state lives in RocksDB, so that it may outgrow executor memory.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Without it, a local master falls back to the warehouse folder, which the session
    itself names: on a cluster a machine-local path would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return posixpath.join(spark.conf.get("spark.sql.warehouse.dir"), "_work")


def work_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return posixpath.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
