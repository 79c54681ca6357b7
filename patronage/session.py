"""Session settings the operators expect, and the shared folder their intermediate data goes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # recording the Python call site of every column costs more than planning a micro-batch
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "patronage", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prefer_rocksdb(spark: SparkSession) -> None:
    """Keyed streaming aggregates hold one row per customer: unless the session chose a state store of its own, keep
    them off the JVM heap and upload changes, not snapshots, with each batch."""
    if spark.conf.get(_PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where a local session names none (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="patronage-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/patronage/{purpose}-{uuid.uuid4().hex}"
