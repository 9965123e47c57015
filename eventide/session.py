"""Session construction and shared-storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "eventide",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session tuned for this engine: AQE on (coalesce + skew join), UTC clock,
    Arrow on, UI off, RocksDB state for large streaming state."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.streaming.fileSink.logCleanupDelay": "1h",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # one memory budget per executor for all RocksDB instances (block cache +
        # write buffers), instead of unbounded native memory per state partition
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may do without the setting; there we pick our own folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local tmp on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "eventide", *parts, uuid.uuid4().hex])
