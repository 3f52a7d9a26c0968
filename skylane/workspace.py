"""Shared folders for written intermediates and stream checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the jobs are meant to be submitted with. They belong to the caller's
# session; nothing in the library changes a running session's configuration.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many small shuffle partitions to begin with; adaptive execution joins them up
    # to the advisory size, so the number suits small jobs as well.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "Asia/Ho_Chi_Minh",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def base_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the session doesn't set it, the warehouse is used, which driver and executors
    share as well.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder; Spark creates it on write."""
    return f"{base_dir(spark)}/skylane/{label}-{uuid.uuid4().hex}"
