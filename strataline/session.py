"""Session-level settings: scratch storage for cut lineage, and adaptive execution."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Safe to switch on for any session: none of these changes a result.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A third of the rows may share one join key. Splitting such a partition is
    # worth an extra exchange when the join is followed by an aggregation.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot interprets methods over 8000 bytecodes. Above that size, fall back to
    # per-operator code, which is split into methods that do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_adaptive_settings(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Where none is named it lies beside the warehouse; on a cluster whose warehouse is a folder of
    one machine that would lose rows, so it is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if is_one_machine(warehouse) and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all machines share; {warehouse} is on one of them")
        configured = warehouse.rstrip("/") + "/_shared"
        spark.conf.set(CHECKPOINT_KEY, configured)
    return configured.rstrip("/")


def is_one_machine(path: str) -> bool:
    """Whether a path names a folder of the machine that reads it."""
    return path.startswith("file:") or "://" not in path and not path.startswith("hdfs:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused between runs."""
    return f"{shared_folder(spark)}/strataline/{name}-{uuid.uuid4().hex}"
