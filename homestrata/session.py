"""Session set-up.

Only settings that the operators rely on are listed here; everything about sizing
(executors, memory, shuffle partitions) stays with whoever submits the job.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings the operators are written for.
RUNTIME_CONF = {
    # Results carry no zone-dependent values, but casts NTZ -> TIMESTAMP must be stable.
    "spark.sql.session.timeZone": "UTC",
    # Joins carry no broadcast hints on data that grows: AQE picks by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One city, listing or user may hold a third of the rows: let AQE split such
    # partitions even when a later aggregate then needs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Pages differ in size: what a Python worker is handed at once is bounded by bytes, not rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
    # Keyed state of streams on disk, not in the executors' heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that already exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "homestrata", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("HOMESTRATA_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        # small local tables: keep all cores busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """Folder every executor can reach, as named by the cluster; None if it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else None
