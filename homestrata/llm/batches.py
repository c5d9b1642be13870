"""How much text a Python worker is handed at once."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

# Executors run several workers beside their heap; a batch is held as Arrow and as Python objects.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of the session by rows and bytes; results do not depend on them."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def let_go() -> None:
    """Give memory that a worker no longer uses back to its machine, for the workers beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass
