"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from homestrata.session import shared_dir


_local_roots: dict[str, str] = {}
_scopes: list[list[str]] = []


@contextmanager
def staged_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside when it is done, as a batch of a stream does."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def staging_root(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session without one gets a temporary one."""
    named = shared_dir(spark)
    context = spark.sparkContext
    if named:
        # one folder per application, to be removed when it is done
        return f"{named}/homestrata-{context.applicationId}"
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="homestrata-")
    return _local_roots[context.applicationId]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used for small aggregates that a large table is joined with next. Read back from
    files their size is known when the join is planned, so Spark broadcasts them only
    under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a skew-split
    shuffle join above it, and the large side is not shuffled just to find that out.
    Also cuts lineage in a way that survives lost executors.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
