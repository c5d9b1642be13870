"""Sums of arrays over a whole table: per task, then in a tree of tasks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FAN_IN = 16


def sum_over(
    column: DataFrame, shape: tuple[int, ...], kind: type, add: Callable[[np.ndarray, list], None]
) -> np.ndarray:
    """Add up what ``add(total, values)`` puts into an array for all values of the one column.

    Every task sends one array, merged ``FAN_IN`` at a time, so neither a task nor the
    driver holds more than that many whatever the table's size.
    """

    def row(total: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(shape, kind), False
        for batch in batches:
            add(total, batch.column(0).to_pylist())
            any_rows = any_rows or batch.num_rows > 0
        if any_rows:
            yield row(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(shape, kind), False
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(raw.as_py(), kind).reshape(shape)
                any_rows = True
        if any_rows:
            yield row(total)

    parts = column.mapInArrow(part, "sums binary")
    n = column.rdd.getNumPartitions()
    while n > FAN_IN:
        n = math.ceil(n / FAN_IN)
        parts = parts.repartition(n).mapInArrow(merge, "sums binary")
    total = np.zeros(shape, kind)
    for got in parts.toLocalIterator():
        total += np.frombuffer(got.sums, kind).reshape(shape)
    return total
