"""URL deduplication over a stream of observations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestrata.operators.ordered import first_by
from homestrata.sources.epochs import BucketTable
from homestrata.sources.staging import stage, staged_scope
from homestrata.streaming.incremental import Run

FILTER = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("bits", T.BinaryType())])
PARTS = 64
BITS = 1 << 20  # of one part, 128 KB
HASHES = 7


def first_seen_stream(
    observations: DataFrame, keys: list[str] | None = None, ts: str = "ts", within: str = "30 days"
) -> DataFrame:
    """Each URL once within ``within`` of event time; state older than that is dropped.

    Stored event times carry no zone and watermarks need one, hence the cast (UTC).
    """
    timed = observations.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys or ["url"])


# -- for all time ------------------------------------------------------------------------------


def _places(hashes: np.ndarray) -> np.ndarray:
    """The bits of every key: multiples of one half of its hash added to the other."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(BITS)).astype(np.int64)


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), F.col("url")), F.lit(parts)).cast("int")


def _with_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, kind, bits, h) in order of part, the filter first: every key with whether it may be known,
    and at the end of a part the filter with its keys added."""
    now, bits, seen = None, None, []

    def close() -> pa.RecordBatch:
        flags = np.zeros(BITS, bool) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        hashes = np.concatenate(seen) if seen else np.zeros(0, np.int64)
        at = _places(hashes.view(np.uint64))
        known = flags[at].all(axis=1)
        flags[at.ravel()] = True
        n = len(hashes)
        return pa.record_batch(
            [
                pa.array([now] * (n + 1), pa.int32()),
                pa.array([*hashes.tolist(), None], pa.int64()),
                pa.array([*known.tolist(), None], pa.bool_()),
                pa.array([*[None] * n, np.packbits(flags).tobytes()], pa.binary()),
            ],
            names=["part", "h", "may_be_known", "bits"],
        )

    for batch in batches:
        for part, raw, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if part != now:
                if now is not None:
                    yield close()
                now, bits, seen = part, None, []
            if raw is not None:
                bits = raw
            else:
                seen.append(np.array([h], np.int64))
    if now is not None:
        yield close()


def track_first_seen(
    urls: BucketTable, filters: BucketTable, parts: int = PARTS
) -> Callable[[DataFrame, int], None]:
    """Fold batches of observations (url, ts, ...) into ``urls``, each URL once, without a horizon.

    ``filters`` (``FILTER``, keyed by part) keeps a Bloom filter of all stored URLs in
    ``parts`` parts of ``BITS``. A URL that its filter does not know is new; only the others,
    which are possible hits, are joined with the stored URLs. The filters' size is fixed: with
    100,000 URLs a part one in a hundred new ones is joined in vain, which costs but changes
    nothing. ``parts`` cannot change while the filters are kept.
    """
    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        run = runs.of(batch, urls)
        with staged_scope(batch.sparkSession):
            rows = batch.where(F.col("url").isNotNull()).select(*urls.schema.fieldNames())
            seen = stage(first_by(rows, ["url"], [c for c in rows.columns if c != "url"]), "seen")
            keyed = seen.select("url", _part(parts).alias("part"), F.xxhash64("url").alias("h"))
            asked = keyed.select("part", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("bits"), "h").distinct()
            stored = filters.of(keyed.select("part").distinct(), run, epoch)
            stored = stored.join(keyed.select("part").distinct(), "part", "left_semi")
            held = stored.select("part", F.lit(0).alias("kind"), "bits", F.lit(None).cast("bigint").alias("h"))
            dealt = held.unionByName(asked).repartition("part").sortWithinPartitions("part", "kind")
            found = dealt.mapInArrow(_with_filter, "part int, h bigint, may_be_known boolean, bits binary")
            found = stage(found, "filtered")
            asked_of = keyed.join(found.where("may_be_known").select("part", "h"), ["part", "h"], "left_semi")
            possible = stage(asked_of.select("url"), "possible-hits")
            known = possible.join(urls.of(possible, run, epoch).select("url"), "url", "left_semi")
            fresh = seen.join(stage(known, "known-urls"), "url", "left_anti")
            urls.write(fresh, run, epoch)
            filters.write(found.where(F.col("bits").isNotNull()).select("part", "bits"), run, epoch)

    return handle
