"""Incremental runs: micro-batches through the batch operators, state in bucketed tables.

The order-dependent replays run inside ``foreachBatch`` rather than as keyed state:
a keyed operator would hand all of a busy listing's rows to one task, the batch
operators split them. A batch reads the buckets that its keys fall into, and writes those.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from homestrata.operators import collect, pricing
from homestrata.operators.ordered import first_by, latest_by
from homestrata.operators.preferences import KEY, merge_status, replay_preferences, status_parts
from homestrata.sources.epochs import BucketTable, EpochLog
from homestrata.sources.staging import stage, staged_scope


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what is there now, batch by batch, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


class Run:
    """Who writes: the stream's query, or this handler when it is called without one."""

    def __init__(self) -> None:
        self._own, self._names = uuid.uuid4().hex, {}

    def of(self, batch: DataFrame, table: EpochLog) -> str:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or self._own
        if query not in self._names:
            self._names[query] = table.run_of(query)
        return self._names[query]


def write_log(log: EpochLog) -> Callable[[DataFrame, int], None]:
    """Sink for streams of whole rows: each batch becomes a partition."""
    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        log.write(batch, runs.of(batch, log), epoch)

    return handle


def newest(log: EpochLog, keys: list[str]) -> DataFrame:
    """The last row that an updating stream wrote for every key."""
    return latest_by(log.stored(), keys, ["run", "epoch"]).select(*log.schema.fieldNames())


def track_prices(
    state: BucketTable, changes: EpochLog, ties: list[str], target_rows: int = 5_000_000
) -> Callable[[DataFrame, int], None]:
    """Fold price observations into the tracked state and append their changes.

    Late observations count when they arrive, as in the hourly runs.
    """

    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        run = runs.of(batch, state)
        with staged_scope(batch.sparkSession):
            found, rows = pricing.fold_observations(state.of(batch, run, epoch), batch, ties, target_rows)
            changes.write(found, run, epoch)
            state.write(rows, run, epoch)

    return handle


def track_preferences(preferences: BucketTable) -> Callable[[DataFrame, int], None]:
    """Fold preference events into the preference table.

    A stored preference takes part in the replay as an insert made before the batch.
    """
    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        run = runs.of(batch, preferences)
        with staged_scope(batch.sparkSession):
            events = batch.select(*KEY, "action", "ts", "seq")
            touched = events.select(*KEY).distinct()
            stored = preferences.of(touched, run, epoch).join(touched, KEY, "left_semi")
            as_events = stored.select(
                *KEY,
                F.col("preference_type").alias("action"),
                F.lit("0001-01-01").cast("timestamp").alias("ts"),
                F.lit(-1).cast("bigint").alias("seq"),
            )
            result = replay_preferences(events.unionByName(as_events))
            kept = stored.select(*KEY, F.col("created_at").alias("_at"), F.col("created_seq").alias("_seq"))
            from_store = F.col("created_seq") == -1
            rows = result.join(kept, KEY, "left").select(
                *KEY,
                "preference_type",
                F.when(from_store, F.col("_at")).otherwise(F.col("created_at")).alias("created_at"),
                F.when(from_store, F.col("_seq")).otherwise(F.col("created_seq")).alias("created_seq"),
            )
            rows = stage(rows, "preferences")
            gone = stored.select(*KEY).join(rows.select(*KEY), KEY, "left_anti")
            preferences.write(rows, run, epoch, deleted=gone)

    return handle


def track_status(state: BucketTable) -> Callable[[DataFrame, int], None]:
    """Fold status events into the stored state; all of it combines on the map side."""
    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        run = runs.of(batch, state)
        with staged_scope(batch.sparkSession):
            parts = status_parts(batch)
            touched = parts.select(*KEY).distinct()
            stored = state.of(touched, run, epoch).join(touched, KEY, "left_semi")
            state.write(merge_status(parts.unionByName(stored)), run, epoch)

    return handle


def crawl_runs(
    tracked: BucketTable, listings: BucketTable, summaries: EpochLog
) -> Callable[[DataFrame, int], None]:
    """One collector run per batch of observations (crawl_id, page_no, pos, url, price, city, ts).

    Classifies each URL of the batch against what is stored, tracks the new ones,
    applies price changes to the stored listings and keeps a summary per run.
    """

    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        run = runs.of(batch, summaries)
        with staged_scope(batch.sparkSession):
            seen = stage(first_by(batch, ["url"], ["page_no", "pos"]), f"seen-{epoch}")
            stored = listings.current((run, epoch))
            known = tracked.of(seen, run, epoch)
            classified = stage(collect.classify(seen, known, stored), f"classified-{epoch}")
            fresh = classified.where(F.col("status") == "new").select("url", "price", "city")
            tracked.write(collect.tracking_rows(fresh), run, epoch)
            changes = collect.price_changes(classified)
            changed = stored.join(changes.select("property_id"), "property_id", "left_semi")
            run_at = batch.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
            updated = pricing.apply_changes(changed, changes, F.lit(run_at).cast("timestamp"))
            listings.write(updated, run, epoch)
            summary = collect.collection_summary(classified).withColumn("run_at", F.lit(run_at).cast("timestamp"))
            summaries.write(summary, run, epoch)

    return handle
