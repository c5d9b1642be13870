"""Price tracking: observations over time -> changes -> tracked state and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestrata.functions.prices import pct_change
from homestrata.operators.mutate import update_existing
from homestrata.operators.ordered import large_key_segments, latest_by, with_segments
from homestrata.schemas import struct
from homestrata.sources.staging import stage

TRACKING_COLUMNS = [
    "price", "original_price", "previous_price", "last_price_change", "last_price_change_pct",
    "total_price_change", "total_price_change_pct", "price_update_count", "last_price_update",
]

TRACKING_TYPES = [
    "bigint", "bigint", "bigint", "bigint", "double", "bigint", "double", "bigint", "timestamp",
]

CHANGES_SCHEMA = struct(
    "property_id string, change_no bigint, ts timestamp, price bigint, previous_price bigint, "
    "last_price_change bigint, last_price_change_pct double, original_price bigint, "
    "total_price_change bigint, total_price_change_pct double"
)

HISTORY_CHUNK = 1000


def replay_changes(
    observations: DataFrame,
    ties: list[str],
    key: str = "property_id",
    ts: str = "ts",
    target_rows: int = 5_000_000,
) -> DataFrame:
    """Every price change of every listing, numbered in order.

    Observations without a positive price are ignored and repeats of the current price
    change nothing; the first price seen is where a listing starts, not a change.
    ``ties`` makes the order within one ``ts`` total.

    A listing with more than ``target_rows`` observations is cut into segments of
    time; only the few numbers describing a segment are then carried to the next, so
    no task replays such a listing alone.
    """
    positive = observations.select(key, ts, *ties, "price").where(F.col("price") > 0)
    found = large_key_segments(positive, key, ts, target_rows)
    if found is None:
        runs = _price_runs(positive, [key], [ts, *ties])
        return _changes_of(runs, key, ts, F.col("_prev"), F.col("_run"), F.col("_first"))
    cut = with_segments(positive, found[0], key, ts, found[1])
    runs = _price_runs(cut, [key, "segment"], [ts, *ties])

    # what each later segment of a large listing needs to know about the ones before
    per_segment = (
        runs.where(F.col("segment").isNotNull())
        .groupBy(key, "segment")
        .agg(
            F.min_by("price", "_run").alias("_head"),
            F.max_by("price", "_run").alias("_last"),
            F.max("_run").alias("_inner"),
        )
    )
    by_segment = Window.partitionBy(key).orderBy("segment")
    earlier = by_segment.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_segment.withColumn("_left", F.lag("_last").over(by_segment))
        .withColumn("_step", F.when(F.col("_left") != F.col("_head"), 1).otherwise(0))
        .withColumn("_done", F.sum(F.col("_inner") + F.col("_step")).over(earlier))
        .withColumn("_origin", F.first("_head").over(by_segment))
        .where(F.col("_left").isNotNull())
        .select(key, "segment", "_left", "_step", "_done", "_origin")
    )
    joined = runs.join(carried, [key, "segment"], "left")
    previous = F.coalesce("_prev", "_left")
    number = F.col("_run") + F.coalesce(F.col("_done") + F.col("_step"), F.lit(0))
    return _changes_of(joined, key, ts, previous, number, F.coalesce("_origin", "_first"))


def _price_runs(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First observation of every run of equal prices, numbered from 0, in one window."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_prev", F.lag("price").over(ordered))
        .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("price")))
        .withColumn("_run", F.row_number().over(ordered) - 1)
        .withColumn("_first", F.first("price").over(so_far))
    )


def _changes_of(runs: DataFrame, key: str, ts: str, previous: Column, number: Column, original: Column) -> DataFrame:
    price = F.col("price")
    return runs.where(previous != price).select(
        key,
        number.cast("bigint").alias("change_no"),
        F.col(ts).alias("ts"),
        "price",
        previous.alias("previous_price"),
        (price - previous).alias("last_price_change"),
        pct_change(price, previous).alias("last_price_change_pct"),
        original.alias("original_price"),
        (price - original).alias("total_price_change"),
        pct_change(price, original).alias("total_price_change_pct"),
    )


def tracked_state(changes: DataFrame, key: str = "property_id") -> DataFrame:
    """Tracking columns of every listing that changed price: its last change."""
    return latest_by(changes, [key], ["change_no"]).select(
        key,
        "price",
        "original_price",
        "previous_price",
        "last_price_change",
        "last_price_change_pct",
        "total_price_change",
        "total_price_change_pct",
        F.col("change_no").alias("price_update_count"),
        F.col("ts").alias("last_price_update"),
    )


def apply_changes(listings: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """One round of price changes (property_id, old_price, new_price) on stored listings.

    Only existing listings are updated. The original price is set once, to the first
    old price. Stored tracking columns may be missing on a table never tracked.
    """
    for name, kind in zip(TRACKING_COLUMNS, TRACKING_TYPES):
        if name not in listings.columns:
            listings = listings.withColumn(name, F.lit(None).cast(kind))
    stored = listings.select("property_id", "original_price", "price_update_count")
    # one listing may be advertised under several URLs in one round; one change is made
    by = ["url", "new_price"] if "url" in changes.columns else ["new_price"]
    changes = latest_by(changes, ["property_id"], by)
    old, new = F.col("old_price"), F.col("new_price")
    original = F.coalesce("original_price", old)
    updates = changes.join(stored, "property_id").select(
        "property_id",
        new.alias("price"),
        original.alias("original_price"),
        old.alias("previous_price"),
        (new - old).alias("last_price_change"),
        pct_change(new, old).alias("last_price_change_pct"),
        (new - original).alias("total_price_change"),
        pct_change(new, original).alias("total_price_change_pct"),
        (F.coalesce("price_update_count", F.lit(0)) + 1).alias("price_update_count"),
        now.alias("last_price_update"),
    )
    return update_existing(listings, updates, ["property_id"], TRACKING_COLUMNS)


def history_rows(changes: DataFrame, key: str = "property_id", keep_days: int = 365) -> DataFrame:
    """One history row per change, with the date it expires."""
    return changes.select(
        key,
        "change_no",
        "ts",
        "price",
        "previous_price",
        F.col("last_price_change").alias("price_change_amount"),
        F.col("last_price_change_pct").alias("price_drop_pct"),
        F.lit("price_updated").alias("listing_status"),
        (F.col("ts") + F.expr(f"INTERVAL {int(keep_days)} DAYS")).alias("expires_at"),
    )


def unexpired(history: DataFrame, as_of: Column) -> DataFrame:
    return history.where(F.col("expires_at") > as_of)


def history_lists(changes: DataFrame, key: str = "property_id", chunk: int = HISTORY_CHUNK) -> DataFrame:
    """History as lists of (date, new price), the starting price not included.

    Lists come in chunks of ``chunk`` changes, in order, so that no single row grows
    with the busiest listing; almost every listing has chunk 0 only.
    """
    entry = F.struct("change_no", F.to_date("ts").alias("date"), "price")
    lists = changes.groupBy(key, F.floor((F.col("change_no") - 1) / chunk).alias("chunk_no")).agg(
        F.sort_array(F.collect_list(entry)).alias("_entries")
    )
    points = F.transform("_entries", lambda e: F.struct(e["date"].alias("date"), e["price"].alias("price")))
    return lists.select(key, "chunk_no", points.alias("price_history"))


STATE_SCHEMA = struct(
    "property_id string, price bigint, original_price bigint, price_update_count bigint, "
    "last_price_update timestamp"
)


def fold_observations(
    state: DataFrame, batch: DataFrame, ties: list[str], target_rows: int = 5_000_000
) -> tuple[DataFrame, DataFrame]:
    """Price changes a batch of observations causes, and the state rows it touches.

    ``state`` holds one row per listing (``STATE_SCHEMA``). The stored price takes part
    in the replay as the listing's earliest observation, so a batch is replayed by the
    same job as a whole log, large listings included.
    """
    positive = batch.select("property_id", "ts", *ties, "price").where(F.col("price") > 0)
    at = F.struct("ts", *ties)
    touched = positive.groupBy("property_id").agg(F.max_by("price", at).alias("_now"))
    before = state.join(touched.select("property_id"), "property_id", "left_semi")
    kinds = dict(positive.dtypes)
    as_first = before.select(
        "property_id",
        F.lit("0001-01-01").cast("timestamp").alias("ts"),
        *[F.lit(None).cast(kinds[t]).alias(t) for t in ties],
        "price",
    )
    found = replay_changes(positive.unionByName(as_first), ties, target_rows=target_rows)
    stored = state.select(
        "property_id",
        F.col("original_price").alias("_original"),
        F.col("price_update_count").alias("_count"),
    )
    price = F.col("price")
    original = F.coalesce("_original", "original_price")
    changes = found.join(stored, "property_id", "left").select(
        "property_id",
        (F.col("change_no") + F.coalesce("_count", F.lit(0))).alias("change_no"),
        "ts",
        "price",
        "previous_price",
        "last_price_change",
        "last_price_change_pct",
        original.alias("original_price"),
        (price - original).alias("total_price_change"),
        pct_change(price, original).alias("total_price_change_pct"),
    )
    changes = stage(changes, "batch-changes")  # both results come from one replay
    last = tracked_state(changes).select(
        "property_id", "original_price", "price_update_count", "last_price_update"
    )
    unchanged = before.select(
        "property_id",
        F.col("original_price").alias("_original"),
        F.col("price_update_count").alias("_count"),
        F.col("last_price_update").alias("_updated"),
    )
    rows = touched.join(last, "property_id", "left").join(unchanged, "property_id", "left").select(
        "property_id",
        F.col("_now").alias("price"),
        F.coalesce("original_price", "_original").alias("original_price"),
        F.coalesce("price_update_count", "_count", F.lit(0)).cast("bigint").alias("price_update_count"),
        F.coalesce("last_price_update", "_updated").alias("last_price_update"),
    )
    return changes, rows
