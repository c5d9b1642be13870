"""Keyed stateful operators for results that must be there as events arrive.

State is Spark's own (RocksDB, kept with the stream's checkpoint). A processor's group is a
part of the keys, not a single one: a call and a state access per key cost far more than
the work on it. A part's state is one Arrow table, read and written once per batch, and its
keys are worked on together. Where one key may hold much of a batch, its rows are folded
before they meet: prices by listing and unit of time, status events by Spark's partial
aggregates.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from homestrata.functions.prices import pct_change
from homestrata.operators.preferences import KEY, merge_status, status_parts, status_view
from homestrata.operators.pricing import CHANGES_SCHEMA
from homestrata.schemas import struct

# The processors travel to the workers by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NEVER = -(2**62)  # a NULL time, before all others

# Parts of the keys; a part's state of a batch is handled in a worker's memory.
PARTS = 256
# Rows handed back at once.
_OUT = 20_000


def _part(parts: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).alias("part")


def _from_pandas(chunks: Iterator[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    """Chunks of a group as one table."""
    found = [pa.Table.from_pandas(c[schema.names], schema, preserve_index=False) for c in chunks]
    return pa.concat_tables([schema.empty_table(), *found])


def _packed(rows: pa.Table) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(value: tuple[bytes]) -> pa.Table:
    return pa.ipc.open_stream(bytes(value[0])).read_all()


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _codes(*columns: pa.ChunkedArray) -> np.ndarray:
    """A number per row, the same where all columns are; NULLs are equal."""
    codes = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        found = column.combine_chunks().dictionary_encode(null_encoding="encode")
        codes = codes * len(found.dictionary) + found.indices.to_numpy()
    return codes


def _begins(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    begins = np.ones(len(sorted_columns[0]), bool)
    begins[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return begins


# -- prices -----------------------------------------------------------------------------------


_RUN = pa.schema([("property_id", pa.string()), *((c, pa.int64()) for c in ("unit", "pos", "at", "price"))])
_LISTING = pa.schema([("property_id", pa.string()), *((c, pa.int64()) for c in ("last", "original", "changes"))])


def _price_runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema, ties: list[str]) -> Iterator[pa.RecordBatch]:
    """First observations of the runs of equal prices of every listing and unit, numbered in order."""
    rows = pa.Table.from_batches([b for b in batches if b.num_rows], schema)
    if not rows.num_rows:
        return
    by = [(c, "ascending") for c in ("property_id", "unit", "at", *ties)]
    rows = rows.take(pc.sort_indices(rows, sort_keys=by, null_placement="at_start")).combine_chunks()
    runs = _begins(_codes(rows["property_id"]), rows["unit"].to_numpy(), rows["price"].to_numpy())
    rows = rows.append_column("pos", pa.array(np.arange(rows.num_rows))).filter(pa.array(runs))
    yield from rows.select(["part", *_RUN.names]).to_batches(max_chunksize=_OUT)


class PriceReplay(StatefulProcessor):
    """Last price, first price and number of changes of the listings of a part."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("prices", "listings binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _from_pandas(rows, _RUN)
        held = _unpacked(self._state.get()) if self._state.exists() else _LISTING.empty_table()
        ids = pa.chunked_array([*held["property_id"].chunks, *new["property_id"].chunks], pa.string())

        def joined(old: np.ndarray | int, column: str) -> np.ndarray:
            return np.concatenate([np.broadcast_to(old, held.num_rows), _numbers(new[column])])

        # what is known of a listing comes before its new rows
        code = _codes(ids)
        order = np.lexsort((joined(0, "pos"), joined(_NEVER - 1, "unit"), code))
        code, at, price = code[order], joined(0, "at")[order], joined(_numbers(held["last"]), "price")[order]
        original = joined(_numbers(held["original"]), "price")[order]
        before = np.concatenate([_numbers(held["changes"]), np.zeros(new.num_rows, np.int64)])[order]
        firsts = _begins(code)
        changed = _begins(price) & ~firsts
        starts, listing = np.flatnonzero(firsts), np.cumsum(firsts) - 1
        number = np.cumsum(changed)
        number += (before[starts] - number[starts])[listing]
        original = original[starts][listing]
        ends = np.append(starts[1:], len(code)) - 1
        kept = [ids.take(pa.array(order[ends])), *(pa.array(c[ends]) for c in (price, original, number))]
        self._state.update(_packed(pa.Table.from_arrays(kept, schema=_LISTING)))
        found = np.flatnonzero(changed)
        for i in range(0, len(found), _OUT):
            some = found[i : i + _OUT]
            yield pd.DataFrame(
                {
                    "property_id": ids.take(pa.array(order[some])).to_pandas(), "change_no": number[some], "at": at[some],
                    "price": price[some], "previous": price[some - 1], "original_price": original[some],
                }
            )

    def close(self) -> None:
        pass


def price_changes_stream(
    observations: DataFrame, ties: list[str], unit: str = "day", parts: int = PARTS
) -> DataFrame:
    """Price changes (``CHANGES_SCHEMA``) as observations (property_id, ts, price, ties) arrive.

    Observations of one batch are replayed in order; late ones count when they arrive. A
    batch's observations of one listing and ``unit`` meet in one task, of which only runs
    of equal prices go on to the listing's state, which is kept in ``parts`` parts.
    """
    spark = observations.sparkSession
    rows = observations.where(F.col("price") > 0).select(
        "property_id",
        F.coalesce(F.unix_micros(F.date_trunc(unit, "ts")), F.lit(_NEVER)).alias("unit"),
        F.coalesce(F.unix_micros("ts"), F.lit(_NEVER)).alias("at"),
        F.col("price").cast("bigint").alias("price"),
        _part(parts, "property_id"),
        *ties,
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.schema)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartition(tasks, "property_id", "unit").mapInArrow(
        lambda batches: _price_runs(batches, arrow, ties),
        "part bigint, property_id string, unit bigint, pos bigint, at bigint, price bigint",
    )
    found = runs.groupBy("part").transformWithStateInPandas(
        PriceReplay(),
        "property_id string, change_no bigint, at bigint, price bigint, previous bigint, original_price bigint",
        "Append",
        "None",
    )
    at, price, previous, original = (F.col(c) for c in ("at", "price", "previous", "original_price"))
    return found.select(
        "property_id",
        "change_no",
        F.when(at != _NEVER, F.timestamp_micros(at)).alias("ts"),
        "price",
        previous.alias("previous_price"),
        (price - previous).alias("last_price_change"),
        pct_change(price, previous).alias("last_price_change_pct"),
        "original_price",
        (price - original).alias("total_price_change"),
        pct_change(price, original).alias("total_price_change_pct"),
    ).select(*CHANGES_SCHEMA.fieldNames())


# -- history that expires ---------------------------------------------------------------------

EXPIRY = struct("property_id string, change_no bigint, expires_at timestamp, expired boolean")


_OPEN = pa.schema([("property_id", pa.string()), ("change_no", pa.int64()), ("at", pa.int64())])


class Expiry(StatefulProcessor):
    """History rows of some listings that expire in one month, until their last day has come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getListState("open", "rows binary")

    def _wake(self, held: pa.Table) -> None:
        """One timer, for what expires first."""
        self._handle.registerTimer(-(-int(_numbers(held["at"]).min()) // 1000))

    def _rows(self, held: pa.Table, expired: bool) -> Iterator[pd.DataFrame]:
        for i in range(0, held.num_rows, _OUT):
            yield held.slice(i, _OUT).to_pandas().assign(expired=expired)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _from_pandas(rows, pa.schema([*_OPEN, ("held", pa.bool_())]))
        held = new.filter(new["held"]).select(_OPEN.names)  # others only move the clock on
        if held.num_rows:
            self._open.appendValue(_packed(held))
            self._wake(held)
            yield from self._rows(held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # all that is due by now at once, not a day at a time
        due = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1) * 1000
        held = pa.concat_tables([_OPEN.empty_table(), *map(_unpacked, self._open.get())])
        gone = _numbers(held["at"]) <= due
        if not gone.any():
            return
        left = held.filter(pa.array(~gone))
        if left.num_rows:
            self._open.put([_packed(left)])
            self._wake(left)
        else:
            self._open.clear()
        yield from self._rows(held.filter(pa.array(gone)), True)

    def close(self) -> None:
        pass


def expiring_history(history: DataFrame, late: str = "1 day", parts: int = 64) -> DataFrame:
    """(property_id, change_no, expires_at, expired): rows of history as they come and as they expire.

    ``history`` has property_id, change_no, ts and expires_at. The clock is event time: a row
    expires once times ``late`` beyond its last day have been seen; rows without a change_no
    only tell the time, and so do rows without a last day, which ``unexpired`` leaves out too.
    State is kept by month of expiry in ``parts`` parts, over which a busy listing's changes
    are spread like all others, and none outlives its rows.
    """
    held = F.col("change_no").isNotNull() & F.col("expires_at").isNotNull()
    rows = history.withWatermark("ts", late).select(
        F.pmod(F.xxhash64("property_id", "change_no"), F.lit(parts)).alias("part"),
        F.coalesce(F.date_format("expires_at", "yyyy-MM"), F.lit("")).alias("month"),
        "property_id",
        F.coalesce("change_no", F.lit(0)).cast("bigint").alias("change_no"),
        F.coalesce(F.unix_micros("expires_at"), F.lit(0)).alias("at"),
        held.alias("held"),
        "ts",
    )
    found = rows.groupBy("part", "month").transformWithStateInPandas(
        Expiry(), "property_id string, change_no bigint, at bigint, expired boolean", "Append", "EventTime"
    )
    return found.select("property_id", "change_no", F.timestamp_micros("at").alias("expires_at"), "expired")


def unexpired_rows(events: DataFrame) -> DataFrame:
    """History that has come and not expired, from what ``expiring_history`` has written."""
    keys = ["property_id", "change_no", "expires_at"]
    return events.groupBy(*keys).agg(F.max("expired").alias("expired")).where(~F.col("expired")).select(*keys)


# -- preferences ------------------------------------------------------------------------------

PREFERENCE_EVENTS = struct(
    "user_id bigint, property_id string, preference_type string, created_at timestamp, created_seq bigint"
)
_TYPES = ["favorite", "hidden"]


_REMOVED = 2
_EVENT = pa.schema([("user", pa.string()), ("property_id", pa.string()), *((c, pa.int64()) for c in ("at", "seq", "kind"))])


class Preferences(StatefulProcessor):
    """By pair the last removal, and the inserts after it that late removals may reach; the pairs of a part."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("pairs", "events binary")

    def _sorted(self, events: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """Events by pair and time with where pairs begin, and the order they came from."""
        pair = _codes(events["user"], events["property_id"])
        # a removal comes after the inserts of its time
        order = np.lexsort((*(_numbers(events[c]) for c in ("kind", "seq", "at")), pair))
        return events.take(pa.array(order)), np.flatnonzero(_begins(pair[order])), order

    def _keep(self, events: pa.Table, starts: np.ndarray, closed: int) -> np.ndarray:
        """Store what is still needed of sorted events; the place of each pair's first insert, or their number."""
        n = events.num_rows
        places, kind, at = np.arange(n), _numbers(events["kind"]), _numbers(events["at"])
        sizes = np.diff(np.append(starts, n))
        removed = np.repeat(np.maximum.reduceat(np.where(kind == _REMOVED, places, -1), starts), sizes)
        heads = np.minimum.reduceat(np.where(places > removed, places, n), starts)
        head = places == np.repeat(heads, sizes)
        waiting = (places > removed) & ~head & (at > closed)
        self._state.update(_packed(events.filter(pa.array(head | waiting | (places == removed)))))
        if waiting.any():  # when no removal can come in between any more
            self._handle.registerTimer(int(at[waiting].max()) // 1000 + 1)
        return heads

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = _unpacked(self._state.get()) if self._state.exists() else _EVENT.empty_table()
        events, starts, order = self._sorted(pa.concat_tables([held, _from_pandas(rows, _EVENT)]))
        n = events.num_rows
        inserts = (order < held.num_rows) & (_numbers(events["kind"]) != _REMOVED)
        shown = np.minimum.reduceat(np.where(inserts, np.arange(n), n), starts)
        heads = self._keep(events, starts, timerValues.getCurrentWatermarkInMs() * 1000)
        # an event may come twice: what is shown is compared by value; nothing is of no kind
        at, seq, kind = (np.append(_numbers(events[c]), -1) for c in ("at", "seq", "kind"))
        new = np.flatnonzero(np.logical_or.reduce([c[heads] != c[shown] for c in (at, seq, kind)]))
        for i in range(0, len(new), _OUT):
            some = new[i : i + _OUT]
            pairs = events.select(["user", "property_id"]).take(pa.array(starts[some])).to_pandas()
            yield pairs.assign(at=at[heads[some]], seq=seq[heads[some]], kind=kind[heads[some]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events = _unpacked(self._state.get())
        pair = _codes(events["user"], events["property_id"])
        self._keep(events, np.flatnonzero(_begins(pair)), expiredTimerInfo.getExpiryTimeInMs() * 1000)
        return iter(())

    def close(self) -> None:
        pass


def preference_stream(events: DataFrame, late: str = "30 days", parts: int = PARTS) -> DataFrame:
    """Preferences as events (user_id, property_id, action, ts, seq) arrive, in any order within ``late``.

    A row is written when a pair's preference changes; without a type it is gone. State is kept
    in ``parts`` parts of the pairs. Inserts that no removal can reach any more are dropped
    when their part sees events, and when its last insert is out of reach.
    """
    removal = F.col("action") == "remove"
    # a removal without a user or id finds no pair, as in ``replay_preferences``
    some = F.col("action").isin(_TYPES) | (removal & F.col("user_id").isNotNull() & F.col("property_id").isNotNull())
    rows = events.where(some).withWatermark("ts", late)
    kind = F.when(removal, _REMOVED).when(F.col("action") == "hidden", 1).otherwise(0)
    found = rows.select(
        _part(parts, *KEY),
        F.col("user_id").cast("string").alias("user"),
        "property_id",
        F.coalesce(F.unix_micros("ts"), F.lit(_NEVER)).alias("at"),
        F.coalesce(F.col("seq"), F.lit(_NEVER)).cast("bigint").alias("seq"),
        kind.cast("bigint").alias("kind"),
        "ts",
    ).groupBy("part").transformWithStateInPandas(
        Preferences(), "user string, property_id string, at bigint, seq bigint, kind bigint", "Update", "EventTime"
    )
    there = F.col("kind") >= 0
    return found.select(
        F.col("user").cast("bigint").alias("user_id"),
        "property_id",
        F.when(F.col("kind") == 0, _TYPES[0]).when(F.col("kind") == 1, _TYPES[1]).alias("preference_type"),
        F.when(there & (F.col("at") != _NEVER), F.timestamp_micros("at")).alias("created_at"),
        F.when(there & (F.col("seq") != _NEVER), F.col("seq")).alias("created_seq"),
    )


# -- status -----------------------------------------------------------------------------------


def status_stream(events: DataFrame) -> DataFrame:
    """Current status per pair, updated as (user_id, property_id, status, error, ts, seq) arrive.

    Every part of the state is a maximum or a sum, so events may come in any order, and
    Spark's own aggregates combine them before they meet.
    """
    return status_view(merge_status(status_parts(events)))
