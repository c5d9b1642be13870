from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from homestrata.operators import preferences, pricing, stats
from homestrata.schemas import TRACKED_URLS, struct
from homestrata.sources import epochs
from homestrata.sources.epochs import BucketTable, EpochLog
from homestrata.streaming import dedup, incremental, keyed, medians

from test_operators import EVENTS, observations, preference_log


@pytest.fixture
def as_stream(spark, tmp_path):
    """Write rows as one file per batch, oldest first, and read them as a stream."""

    def make(df, parts, order, name="in"):
        folder = str(tmp_path / name)
        rows = df.orderBy(*order).collect()
        size = -(-len(rows) // parts)
        for i in range(parts):
            chunk = spark.createDataFrame(rows[i * size : (i + 1) * size], df.schema)
            chunk.coalesce(1).write.mode("append").parquet(folder)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return make


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a, b = (sorted(map(str, d.select(*columns).collect())) for d in (left, right))
    assert a == b


def price_tables(spark, folder):
    state = BucketTable(spark, f"{folder}/state", pricing.STATE_SCHEMA, ["property_id"], buckets=4)
    return state, EpochLog(spark, f"{folder}/changes", pricing.CHANGES_SCHEMA)


# -- tables ------------------------------------------------------------------------------------

KV = struct("k bigint, v bigint")


def test_one_changed_row_rewrites_one_bucket(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), KV, ["k"], buckets=8)
    assert table.read().collect() == []
    table.write(spark.createDataFrame([(k, 0) for k in range(100)] + [(None, 0)], KV))
    table.write(spark.createDataFrame([(5, 1)], KV), "00000001-a", 0)
    new = table.stored().where("run <> '-'")
    assert new.select("bucket").distinct().count() == 1
    assert new.count() == table.current(among=table.buckets_of(spark.createDataFrame([(5, 1)], KV))).count() < 40
    table.write(spark.createDataFrame([(None, 7)], KV), "00000001-a", 1, deleted=spark.createDataFrame([(5, 0), (6, 0)], KV))
    got = {r.k: r.v for r in table.read().collect()}
    assert got == {k: 0 for k in range(100) if k not in (5, 6)} | {None: 7}


def test_a_repeated_batch_reads_what_was_before_it(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), KV, ["k"], buckets=2)
    add = lambda df, e: table.write(
        df.unionByName(table.of(df, "00000001-a", e).join(df.select("k"), "k", "left_semi")).groupBy("k").agg(F.sum("v").alias("v")), "00000001-a", e
    )
    one = spark.createDataFrame([(1, 1), (2, 1)], KV)
    for epoch in (0, 1, 1, 1, 2):
        add(one, epoch)
    assert sorted(map(tuple, table.read().collect())) == [(1, 3), (2, 3)]
    # a bucket that loses all its rows stays empty
    table.write(table.read().limit(0), "00000001-a", 3, deleted=one)
    assert table.read().collect() == []


def test_reading_does_not_grow_with_batches(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), KV, ["k"], buckets=4)
    read = []
    for epoch in range(6):
        rows = spark.createDataFrame([(k, epoch) for k in range(20)], KV)
        table.write(rows, "00000001-a", epoch)
        read.append(table.of(rows, "00000001-a", epoch + 1).count())
    assert read == [20] * 6
    small = table.compact_to(str(tmp_path / "t2"), keep=F.col("k") < 10)
    assert sorted(map(tuple, small.read().collect())) == [(k, 5) for k in range(10)]


def test_runs_are_numbered_and_found_again(spark, tmp_path):
    log = EpochLog(spark, str(tmp_path / "l"), KV)
    first = log.run_of("q")
    log.write(spark.createDataFrame([(1, 1)], KV), first, 0)
    assert log.run_of("q") == first == "00000001-q"
    assert log.run_of("r") == "00000002-r"
    log.write(spark.createDataFrame([(1, 2)], KV), log.run_of("r"), 0)
    assert log.run_of("q") == first
    assert [tuple(r) for r in incremental.newest(log, ["k"]).collect()] == [(1, 2)]


# -- prices ------------------------------------------------------------------------------------


@pytest.mark.parametrize("target_rows", [100_000, 200])
def test_price_stream_equals_batch(spark, tmp_path, as_stream, target_rows):
    _, df = observations(spark, seed=11)
    state, changes = price_tables(spark, tmp_path)
    handle = incremental.track_prices(state, changes, ["tie"], target_rows)
    query = incremental.run_available(as_stream(df, 4, ["ts", "tie"]), handle, str(tmp_path / "cp"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    batch = pricing.replay_changes(df, ["tie"])
    same(changes.read(), batch)
    same(pricing.tracked_state(changes.read()), pricing.tracked_state(batch))


def test_retried_batch_is_idempotent(spark, tmp_path):
    _, df = observations(spark, seed=12)
    state, changes = price_tables(spark, tmp_path)
    handle = incremental.track_prices(state, changes, ["tie"])
    middle = dt.datetime(2024, 2, 10)
    handle(df.where(F.col("ts") < F.lit(middle)), 0)
    for _ in range(2):
        handle(df.where(F.col("ts") >= F.lit(middle)), 1)
    same(changes.read(), pricing.replay_changes(df, ["tie"]))


def test_new_checkpoint_loses_nothing(spark, tmp_path, as_stream):
    _, df = observations(spark, seed=13)
    state, changes = price_tables(spark, tmp_path)
    middle = F.lit(dt.datetime(2024, 2, 10))
    for name, part in (("a", df.where(F.col("ts") < middle)), ("b", df.where(F.col("ts") >= middle))):
        handle = incremental.track_prices(state, changes, ["tie"])
        incremental.run_available(as_stream(part, 2, ["ts", "tie"], name), handle, str(tmp_path / f"cp-{name}"))
    same(changes.read(), pricing.replay_changes(df, ["tie"]))


def test_keyed_prices_equal_batch(spark, tmp_path, as_stream):
    """Several batches, one listing with most of the rows, NULL times and prices among them."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["HOT"] * 6 + ["A", "B", None]), None if rng.random() < 0.01 else start + dt.timedelta(hours=i // 3), i,
             rng.choice([None, 0, 100, 100, 110, 120])) for i in range(1500)]
    df = spark.createDataFrame(rows, "property_id string, ts timestamp, tie bigint, price bigint")
    log = EpochLog(spark, str(tmp_path / "c"), pricing.CHANGES_SCHEMA)
    changes = keyed.price_changes_stream(as_stream(df, 3, [F.col("ts").asc_nulls_first(), "tie"]), ["tie"])
    query = incremental.run_available(changes, incremental.write_log(log), str(tmp_path / "cp"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    same(log.read(), pricing.replay_changes(df, ["tie"]))


def state_rows(query):
    """The most rows that the stream's state has held."""
    return max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])


def test_keyed_prices_are_kept_by_part(spark, tmp_path, as_stream):
    """Calls and state rows follow the parts, not the listings; so do those of one call that come again."""
    start = dt.datetime(2024, 1, 1)
    rows = [(f"P{i % 300}", start + dt.timedelta(days=i // 300), i, 100 + 10 * (i * i % 7)) for i in range(1200)]
    df = spark.createDataFrame(rows, "property_id string, ts timestamp, tie bigint, price bigint")
    log = EpochLog(spark, str(tmp_path / "c"), pricing.CHANGES_SCHEMA)
    changes = keyed.price_changes_stream(as_stream(df, 2, ["ts", "tie"]), ["tie"], parts=8)
    query = incremental.run_available(changes, incremental.write_log(log), str(tmp_path / "cp"))
    assert 0 < state_rows(query) <= 8
    same(log.read(), pricing.replay_changes(df, ["tie"]))


def test_expiry_stream_equals_batch(spark, tmp_path, as_stream):
    _, df = observations(spark, seed=14)
    history = pricing.history_rows(pricing.replay_changes(df, ["tie"]), keep_days=20)
    history = history.select("property_id", "change_no", "ts", "expires_at")
    last = history.agg(F.max("ts")).first()[0]
    schema = "property_id string, change_no bigint, ts timestamp, expires_at timestamp"
    for name, at in (("a", last - dt.timedelta(days=5)), ("b", last + dt.timedelta(days=30))):
        ticks = spark.createDataFrame([(None, None, at + dt.timedelta(days=1, milliseconds=k), None) for k in (1, 2)], schema)
        log = EpochLog(spark, str(tmp_path / f"e{name}"), keyed.EXPIRY)
        known = history.where(F.col("ts") <= F.lit(at)).unionByName(ticks)
        events = keyed.expiring_history(as_stream(known, 4, ["ts"], name), late="1 day")
        incremental.run_available(events, incremental.write_log(log), str(tmp_path / f"cp{name}"))
        want = pricing.unexpired(history.where(F.col("ts") <= F.lit(at)), F.lit(at))
        same(keyed.unexpired_rows(log.read()), want.select("property_id", "change_no", "expires_at"))
        gone = log.read().where("expired")
        assert gone.count() == gone.distinct().count() > 0
    assert keyed.unexpired_rows(log.read()).count() == 0


def test_expiry_reads_a_month_once_a_batch(spark, tmp_path, as_stream):
    """Days that pass together expire together; a row without a last day is neither held nor expires."""
    start = dt.datetime(2024, 1, 1)
    rows = [(f"P{i % 50}", i, start + dt.timedelta(minutes=i), start + dt.timedelta(days=40, hours=i)) for i in range(600)]
    rows += [("NONE", 1, None, None), (None, None, start + dt.timedelta(days=55), None)]
    df = spark.createDataFrame(rows, "property_id string, change_no bigint, ts timestamp, expires_at timestamp")
    log = EpochLog(spark, str(tmp_path / "e"), keyed.EXPIRY)
    events = keyed.expiring_history(as_stream(df, 1, ["ts"]), parts=2)
    query = incremental.run_available(events, incremental.write_log(log), str(tmp_path / "cp"))
    # four groups, each with one packed list, its size and one timer in two indexes; not a row or timer per hour
    assert 0 < state_rows(query) <= 4 * 5
    at = start + dt.timedelta(days=54)
    assert log.read().where("expired").count() == df.where(F.col("expires_at") < F.lit(at)).count()
    same(keyed.unexpired_rows(log.read()), df.where(F.col("expires_at") >= F.lit(at)).select("property_id", "change_no", "expires_at"))


# -- preferences and status --------------------------------------------------------------------


def test_preference_stream_equals_batch(spark, tmp_path, as_stream):
    df = spark.createDataFrame(preference_log(900, seed=8), EVENTS)
    table = BucketTable(spark, str(tmp_path / "p"), preferences.STATE_SCHEMA, preferences.KEY, buckets=4)
    incremental.run_available(as_stream(df, 3, ["ts", "seq"]), incremental.track_preferences(table), str(tmp_path / "cp"))
    same(table.read(), preferences.replay_preferences(df))


@pytest.mark.parametrize("late", ["3650 days", "0 seconds"])
def test_late_preference_events_fold_in_order(spark, tmp_path, as_stream, late):
    """Shuffled batches while all may be late; batches in order when none may."""
    df = spark.createDataFrame(preference_log(900, seed=9), EVENTS)
    # one event a second, so that batches in order have no ties at their edges
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq")))
    order = [F.hash("seq")] if late != "0 seconds" else ["seq"]
    log = EpochLog(spark, str(tmp_path / "p"), keyed.PREFERENCE_EVENTS)
    stream = keyed.preference_stream(as_stream(df, 4, order), late)
    incremental.run_available(stream, incremental.write_log(log), str(tmp_path / "cp"), "update")
    found = incremental.newest(log, preferences.KEY).where(F.col("preference_type").isNotNull())
    same(found, preferences.replay_preferences(df))


def test_preferences_are_kept_by_part(spark, tmp_path, as_stream):
    """State rows follow the parts, not the pairs; users, ids and times may be NULL, events come twice."""
    rng = random.Random(10)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice([None, 2**60 + rng.randint(1, 9)]), rng.choice([None, *"ABCDEFGH"]), rng.choice(["favorite", "hidden", "remove", "odd"]),
             start + dt.timedelta(seconds=i) if rng.random() < 0.95 else None, i) for i in range(900)]
    df = spark.createDataFrame(rows + rows[::7], EVENTS)
    log = EpochLog(spark, str(tmp_path / "p"), keyed.PREFERENCE_EVENTS)
    stream = keyed.preference_stream(as_stream(df, 3, [F.hash("seq")]), "3650 days", parts=4)
    query = incremental.run_available(stream, incremental.write_log(log), str(tmp_path / "cp"), "update")
    assert 0 < state_rows(query) <= 3 * 4  # a row a part, and its timer in two indexes
    found = incremental.newest(log, preferences.KEY).where(F.col("preference_type").isNotNull())
    same(found, preferences.replay_preferences(df))


def test_status_stream_equals_batch(spark, tmp_path, as_stream):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.randint(1, 3), f"P{rng.randint(1, 5)}", s, f"e{i}" * 300 if s == "failed" else None, start + dt.timedelta(seconds=rng.randint(0, 500)), i)
            for i in range(800) for s in [rng.choice(["processing", "completed", "failed"])]]
    df = spark.createDataFrame(rows, "user_id bigint, property_id string, status string, error string, ts timestamp, seq bigint")
    want = preferences.replay_status(df)
    # shuffled arrival: the state does not depend on order
    log = EpochLog(spark, str(tmp_path / "t"), want.schema)
    stream = keyed.status_stream(as_stream(df, 3, [F.hash("seq")]))
    incremental.run_available(stream, incremental.write_log(log), str(tmp_path / "cp"), "update")
    same(incremental.newest(log, preferences.KEY), want)
    state = BucketTable(spark, str(tmp_path / "s"), preferences.STATUS_STATE, preferences.KEY, buckets=4)
    folded = as_stream(df, 3, [F.hash("seq")], name="again")
    incremental.run_available(folded, incremental.track_status(state), str(tmp_path / "cp2"))
    same(preferences.status_view(state.read()), want)


# -- crawls and analysis -----------------------------------------------------------------------


def test_dedup_stream(spark, tmp_path, as_stream):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"u{rng.randint(0, 40)}", start + dt.timedelta(hours=i)) for i in range(300)]
    df = spark.createDataFrame(rows, "url string, ts timestamp_ntz")
    log = EpochLog(spark, str(tmp_path / "u"), struct("url string, ts timestamp"))
    stream = dedup.first_seen_stream(as_stream(df, 3, ["ts"]), within="365 days")
    incremental.run_available(stream, incremental.write_log(log), str(tmp_path / "cp"))
    assert sorted(r.url for r in log.read().collect()) == sorted({r[0] for r in rows})


def test_first_seen_for_all_time(spark, tmp_path, as_stream):
    """URLs come back after years."""
    rng = random.Random(5)
    start = dt.datetime(2000, 1, 1)
    rows = [(f"u{rng.randint(0, 300)}" if rng.random() < 0.98 else None, start + dt.timedelta(days=10 * i)) for i in range(900)]
    df = spark.createDataFrame(rows, "url string, ts timestamp")
    urls = BucketTable(spark, str(tmp_path / "u"), df.schema, ["url"], buckets=4)
    filters = BucketTable(spark, str(tmp_path / "f"), dedup.FILTER, ["part"], buckets=3)
    query = incremental.run_available(as_stream(df, 3, ["ts"]), dedup.track_first_seen(urls, filters, parts=3), str(tmp_path / "cp"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    want = df.where("url IS NOT NULL").groupBy("url").agg(F.min("ts").alias("ts"))
    same(urls.read(), want)
    assert {len(r.bits) for r in filters.read().collect()} == {dedup.BITS // 8} and filters.read().count() == 3


def test_crawl_stream(spark, tmp_path, as_stream):
    kinds = ["bigint", "bigint", "bigint", "double", "bigint", "double", "bigint", "timestamp"]
    known = spark.createDataFrame([("PROP#1", "META", "", 100, None), ("PROP#2", "META", "", 200, None)],
        "property_id string, sort_key string, listing_url string, price bigint, analysis_date date")
    for name, kind in zip(pricing.TRACKING_COLUMNS[1:], kinds):
        known = known.withColumn(name, F.lit(None).cast(kind))
    listings = BucketTable(spark, str(tmp_path / "l"), known.schema, ["property_id"], buckets=4)
    listings.write(known)
    tracked = BucketTable(spark, str(tmp_path / "t"), TRACKED_URLS, ["url"], buckets=4)
    runs = struct("total_urls_found bigint, new_urls_tracked bigint, existing_listings bigint, price_changed_listings bigint, run_at timestamp")
    summaries = EpochLog(spark, str(tmp_path / "r"), runs)
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [("c", 1, i, f"/x/home/{i}", 100 * i, None, day(1)) for i in (1, 2)]
    rows += [("c", 1, 1, "/x/home/1", 110, None, day(2)), ("c", 2, 1, "/x/home/1", 999, None, day(2))]
    rows += [("c", 1, 1, "/x/home/1", 121, None, day(3)), ("c", 1, 2, "/x/home/3", 5, "Y", day(3))]
    df = spark.createDataFrame(rows, "crawl_id string, page_no bigint, pos int, url string, price bigint, city string, ts timestamp")
    runs_of = incremental.crawl_runs(tracked, listings, summaries)
    stream = as_stream(df, 3, ["ts", "page_no", "pos"])
    incremental.run_available(stream, runs_of, str(tmp_path / "cp"))
    got = [tuple(r)[:4] for r in summaries.read().orderBy("run_at").collect()]
    assert got == [(2, 2, 0, 0), (1, 0, 0, 1), (2, 1, 0, 1)]
    one = listings.read().where("property_id = 'PROP#1'").first()
    assert (one.price, one.original_price, one.price_update_count, one.total_price_change_pct) == (121, 100, 2, 21.0)
    assert one.last_price_update == day(3)
    assert {r.url: r.city for r in tracked.read().collect()} == {"/x/home/1": None, "/x/home/2": None, "/x/home/3": "Y"}


LISTED = struct("property_id string, city string, price_per_sqft double, price bigint, lot_size_acres double, lot_size_sqft int, seq bigint")


def test_incremental_analysis_equals_the_whole(spark, tmp_path):
    """Listings come, change their price and city, lose their price; after each batch all is as analyzed anew."""
    rng = random.Random(6)
    as_of = dt.datetime(2024, 5, 1)
    tables = medians.CityTables(spark, str(tmp_path / "a"), LISTED, buckets=4)
    handle = medians.analyze_batches(tables, ["seq"], as_of)
    now, read = {}, []
    cities = ["Hot"] * 8 + [" Pad ", "Pad", "", None, "Rare"]
    for epoch in range(4):
        rows = []
        for i in range(150):
            psf = rng.choice([None, 0.0, float("nan"), -1.0, *[round(rng.uniform(1, 900), 2) for _ in range(8)]])
            key = f"P{rng.randrange(200)}" if epoch < 3 else f"P{i}"
            city = rng.choice(cities) if epoch < 3 else "Hot"  # the last batch empties cities
            rows.append((key, city, psf, rng.choice([None, 0, 1000]), rng.choice([None, 2.0]), 100, epoch * 1000 + i))
        for row in rows:
            now[row[0]] = row
        for _ in range(2 if epoch == 1 else 1):  # a retried batch changes nothing more
            handle(spark.createDataFrame(rows, LISTED), epoch)
        whole = spark.createDataFrame(list(now.values()), LISTED)
        same(tables.read(), stats.analyze(whole, as_of))
        same(tables.stats.read(), stats.city_stats(whole))
        assert tables.counts.read().agg(F.sum("n")).first()[0] == stats.usable_prices(whole).count()
        read.append(tables.enriched.current().count())
    assert read[-1] == len(now) < tables.enriched.stored().count()


def test_only_touched_cities_are_enriched(spark, tmp_path):
    tables = medians.CityTables(spark, str(tmp_path / "a"), LISTED, buckets=64)
    handle = medians.analyze_batches(tables, ["seq"], dt.datetime(2024, 5, 1))
    rows = [(f"P{i}", f"C{i % 10}", 10.0 + i, 1, None, None, i) for i in range(100)]
    handle(spark.createDataFrame(rows, LISTED), 0)
    later = medians.analyze_batches(tables, ["seq"], dt.datetime(2024, 5, 2))
    later(spark.createDataFrame([("P3", "C3", 500.0, 1, None, None, 1000)], LISTED), 1)
    anew = tables.read().where(F.col("analysis_date") == dt.date(2024, 5, 2))
    assert {r.city for r in anew.collect()} == {"C3"} and anew.count() == 10
    assert tables.stats.read().count() == 10


def test_enriched_listings_are_written_once_a_batch(spark, tmp_path, monkeypatch):
    """Whole listings go to disk as they come and as they are then, never as a third copy between."""
    tables = medians.CityTables(spark, str(tmp_path / "a"), LISTED, buckets=4)
    handle = medians.analyze_batches(tables, ["seq"], dt.datetime(2024, 5, 1))
    staged = []
    for module in (epochs, medians):
        real = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, real=real: staged.append(df.columns) or real(df, name))
    first = [("p0", "a ", 10.0), ("p1", "a", 30.0), (None, "a", 5.0), ("p2", None, 7.0), ("p3", "b", None)]
    later = [("p1", "c", 40.0), ("p3", "b", None), ("p2", "", None)]
    for epoch, rows in enumerate((first, later)):
        handle(spark.createDataFrame([(*row, 1, None, None, epoch) for row in rows], LISTED), epoch)
    assert not [columns for columns in staged if "city_discount_pct" in columns]
    rows = tables.read().select("property_id", "city", "price_per_sqft", "city_median_price_per_sqft").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [
        ("p0", "a ", 10.0, 7.5), (None, "a", 5.0, 7.5), ("p1", "c", 40.0, 40.0),
        ("p2", "", None, 0.0), ("p3", "b", None, 0.0),
    ]))
