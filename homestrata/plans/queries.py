"""Registered queries: every operator over whole given tables, read as listings."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestrata.functions import ids, prices, records
from homestrata.functions import text as text_rules
from homestrata.functions.common import non_blank
from homestrata.operators import (
    collect,
    compare,
    extract,
    mutate,
    ordered,
    preferences,
    pricing,
    profile,
    save,
    search,
    stats,
)
from homestrata.plans import standins as s
from homestrata.schemas import TRACKED_URLS, struct
from homestrata.sources import html, tables
from homestrata.sources.epochs import BucketTable, EpochLog
from homestrata.sources.staging import stage, staging_root
from homestrata.streaming import dedup, incremental, keyed, medians

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Buckets of the tables that the stream queries keep; the library's default suits larger ones.
_BUCKETS = 16


def query(fn: Callable[[s.Tables], DataFrame]) -> Callable[[s.Tables], DataFrame]:
    """Register ``fn(tables)`` under its own name."""
    REGISTRY[fn.__name__] = lambda spark, sf_dir: fn(s.Tables(spark, sf_dir))
    return fn


def _listing_table(t: s.Tables, *columns: str) -> DataFrame:
    """Some columns of the listing view as a stored table, for what reads them more than once."""
    return stage(s.listings(t).select(*columns), "listings")


# --- scans, lookups, sinks ---------------------------------------------------------


@query
def q_scan_current(t):
    return tables.current_listings(s.listings(t)).select("property_id", "price", "city")


@query
def q_known_listings(t):
    return tables.known_listings(s.known(t))


@query
def q_known_second_token(t):
    """Orders under keys of several tokens, read up to the second as older keys were."""
    key = F.concat(ids.build_key(F.col("o_orderkey").cast("string"), "o_orderdate"), F.lit("_"), F.col("o_custkey"))
    rows = t.orders.select(
        key.alias("property_id"),
        F.lit("META").alias("sort_key"),
        F.floor("o_totalprice").alias("price"),
        F.lit("").alias("listing_url"),
        F.to_date("o_orderdate").alias("analysis_date"),
    )
    return tables.known_listings(rows, url_id=None, second_token_only=True)


@query
def q_tracked_urls(t):
    """All but one city, rows without a city included; and that city alone."""
    rows = s.tracked(t)
    others = tables.tracked_urls(rows, exclude_city="NATION_3").withColumn("part", F.lit("others"))
    city = tables.tracked_urls(rows, city="NATION_3").withColumn("part", F.lit("city"))
    return others.unionByName(city)


@query
def q_unprocessed(t):
    return tables.unprocessed_urls(s.tracked(t), with_details=True)


@query
def q_unprocessed_batch(t):
    return tables.unprocessed_batch(s.tracked(t))


@query
def q_keyed_lookup(t):
    wanted = s.status_events(t).select("property_id")
    return tables.lookup(s.listings(t), wanted, ["property_id"]).select("property_id", "price")


@query
def q_city_by_psf(t):
    return tables.by_city(s.listings(t), "NATION_3")


@query
def q_city_newest(t):
    rows = tables.by_city(s.listings(t), "NATION_3", order="analysis_date")
    return rows.select("city", "property_id", "analysis_date", "rank")


@query
def q_track_new_urls(t):
    fresh = collect.new_urls(s.observations(t), s.tracked(t))
    return collect.track_urls(s.tracked(t), fresh, default_city="Unknown")


@query
def q_track_ward_urls(t):
    """Tracking rows of the older tables, which call a URL's place its ward."""
    seen = s.observations(t).select("url", F.col("city").alias("ward"), "price")
    return collect.tracking_rows(seen, default_city="unknown", place="ward")


@query
def q_summary_sink(t):
    """The summary of processed URLs, counted by the write of its rows, written and read again."""
    folder = _folder(t)
    counted = tables.write_observed(_processed(t), f"{folder}/results", save.processing_metrics(F.col("error")))
    tables.write_summary(counted, f"{folder}/summary")
    return tables.read_summary(t.spark, f"{folder}/summary", counted.schema)


@query
def q_listing_dump(t):
    rows = s.observations(t).withColumn("price_text", prices.price_display("price"))
    return profile.flag_duplicates(rows, ["url"]).select("url", "price", "price_text", "duplicate")


# --- pages -------------------------------------------------------------------------


@query
def q_pages_scan(t):
    return t.pages.select("page_id", "url", F.length("html").alias("n_chars"))


@query
def q_page_text(t):
    """Visible text of every given page."""
    return html.read_pages(t.pages.select("page_id", "html"), ["text"])


@query
def q_page_links(t):
    """Every link of every given page."""
    found = html.read_pages(t.pages.select("page_id", "html"), ["links"])
    return found.select("page_id", F.inline("links")).select("page_id", "pos", "href")


@query
def q_listing_links(t):
    links = collect.listing_links(s.result_pages(t), "city", "state")
    return collect.first_seen(links).drop("page_no")


@query
def q_page_meta(t):
    read = html.read_pages(s.detail_pages(t).select("url", "html"), ["metas"])
    return read.select("url", *[c.alias(n) for n, c in extract.meta_fields("metas").items()])


@query
def q_extract_listings(t):
    """Full records of detail pages: tags, structured data, text and photos merged."""
    rows = extract.extract_listings(s.detail_pages(t), s.AS_OF)
    return rows.drop("error", "extraction_timestamp", "listing_source").withColumns(
        {n: F.array_join(n, " ") for n in ("image_urls", "amenities")}
    )


@query
def q_json_props(t):
    """Structured-data rules on items built from events."""
    k = F.get_json_object("props", "$.k")
    kind = F.when(F.col("event_type") == "view", '"House"').when(
        F.col("event_type") == "click", '["Thing", "Residence"]'
    )
    item = F.concat(
        F.lit('{"@type": '), F.coalesce(kind, F.lit('"Event"')), F.lit(', "offers": {"price": '),
        (F.col("value") * 1000).cast("string"), F.lit('}, "mainEntity": {"yearBuilt": "19'), k, F.lit('"}}'),
    )
    scripts = F.array(F.lit("{not json"), item, F.concat(F.lit("["), item, F.lit("]")))
    rows = t.events.select("event_id", extract.ld_items(scripts).alias("ld_items"))
    fields = extract.ld_fields("ld_items")
    return rows.select("event_id", F.size("ld_items").alias("n_items"), fields["price"].alias("price"),
                       fields["year_built"].alias("year_built"))


# --- search ------------------------------------------------------------------------

_SEARCH = {
    "state": "AMERICA", "min_price": 50000, "max_price": 400000, "min_beds": 2, "max_beds": 6,
    "min_baths": 1.5, "min_sqft": 300, "max_sqft": 2500, "property_type": "", "city": None,
}


def _shown(found: DataFrame) -> DataFrame:
    return found.drop("image_urls")


@query
def q_search(t):
    return _shown(search.search(s.listings(t), _SEARCH))


@query
def q_search_page(t):
    """One page of the search API for a user, best prices of all matches first."""
    prefs = preferences.replay_preferences(s.preference_events(t))
    params = {**_SEARCH, "sort": "price_desc", "limit": 50}
    page = search.search_page(s.listings(t), prefs, params, user_id=8, global_sort=True)
    return page.select("property_id", "price", "image_url", "is_favorited")


def _ranked(rows: DataFrame, sort: str) -> DataFrame:
    """The order of a bounded result as a column, so that it can be compared."""
    order = Window.orderBy(*search.sort_columns(rows, sort))
    return rows.withColumn("rank", F.row_number().over(order).cast("bigint"))


def _sorted(name: str):
    def run(t):
        return _ranked(search.top_k(s.listings(t), name, 1000), name).select("property_id", "rank")

    run.__name__ = f"q_sort_{name}"
    return query(run)


for _name in search.SORTS:
    _sorted(f"{_name}_asc")
    _sorted(f"{_name}_desc")


@query
def q_top_k(t):
    found = search.search(s.listings(t), {"min_beds": 3})
    return search.top_k(found, "price_per_sqft_asc", 25).select("property_id", "price_per_sqft")


@query
def q_page_sort(t):
    page = search.next_page(s.listings(t), None, 100)
    return _ranked(search.sort_page(page, "beds_desc"), "beds_desc").select("property_id", "beds", "rank")


@query
def q_keyset_page(t):
    return search.next_page(s.listings(t), "PROP#300", 1000).select("property_id", "price")


@query
def q_keyset_pages(t):
    """All pages of 1000 listings in id order, with the size and the cursor of each."""
    pages = search.all_pages(s.listings(t).select("property_id", "price"), 1000)
    return pages.select("page_no", "property_id", "price", "total_in_page", "next_cursor")


@query
def q_is_favorited(t):
    prefs = preferences.replay_preferences(s.preference_events(t))
    flagged = search.flag_favorites(s.listings(t), search.favorite_ids(prefs, 8))
    return flagged.select("property_id", "is_favorited")


@query
def q_user_prefs(t):
    prefs = preferences.replay_preferences(s.preference_events(t))
    listed = search.user_preferences(prefs, 8, "hidden")
    return listed.select("property_id", "preference_type", "created_at", "rank")


# --- scalar functions --------------------------------------------------------------


@query
def q_parse_price(t):
    return s.texts(t).select("doc_id", prices.parse_price("price_text").alias("price"))


@query
def q_parse_price_whole_text(t):
    return s.texts(t).select("doc_id", prices.parse_price("text").alias("price"))


@query
def q_listing_id(t):
    listed = s.listings(t).select(F.col("listing_url").alias("url"))
    return (
        t.pages.select("url").unionByName(listed).select("url", ids.listing_id("url").alias("raw_id"))
    )


@query
def q_listing_id_chain(t):
    """Older URL shapes built from orders, and the addresses of the given pages."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    portal = F.concat(F.lit("https://portal.example/realestateandhomes-detail/"), key)
    url = (
        F.when(kind == "1-URGENT", F.concat(portal, F.lit("-Main-St_M"), key, F.lit("-77")))
        .when(kind == "2-HIGH", F.concat(portal, F.lit("-Main-St_m"), key))
        .when(kind == "3-MEDIUM", F.concat(portal, F.lit("-Main/St?x=1")))
        .when(kind == "5-LOW", F.concat(F.lit("https://x.example/p?property_id="), key))
        .otherwise(F.concat(F.lit("https://x.example/90000"), F.lpad(key, 9, "0"), F.lit("/ABCDEFGH12")))
    )
    rows = t.orders.select(url.alias("url")).unionByName(t.pages.select("url"))
    return rows.select(
        "url",
        ids.portal_listing_id("url").alias("portal_id"),
        ids.legacy_listing_id("url").alias("legacy_id"),
    )


@query
def q_id_keys(t):
    raw = F.concat(F.col("o_orderkey").cast("string"), F.lit("_"), F.col("o_custkey").cast("string"))
    dated = ids.build_key(raw, "o_orderdate")
    plain = ids.build_key(F.col("o_orderkey").cast("string"))
    return t.orders.select(
        dated.alias("dated_key"),
        plain.alias("plain_key"),
        ids.parse_key(dated).alias("dated_raw"),
        ids.parse_key(plain).alias("plain_raw"),
        ids.parse_key(dated, second_token_only=True).alias("second_token"),
    )


@query
def q_text_fields(t):
    return s.texts(t).select(
        "doc_id",
        text_rules.year_built("text", s.AS_OF.year).alias("year_built"),
        text_rules.lot_acres("text").alias("lot_size_acres"),
        text_rules.lot_sqft("text").alias("lot_size_sqft"),
        text_rules.hoa_fee("text").alias("hoa_fee"),
        text_rules.days_on_market("text").alias("days_on_market"),
        text_rules.mls_number("text").alias("mls_number"),
    )


@query
def q_property_type(t):
    return s.texts(t).select("doc_id", text_rules.property_type("text").alias("property_type"))


@query
def q_to_decimal(t):
    return t.lineitem.groupBy(prices.to_stored_decimal(F.col("l_extendedprice") / 7).alias("value")).agg(
        F.count("*").alias("n")
    )


@query
def q_price_per_sqft(t):
    return s.listings(t).select("property_id", "price_per_sqft")


@query
def q_price_per_acre(t):
    ppa = prices.price_per_acre("price", "lot_size_acres", "lot_size_sqft")
    return s.listings(t).select("property_id", ppa.alias("price_per_acre"))


@query
def q_market_position(t):
    enriched = stats.analyze(s.listings(t), s.AS_OF)
    return enriched.select(
        "property_id",
        prices.discount_bucket("city_discount_pct").alias("bucket"),
        prices.market_position("city_discount_pct").alias("market_position"),
        prices.price_display("price").alias("price_display"),
    )


@query
def q_discount_class(t):
    enriched = stats.analyze(s.listings(t), s.AS_OF)
    return enriched.select("property_id", prices.discount_class("city_discount_pct").alias("discount_class"))


@query
def q_verdict(t):
    """Reports made of conversation turns, opened by a verdict line per role and turn."""
    opening = (
        F.when(F.col("role") == "system", "Verdict: PASS. ")
        .when(F.col("turn") == 0, "A Strong Buy. ")
        .when(F.col("turn") == 1, "My verdict: buy it. ")
        .otherwise("Buy? ")
    )
    report = F.concat(opening, "text")
    return t.conversations.select("conv_id", "turn", text_rules.verdict(report).alias("verdict"))


@query
def q_truncate(t):
    size = F.octet_length("text") * 2
    return t.documents.select(
        "doc_id",
        text_rules.truncate_report("text", size, size_limit=20000, keep=5000).alias("report"),
        text_rules.cut("text").alias("error_text"),
    )


@query
def q_array_prefix(t):
    image_urls = F.col("image_urls")
    return s.listings(t).select(
        "property_id",
        F.get(image_urls, F.lit(0)).alias("image_url"),
        F.array_join(F.slice(image_urls, 1, preferences.IMAGES_SHOWN), " ").alias("shown"),
        F.array_join(F.slice(image_urls, 1, save.IMAGES_STORED), " ").alias("stored"),
        F.size(image_urls).alias("image_count"),
    )


# --- records -----------------------------------------------------------------------


@query
def q_sparse_prune(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderstatus") == "O", 0.0).otherwise(F.col("o_totalprice")).alias("amount"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    return records.prune(rows, never=("o_orderkey",))


@query
def q_sparse_prune_keep(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderstatus") == "O", 0.0).otherwise(F.col("o_totalprice")).alias("price"),
        (F.col("o_orderpriority") == "1-URGENT").alias("good_lighting"),
    )
    return records.prune(rows, keep_zero=records.KEEP_ZERO, never=("o_orderkey",))


@query
def q_record_defaults(t):
    """Older-market records from orders; known prices are those of urgent and high orders."""
    kind = F.col("o_orderpriority")
    pid = F.concat(F.lit("PROP#"), F.col("o_orderkey").cast("string"))
    rows = t.orders.select(
        pid.alias("property_id"),
        F.concat(F.lit("/p/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.when(kind != "3-MEDIUM", F.floor("o_totalprice").cast("string")).otherwise("n/a").alias("price"),
        F.when(kind == "5-LOW", "").otherwise(F.concat(F.lit("ward "), kind)).alias("ward"),
        F.when(kind == "2-HIGH", "2").alias("floor"),
        F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("用途地域"),
        F.when(F.col("o_orderstatus") == "F", "south").alias("向き"),
        F.when(F.col("o_orderstatus") == "O", "east").alias("orientation"),
    )
    known = t.orders.where(kind <= "2-HIGH").select(
        F.col("o_orderkey").cast("string").alias("raw_id"),
        F.round(F.col("o_totalprice") / 2 - 500).cast("bigint").alias("price"),
    )
    record = records.legacy_record(rows, known)
    shown = ["property_id", "listing_url", "price", "previous_price", "ward", "district_key", "floor"]
    shown += ["zoning", "direction_facing", "orientation", "size_sqm", "good_lighting", "image_count"]
    return record.select(*shown)


@query
def q_field_precedence(t):
    """Price and name of an order over three sources, each with gaps."""
    status = F.col("o_orderstatus")
    meta = F.when(status == "F", F.col("o_totalprice")).otherwise(0.0)
    ld = F.when(status == "O", F.col("o_totalprice") * 2)
    page = F.col("o_totalprice") * 3
    return t.orders.select(
        "o_orderkey",
        records.first_present(meta, ld, page, kind="double").alias("price"),
        records.first_present(
            F.when(status == "F", ""), F.when(status == "P", "ld name"), F.col("o_orderpriority"), kind="string"
        ).alias("name"),
    )


@query
def q_save_listings(t):
    """Orders re-extracted with a new price are saved over the known listings."""
    extracted = s.observations(t).select(
        ids.build_key(ids.listing_id("url")).alias("property_id"),
        F.col("url").alias("listing_url"),
        F.when(F.col("price") < 10000, "403 Forbidden").alias("error"),
        "price",
        "city",
        F.lit("").alias("parking"),
        F.lit(s.AS_OF).cast("timestamp").alias("extraction_timestamp"),
    )
    saved = save.save_listings(s.known(t), save.listing_records(extracted, s.AS_OF))
    shown = ["property_id", "listing_url", "price", "city", "parking", "listing_status"]
    return saved.select(*shown, "first_seen_date", "analysis_date", "beds")


@query
def q_saveable(t):
    """Extracted orders without those that failed, have no id or are to be skipped."""
    kind = F.col("o_orderpriority")
    extracted = t.orders.select(
        F.when(kind != "1-URGENT", F.col("o_orderkey").cast("string")).otherwise("").alias("property_id"),
        F.when(F.col("o_totalprice") < 5000, "500 Server Error").alias("error"),
        F.when(F.col("o_orderstatus") == "P", "pending").alias("skip_reason"),
    )
    return save.saveable(extracted).select("property_id")


@query
def q_city_fallback(t):
    extracted = s.listings(t).select(
        "property_id",
        "listing_url",
        F.when(F.col("property_type") == "2-HIGH", "").otherwise(F.col("city")).alias("city"),
    )
    return save.fill_city(extracted, s.tracked(t))


@query
def q_process_summary(t):
    return save.processing_summary(_processed(t))


def _processed(t):
    error = F.when(F.col("o_totalprice") < 5000, "500 Server Error").when(
        F.col("o_orderpriority") == "5-LOW", "403 Forbidden"
    )
    return t.orders.select(F.col("o_orderkey").cast("string").alias("url"), error.alias("error"))


@query
def q_process_errors(t):
    return save.processing_errors(_processed(t))


@query
def q_id_reuse(t):
    """Raw ids of all orders against dated keys of the delivered ones, some twice."""
    old = t.orders.where(F.col("o_orderstatus") == "F")
    raw = F.col("o_orderkey").cast("string")
    again = old.where(F.col("o_orderpriority") == "1-URGENT")
    stored = old.select(ids.build_key(raw, "o_orderdate").alias("property_id")).unionByName(
        again.select(ids.build_key(raw, F.lit("1999-09-09").cast("date")).alias("property_id"))
    )
    return save.reuse_keys(t.orders.select(raw.alias("raw_id")), stored, s.AS_OF.date())


# --- collecting --------------------------------------------------------------------


@query
def q_first_seen(t):
    return collect.first_seen(s.crawl_observations(t))


@query
def q_crawl_cutoff(t):
    return collect.collected(s.crawl_pages(t), s.crawl_observations(t))


def _classified(t):
    return collect.classify(s.observations(t), s.tracked(t), s.known(t))


@query
def q_classify(t):
    return _classified(t).select("url", "price", "old_price", "status")


@query
def q_new_urls(t):
    return collect.new_urls(s.observations(t), s.tracked(t)).select("url", "price", "city")


@query
def q_split_by_known_id(t):
    return collect.split_by_known_id(
        s.observations(t).select("url"), tables.known_listings(s.known(t))
    )


@query
def q_price_changes(t):
    return collect.price_changes(_classified(t))


@query
def q_collect_summary(t):
    return collect.collection_summary(_classified(t))


@query
def q_url_except(t):
    return collect.urls_except(s.observations(t), s.tracked(t))


@query
def q_url_intersect(t):
    return collect.urls_intersect(s.observations(t), s.tracked(t))


@query
def q_duplicates(t):
    return profile.flag_duplicates(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"]
    )


@query
def q_uniqueness(t):
    return profile.uniqueness(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def q_zero_price(t):
    return profile.zero_price_profile(s.price_observations(t))


# --- statistics --------------------------------------------------------------------


@query
def q_city_stats(t):
    return stats.city_stats(_listing_table(t, "city", "price_per_sqft"))


@query
def q_enrich(t):
    """Flagship: every listing with unit prices and its discount to the city median."""
    return stats.analyze(s.listings(t).drop("image_urls"), s.AS_OF).drop("last_analyzed")


@query
def q_analyze_limit(t):
    enriched = stats.analyze(s.listings(t), s.AS_OF, max_properties=500)
    return enriched.select("property_id", "city_median_price_per_sqft", "city_property_count")


@query
def q_analysis_summary(t):
    listed = _listing_table(t, "property_id", "city", "price_per_sqft")
    return stats.analysis_summary(listed, stats.city_stats(listed))


def _wards(t):
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("property_id"),
        F.when(F.col("l_returnflag") == "R", "unknown")
        .otherwise(F.concat(F.lit("W"), F.col("l_suppkey").cast("string"), "l_returnflag"))
        .alias("ward"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_per_sqm"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("size_sqm"),
        F.to_date("l_shipdate").alias("analysis_date"),
    )


@query
def q_upper_median(t):
    return stats.ward_stats(_wards(t))


@query
def q_comparables(t):
    return stats.comparables(_wards(t)).select("ward", "property_id", "analysis_date", "size_sqm")


# --- price tracking ----------------------------------------------------------------


def _changes(t):
    return pricing.replay_changes(s.price_observations(t), s.PRICE_TIES)


@query
def q_price_tracking(t):
    return pricing.tracked_state(_changes(t))


@query
def q_price_history_rows(t):
    return pricing.history_rows(_changes(t))


@query
def q_price_history(t):
    point = F.transform(
        "price_history", lambda p: F.concat_ws(":", p["date"].cast("string"), p["price"].cast("string"))
    )
    lists = pricing.history_lists(_changes(t))
    return lists.select("property_id", "chunk_no", F.array_join(point, "|").alias("history"))


@query
def q_history_expiry(t):
    kept = pricing.unexpired(pricing.history_rows(_changes(t)), F.lit(s.AS_OF))
    return kept.select("property_id", "change_no", "expires_at")


@query
def q_apply_price_changes(t):
    """Detected changes applied to the stored listings in place of their prices."""
    changes = collect.price_changes(_classified(t))
    updated = pricing.apply_changes(s.known(t), changes, F.lit(s.AS_OF).cast("timestamp"))
    return updated.select("property_id", *pricing.TRACKING_COLUMNS)


@query
def q_latest_per_key(t):
    rows = t.lineitem.select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return ordered.latest_by(rows, ["l_orderkey"], order)


# --- preferences and analyses ------------------------------------------------------


def _preferences(t):
    return preferences.replay_preferences(s.preference_events(t))


@query
def q_pref_state(t):
    return _preferences(t).drop("created_seq")


@query
def q_status_replay(t):
    return preferences.replay_status(s.status_events(t))


@query
def q_pref_summary(t):
    rows = preferences.new_preferences(_preferences(t), s.listings(t))
    summary = [
        F.col("property_summary")[n].alias(n)
        for n in ("price", "city", "state", "beds", "baths", "image_url", "listing_url")
    ]
    return rows.select("user_id", "property_id", "preference_type", "analysis_status", *summary)


def _analyzed(t):
    """Preferences with the reports finished so far; a report is the status log's outcome."""
    status = preferences.replay_status(s.status_events(t))
    done = F.col("analysis_completed_at").isNotNull()
    report = F.concat(F.lit("Verdict: buy "), "property_id")
    return (
        _preferences(t)
        .join(status, preferences.KEY, "left")
        .withColumn("analysis_result", F.when(done, preferences.analysis_result(report)))
    )


@query
def q_analysis_view(t):
    """Details of every pair that ever had an event, whether or not it is a preference."""
    requested = (
        s.status_events(t)
        .select(*preferences.KEY)
        .unionByName(s.preference_events(t).select(*preferences.KEY))
        .distinct()
    )
    view = preferences.analysis_view(requested, _analyzed(t), s.listings(t))
    return view.select(
        *preferences.KEY,
        "found",
        "analysis_status",
        F.array_join("property_images", " ").alias("images"),
        F.col("analysis_result.verdict").alias("verdict"),
    )


def _comparisons(t):
    """A comparison per event: the event's listing against another named by its user."""
    other = F.when(F.col("event_type") == "purchase", "PROP#sold").otherwise(
        F.concat(F.lit("PROP#"), F.col("user_id").cast("string"))
    )
    own = F.concat(F.lit("PROP#"), F.get_json_object("props", "$.k"))
    ids_asked = F.when(F.col("event_type") == "view", F.array(own)).otherwise(F.array(own, other))
    return t.events.select(F.col("event_id").alias("request_id"), "user_id", ids_asked.alias("property_ids"))


def _comparison_items(t):
    return compare.comparison_items(_comparisons(t), _enriched_listings(t), _analyzed(t))


def _enriched_listings(t):
    return stats.analyze(s.listings(t), s.AS_OF)


@query
def q_compare_valid(t):
    items = compare.comparison_items(_comparisons(t), s.listings(t), _analyzed(t))
    return compare.comparison_gate(items)


@query
def q_compare_prompt(t):
    return compare.comparison_prompts(_comparison_items(t))


@query
def q_comparison_record(t):
    requests = _comparisons(t).join(
        t.events.select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("requested_at")),
        "request_id",
    )
    rows = preferences.comparison_rows(requests)
    listed = F.array_join("compared_properties", " ").alias("compared")
    return rows.select("user_id", "property_id", "analysis_status", "property_count", listed)


@query
def q_prompt_text(t):
    return _enriched_listings(t).select("property_id", compare.analysis_prompt().alias("prompt"))


# --- table changes -----------------------------------------------------------------


def _stored(t):
    return t.orders.where(F.col("o_orderpriority") != "1-URGENT").select("o_orderkey", "o_orderstatus", "o_totalprice")


def _changed(t):
    return t.orders.where(F.col("o_orderstatus") == "P").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit(None).cast("double").alias("o_totalprice")
    )


@query
def q_upsert_replace(t):
    return mutate.upsert_replace(_stored(t), _changed(t), ["o_orderkey"])


@query
def q_upsert_partial(t):
    return mutate.upsert_partial(_stored(t), _changed(t), ["o_orderkey"], ["o_totalprice"])


@query
def q_update_existing(t):
    return mutate.update_existing(_stored(t), _changed(t), ["o_orderkey"], ["o_totalprice"])


@query
def q_insert_if_absent(t):
    return mutate.insert_if_absent(_stored(t), _changed(t), ["o_orderkey"])


@query
def q_delete_keys(t):
    return mutate.delete_keys(_stored(t), _changed(t), ["o_orderkey"])


@query
def q_unmatched_keys(t):
    return mutate.unmatched(_stored(t), _changed(t), ["o_orderkey"]).select("o_orderkey")


@query
def q_mark_processed(t):
    done = s.observations(t).where(non_blank("city").isNotNull() & (F.col("price") > 250000))
    return mutate.mark_processed(s.tracked(t), done)


# --- streams -----------------------------------------------------------------------


def _folder(t) -> str:
    """A new folder for one stream's state and output."""
    return f"{staging_root(t.spark)}/stream-{uuid.uuid4().hex}"


def _in_runs(t, rows: DataFrame, order: Column, folder: str, run: Callable[[DataFrame], None], runs: int = 2) -> None:
    """``rows`` as files that come run by run, in order; ``run`` processes what is there each time."""
    held = stage(rows, "source")
    marks = [k / runs for k in range(1, runs)]
    cuts = held.agg(F.percentile_approx(order, marks)).first()[0] or []
    run_no = sum((F.when(order > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    for k in range(runs):
        held.where(run_no == k).write.mode("append").parquet(f"{folder}/source")
        run(t.spark.readStream.schema(held.schema).parquet(f"{folder}/source"))


def _time(column: str) -> Column:
    return F.coalesce(F.unix_micros(column), F.lit(0))


@query
def q_stream_url_dedup(t):
    """URLs of all lines as they stream by, each once."""
    folder = _folder(t)
    seen = s.StreamTables(t.spark, t.dir).lineitem.select(
        F.concat(F.lit("/home/"), F.col("l_partkey").cast("string")).alias("url"),
        F.col("l_shipdate").alias("ts"),
    )
    log = EpochLog(t.spark, f"{folder}/urls", struct("url string, ts timestamp"))
    stream = dedup.first_seen_stream(seen, within="3650 days")
    incremental.run_available(stream, incremental.write_log(log), f"{folder}/checkpoint")
    return log.read().select("url")


@query
def q_stream_first_seen(t):
    """First observation of every URL, without a horizon, in two runs."""
    folder = _folder(t)
    seen = t.lineitem.select(
        F.concat(F.lit("/home/"), F.col("l_partkey").cast("string")).alias("url"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    urls = BucketTable(t.spark, f"{folder}/urls", struct("url string, ts timestamp"), ["url"], _BUCKETS)
    filters = BucketTable(t.spark, f"{folder}/filters", dedup.FILTER, ["part"], _BUCKETS)

    def run(stream: DataFrame) -> None:
        incremental.run_available(stream, dedup.track_first_seen(urls, filters), f"{folder}/checkpoint")

    _in_runs(t, seen, _time("ts"), folder, run)
    return urls.read()


@query
def q_stream_status(t):
    """Status events of all pairs, in two runs against the stored state."""
    folder = _folder(t)
    table = BucketTable(t.spark, f"{folder}/status", preferences.STATUS_STATE, preferences.KEY, _BUCKETS)
    run = lambda stream: incremental.run_available(stream, incremental.track_status(table), f"{folder}/checkpoint")
    _in_runs(t, s.status_events(t), _time("ts"), folder, run)
    return preferences.status_view(table.read())


@query
def q_stream_status_keyed(t):
    """The same as keyed state, events in no order."""
    folder = _folder(t)
    shown = preferences.status_view(preferences.merge_status(preferences.status_parts(s.status_events(t)))).schema
    log = EpochLog(t.spark, f"{folder}/status", shown)

    def run(stream: DataFrame) -> None:
        incremental.run_available(keyed.status_stream(stream), incremental.write_log(log), f"{folder}/checkpoint", "update")

    _in_runs(t, s.status_events(t), F.xxhash64("seq"), folder, run)
    return incremental.newest(log, preferences.KEY)


@query
def q_stream_price_tracking(t):
    folder = _folder(t)
    state = BucketTable(t.spark, f"{folder}/state", pricing.STATE_SCHEMA, ["property_id"], _BUCKETS)
    changes = EpochLog(t.spark, f"{folder}/changes", pricing.CHANGES_SCHEMA)

    def run(stream: DataFrame) -> None:
        handle = incremental.track_prices(state, changes, s.PRICE_TIES)
        incremental.run_available(stream, handle, f"{folder}/checkpoint")

    _in_runs(t, s.price_observations(t), _time("ts"), folder, run)
    return pricing.tracked_state(changes.read())


@query
def q_stream_price_keyed(t):
    """Price changes from keyed state, three runs."""
    folder = _folder(t)
    log = EpochLog(t.spark, f"{folder}/changes", pricing.CHANGES_SCHEMA)

    def run(stream: DataFrame) -> None:
        changes = keyed.price_changes_stream(stream, s.PRICE_TIES)
        incremental.run_available(changes, incremental.write_log(log), f"{folder}/checkpoint")

    _in_runs(t, s.price_observations(t), _time("ts"), folder, run, runs=3)
    return pricing.tracked_state(log.read())


@query
def q_stream_expiry(t):
    """History that has come and not expired, as event time passes."""
    folder = _folder(t)
    log = EpochLog(t.spark, f"{folder}/events", keyed.EXPIRY)
    history = pricing.history_rows(_changes(t)).select("property_id", "change_no", "ts", "expires_at")
    clock = [(None, None, s.AS_OF + dt.timedelta(days=1, milliseconds=1), None)]  # what is a day late is still awaited
    ticks = t.spark.createDataFrame(clock, struct("property_id string, change_no bigint, ts timestamp, expires_at timestamp"))

    def run(stream: DataFrame) -> None:
        events = keyed.expiring_history(stream, late="1 day", parts=16)
        incremental.run_available(events, incremental.write_log(log), f"{folder}/checkpoint")

    _in_runs(t, history.unionByName(ticks), _time("ts"), folder, run, runs=3)
    return keyed.unexpired_rows(log.read())


@query
def q_stream_pref_state(t):
    folder = _folder(t)
    table = BucketTable(t.spark, f"{folder}/preferences", preferences.STATE_SCHEMA, preferences.KEY, _BUCKETS)
    run = lambda stream: incremental.run_available(stream, incremental.track_preferences(table), f"{folder}/checkpoint")
    _in_runs(t, s.preference_events(t), _time("ts"), folder, run)
    return table.read().drop("created_seq")


@query
def q_stream_pref_late(t):
    """Preferences from keyed state, events in no order at all."""
    folder = _folder(t)
    log = EpochLog(t.spark, f"{folder}/preferences", keyed.PREFERENCE_EVENTS)

    def run(stream: DataFrame) -> None:
        found = keyed.preference_stream(stream, late="36500 days")
        incremental.run_available(found, incremental.write_log(log), f"{folder}/checkpoint", "update")

    _in_runs(t, s.preference_events(t), F.xxhash64("seq"), folder, run)
    found = incremental.newest(log, preferences.KEY).where(F.col("preference_type").isNotNull())
    return found.drop("created_seq")


@query
def q_stream_enrich(t):
    """All listings analyzed in three runs; the first two bring some of them with other prices and cities."""
    folder = _folder(t)
    listed = stage(s.listings(t).drop("image_urls"), "listings")
    odd = F.pmod(F.xxhash64("property_id"), F.lit(3))
    other = listed.where(odd == 0).withColumn("price_per_sqft", F.col("price_per_sqft") * 2)
    moved = listed.where(odd == 1).withColumn("city", F.lit("ELSEWHERE"))
    arriving = [(other, 0), (moved, 1), (listed, 2)]
    rows = reduce(DataFrame.unionByName, [r.withColumn("seq", F.lit(k)) for r, k in arriving])
    tables_ = medians.CityTables(t.spark, f"{folder}/analysis", listed.schema, _BUCKETS)

    def run(stream: DataFrame) -> None:
        handle = medians.analyze_batches(tables_, ["seq"], s.AS_OF)
        incremental.run_available(stream, handle, f"{folder}/checkpoint")

    for k in range(3):
        rows.where(F.col("seq") == k).write.mode("append").parquet(f"{folder}/source")
        run(t.spark.readStream.schema(rows.schema).parquet(f"{folder}/source"))
    columns = ["city_median_price_per_sqft", "city_discount_pct", "city_property_count", "price_per_acre"]
    return tables_.read().select("property_id", "city", *columns)


@query
def q_stream_crawl(t):
    """Summary of collector runs over a stream of result-page observations."""
    folder = _folder(t)
    known = s.known(t).select("property_id", "sort_key", "listing_url", "price", "analysis_date")
    for name, kind in zip(pricing.TRACKING_COLUMNS[1:], pricing.TRACKING_TYPES[1:]):
        known = known.withColumn(name, F.lit(None).cast(kind))
    listings = BucketTable(t.spark, f"{folder}/listings", known.schema, ["property_id"], _BUCKETS)
    listings.write(known)
    tracked = BucketTable(t.spark, f"{folder}/tracked", TRACKED_URLS, ["url"], _BUCKETS)
    before = s.order_observations(t).where(F.col("ts") < F.lit(s.TRACKED_UNTIL))
    tracked.write(collect.tracking_rows(before))
    runs = struct(
        "total_urls_found bigint, new_urls_tracked bigint, existing_listings bigint, "
        "price_changed_listings bigint, run_at timestamp"
    )
    summaries = EpochLog(t.spark, f"{folder}/runs", runs)
    handle = incremental.crawl_runs(tracked, listings, summaries)
    source = s.order_observations(s.StreamTables(t.spark, t.dir))
    incremental.run_available(source, handle, f"{folder}/checkpoint")
    return summaries.read().drop("run_at")
