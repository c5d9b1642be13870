"""From result pages to the difference against what is already known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.functions.common import as_col
from homestrata.functions.ids import absolute_url, address_from_url, listing_id
from homestrata.functions.prices import parse_price, price_changed
from homestrata.operators.mutate import upsert_replace
from homestrata.operators.ordered import first_by, latest_by
from homestrata.site import DEFAULT_SITE, SiteRules
from homestrata.sources.html import read_pages
from homestrata.sources.tables import known_listings, tracked_urls

_HOME = "/home/[0-9]+"


def listing_links(
    pages: DataFrame, city: Column | str, state: Column | str, site: SiteRules = DEFAULT_SITE
) -> DataFrame:
    """Listing observations on result pages, repeats within a page included.

    A link counts when its address names the state and a numbered home. Pages must
    carry ``crawl_id`` and ``page_no``; links of one page come back in page order (``pos``).
    """
    found = read_pages(
        pages.select(
            "crawl_id", "page_no", as_col(city).alias("city"), as_col(state).alias("state"), "html"
        ),
        ["links"],
    ).select("*", F.inline("links"))
    in_state = F.col("href").contains(F.concat(F.lit("/"), F.col("state"), F.lit("/")))
    return (
        found.where(in_state & F.col("href").rlike(_HOME))
        .select(
            "crawl_id",
            "page_no",
            "pos",
            absolute_url("href", site.base_url).alias("url"),
            F.coalesce(parse_price("price_text"), parse_price("dollar_text"), F.lit(0)).alias("price"),
            "city",
            "state",
            address_from_url("href").alias("address"),
            F.regexp_extract("href", "/home/([0-9]+)", 1).alias("property_id"),
            F.lit(site.source).alias("source"),
        )
        .where(F.col("url").isNotNull())
    )


def first_seen(observations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """First occurrence of every URL in page order."""
    return first_by(observations, keys or ["crawl_id", "url"], ["page_no", "pos"])


def crawl_pages_kept(pages: DataFrame, observations: DataFrame) -> DataFrame:
    """Pages (crawl_id, page_no) a crawl reads before it stops.

    A crawl stops at the first page without a listing not seen before, or that fails
    for any reason but a timeout; timed-out pages are skipped.
    """
    fresh = (
        observations.groupBy("crawl_id", "url")
        .agg(F.min("page_no").alias("page_no"))
        .groupBy("crawl_id", "page_no")
        .agg(F.count("*").alias("_new"))
    )
    error = F.lower(F.col("error"))
    timed_out = F.coalesce(error.contains("timeout"), F.lit(False))
    read = pages.select("crawl_id", "page_no", "error").join(
        fresh, ["crawl_id", "page_no"], "left"
    )
    ends = ~timed_out & (F.col("error").isNotNull() | F.col("_new").isNull())
    stops = read.where(ends).groupBy("crawl_id").agg(F.min("page_no").alias("_stop"))
    return (
        read.where(~timed_out)
        .join(stops, "crawl_id", "left")
        .where(F.col("_stop").isNull() | (F.col("page_no") < F.col("_stop")))
        .select("crawl_id", "page_no")
    )


def collected(pages: DataFrame, observations: DataFrame) -> DataFrame:
    """Distinct listings of every crawl up to its last page read.

    Joined by page rather than by crawl, so one huge crawl stays spread out.
    """
    kept = crawl_pages_kept(pages, observations)
    return first_seen(observations).join(kept, ["crawl_id", "page_no"], "left_semi")


def classify(
    observations: DataFrame, tracked: DataFrame, listings: DataFrame, url_id=listing_id
) -> DataFrame:
    """Status of every collected listing: new, price_changed or unchanged.

    ``url_id`` is the rule that turns a URL into a listing id; pass
    ``portal_listing_id`` for URLs of the older portal.
    """
    seen = tracked_urls(tracked).withColumn("_tracked", F.lit(True))
    known = known_listings(listings, url_id).select(
        F.col("raw_id").alias("_raw_id"),
        F.col("property_id").alias("known_property_id"),
        F.col("price").alias("old_price"),
    )
    joined = (
        observations.withColumn("_raw_id", url_id("url"))
        .join(seen, "url", "left")
        .join(known, "_raw_id", "left")
    )
    status = (
        F.when(F.col("_tracked").isNull(), "new")
        .when(price_changed("price", "old_price"), "price_changed")
        .otherwise("unchanged")
    )
    return joined.withColumn("status", status).drop("_raw_id", "_tracked")


def new_urls(observations: DataFrame, tracked: DataFrame) -> DataFrame:
    return observations.join(tracked_urls(tracked), "url", "left_anti")


def price_changes(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status") == "price_changed").select(
        F.col("known_property_id").alias("property_id"),
        "url",
        "old_price",
        F.col("price").alias("new_price"),
    )


def split_by_known_id(urls: DataFrame, known: DataFrame, url_id=listing_id) -> DataFrame:
    """``is_new`` per URL: its id cannot be read, or is not among the known ids."""
    ids = known.select(F.col("raw_id").alias("_raw_id")).distinct().withColumn("_known", F.lit(True))
    joined = urls.withColumn("_raw_id", url_id("url")).join(ids, "_raw_id", "left")
    return joined.withColumn("is_new", F.col("_known").isNull()).drop("_raw_id", "_known")


def tracking_rows(urls: DataFrame, default_city: str | None = None, place: str = "city") -> DataFrame:
    """New rows of the tracked-URL table: unprocessed, price 0 when unknown.

    ``default_city`` is for URLs without a place; older tables call the place ``ward``.
    """
    columns = urls.columns
    price = F.col("price") if "price" in columns else F.lit(None)
    city = F.col(place) if place in columns else F.lit(None)
    return urls.select(
        "url",
        F.lit(False).alias("processed"),
        F.nullif(F.coalesce(city.cast("string"), F.lit(default_city)), F.lit("")).alias(place),
        F.coalesce(price, F.lit(0)).cast("bigint").alias("price"),
    )


def track_urls(tracked: DataFrame, urls: DataFrame, default_city: str | None = None) -> DataFrame:
    """Tracked-URL table with ``urls`` put in; a URL already there starts over."""
    rows = latest_by(tracking_rows(urls, default_city), ["url"], ["price", "city"])
    return upsert_replace(tracked, rows, ["url"])


def collection_summary(classified: DataFrame) -> DataFrame:
    status = F.col("status")
    return classified.agg(
        F.count("*").alias("total_urls_found"),
        F.count_if(status == "new").alias("new_urls_tracked"),
        F.count_if(status == "unchanged").alias("existing_listings"),
        F.count_if(status == "price_changed").alias("price_changed_listings"),
    )


def urls_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """URLs of the left side only, as a set."""
    return left.select("url").subtract(right.select("url"))


def urls_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("url").intersect(right.select("url"))
