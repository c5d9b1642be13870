"""The three scheduled jobs, end to end: collect, process, analyze.

Each reads its tables, and writes the changed tables into a new folder, so that a failed
run leaves everything as it was and can simply be repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestrata.operators import collect, extract, mutate, pricing, save, stats
from homestrata.site import DEFAULT_SITE, SiteRules
from homestrata.sources.staging import stage
from homestrata.sources.tables import (
    current_listings,
    unprocessed_batch,
    unprocessed_urls,
    write_listings,
    write_observed,
    write_summary,
)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def collect_job(
    pages: DataFrame,
    tracked: DataFrame,
    listings: DataFrame,
    out: str,
    as_of: dt.datetime,
    site: SiteRules = DEFAULT_SITE,
) -> DataFrame:
    """Result pages (crawl_id, page_no, city, state, html, error) against what is known.

    Writes ``tracked_urls``, ``listings`` and the run's ``summary``; returns the
    classified listings.
    """
    read = pages.where(F.col("error").isNull())
    links = stage(collect.listing_links(read, "city", "state", site), "links")
    found = collect.collected(pages.select("crawl_id", "page_no", "error"), links)
    classified = stage(collect.classify(found, tracked, listings), "classified")
    fresh = classified.where(F.col("status") == "new").select("url", "price", "city")
    _write(collect.track_urls(tracked, fresh), f"{out}/tracked_urls")
    changes = collect.price_changes(classified)
    updated = pricing.apply_changes(listings, changes, F.lit(as_of).cast("timestamp"))
    write_listings(updated, f"{out}/listings")
    summary = collect.collection_summary(classified)
    write_summary(summary.withColumn("end_time", F.lit(as_of).cast("timestamp")), f"{out}/summary")
    return classified


def process_job(
    pages: DataFrame,
    tracked: DataFrame,
    listings: DataFrame,
    out: str,
    as_of: dt.datetime,
    batch_size: int | None = None,
    site: SiteRules = DEFAULT_SITE,
) -> DataFrame:
    """Detail pages (url, html, error) of unprocessed URLs into listing records.

    ``batch_size`` takes that many URLs, all of them by default. Writes ``listings``,
    ``tracked_urls``, ``summary`` and ``errors``; returns one row per processed URL.

    Page HTML is never shuffled: pages are read where they are, and the records, a small
    part of their size, joined with the URLs that are due. The summary is counted by the
    write of the results.
    """
    due = unprocessed_urls(tracked) if batch_size is None else unprocessed_batch(tracked, batch_size)
    due = due.select(F.col("url").alias("listing_url"))
    extracted = extract.extract_listings(pages, as_of, site).join(due, "listing_url", "left_semi")
    extracted = stage(save.fill_city(extracted, tracked), "extracted")
    records = save.listing_records(extracted, as_of)
    write_listings(save.save_listings(listings, records), f"{out}/listings")
    failed = F.coalesce("error", F.when(F.col("property_id").isNull(), "Failed to save"))
    results = extracted.select(F.col("listing_url").alias("url"), failed.alias("error"))
    counted = write_observed(results, f"{out}/results", save.processing_metrics(F.col("error")))
    write_summary(counted, f"{out}/summary")
    results = extracted.sparkSession.read.schema(results.schema).parquet(f"{out}/results")
    _write(mutate.mark_processed(tracked, results.where(F.col("error").isNull())), f"{out}/tracked_urls")
    _write(save.processing_errors(results), f"{out}/errors")
    return results


def analyze_job(listings: DataFrame, out: str, as_of: dt.datetime, max_properties: int = 0) -> DataFrame:
    """City statistics and enrichment of current listings.

    Without a cap every listing is enriched in place; a capped run updates only the
    listings it looked at. Writes ``enriched``, ``listings`` and ``summary``, whose counts
    come from the write of ``enriched``.
    """
    chosen = stats.first_listings(current_listings(listings), max_properties)
    medians = stage(stats.city_stats(chosen), "city-stats")
    enriched = stats.enrich(chosen, medians, as_of)
    counted = write_observed(enriched, f"{out}/enriched", stats.analysis_metrics())
    enriched = listings.sparkSession.read.schema(enriched.schema).parquet(f"{out}/enriched")
    if max_properties > 0:
        keys = ["property_id", "sort_key"]
        result = mutate.upsert_partial(listings, enriched.select(*keys, *stats.ENRICHMENT), keys, stats.ENRICHMENT)
    else:
        others = listings.where(~F.col("sort_key").eqNullSafe("META"))
        result = enriched.unionByName(others, allowMissingColumns=True)
    write_listings(result, f"{out}/listings")
    write_summary(stats.with_cities(counted, medians), f"{out}/summary")
    return enriched
