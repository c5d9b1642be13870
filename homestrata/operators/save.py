"""Saving extracted listings, and the books kept about it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.functions.common import non_blank
from homestrata.functions.ids import build_key, parse_key
from homestrata.functions.records import prune
from homestrata.functions.text import cut
from homestrata.operators.ordered import latest_by
from homestrata.operators.pricing import TRACKING_COLUMNS
from homestrata.schemas import LISTING_SAVED

IMAGES_STORED = 10
DESCRIPTION_STORED = 500
_CARRIED = [c for c in TRACKING_COLUMNS if c != "price"]


def fill_city(extracted: DataFrame, tracked: DataFrame) -> DataFrame:
    """The tracked URL's city where the page gave none."""
    cities = tracked.select(F.col("url").alias("listing_url"), F.col("city").alias("_tracked_city"))
    joined = extracted.join(cities, "listing_url", "left")
    return joined.withColumn(
        "city", F.coalesce(non_blank("city"), non_blank("_tracked_city"))
    ).drop("_tracked_city")


def saveable(extracted: DataFrame) -> DataFrame:
    """Rows without an error or a reason to skip, that have an id."""
    ok = F.col("error").isNull() & non_blank("property_id").isNotNull()
    if "skip_reason" in extracted.columns:
        ok = ok & F.col("skip_reason").isNull()
    return extracted.where(ok)


def listing_records(
    extracted: DataFrame,
    as_of: dt.datetime,
    images: int | None = IMAGES_STORED,
    description: int | None = DESCRIPTION_STORED,
) -> DataFrame:
    """Stored form of extracted listings: fixed columns, absent values as NULL.

    ``images`` and ``description`` say how much of either is stored; None keeps all.
    """
    rows = saveable(extracted)
    computed = {
        "sort_key": F.lit("META"),
        "listing_status": F.lit("active"),
        "analysis_date": F.lit(as_of.date()),
        "first_seen_date": F.lit(as_of).cast("timestamp"),
    }
    columns = []
    for field in LISTING_SAVED.fields:
        if field.name in computed:
            c = computed[field.name]
        elif field.name in rows.columns:
            c = F.col(field.name)
        else:
            c = F.lit(None)
        if field.name == "description" and description is not None:
            c = cut(c, description)
        elif field.name == "image_urls" and images is not None:
            c = F.slice(c, 1, images)
        columns.append(c.cast(field.dataType).alias(field.name))
    return prune(rows.select(*columns))


def save_listings(listings: DataFrame, records: DataFrame, replace: bool = False) -> DataFrame:
    """Listing table with ``records`` put in.

    By default a listing keeps the date it was first seen and its price tracking;
    ``replace`` stores the new record as it is, forgetting both. Records are put by
    property_id and sort_key, so history rows in the same table stay as they are.
    """
    keys = [k for k in ("property_id", "sort_key") if k in listings.columns and k in records.columns]
    records = latest_by(records, keys, ["extraction_timestamp", "listing_url"])
    row = F.struct(*[c for c in records.columns if c not in keys]).alias("_new")
    joined = listings.join(records.select(*keys, row), keys, "full_outer")
    saved = F.col("_new").isNotNull()
    out = listings.columns + [c for c in records.columns if c not in listings.columns]
    columns = []
    for name in out:
        if name in keys:
            columns.append(F.col(name))
            continue
        old = F.col(name) if name in listings.columns else F.lit(None)
        new = F.col("_new")[name] if name in records.columns else F.lit(None)
        if not replace and name == "first_seen_date":
            new = F.least(old, new)
        elif not replace and name in _CARRIED:
            new = F.coalesce(new, old)
        columns.append(F.when(saved, new).otherwise(old).alias(name))
    return joined.select(*columns)


def processing_metrics(error: Column) -> list[Column]:
    """Counts over processed URLs by their error; 403 is a kind of its own."""
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(error.isNull()).alias("success"),
        F.count_if(error.isNotNull()).alias("failed"),
        F.count_if(F.coalesce(error.contains("403"), F.lit(False))).alias("blocked"),
    ]


def processing_summary(results: DataFrame) -> DataFrame:
    """One row of counts over processed URLs (url, error)."""
    return results.agg(*processing_metrics(F.col("error")))


def processing_errors(results: DataFrame) -> DataFrame:
    """The failed URLs and why; rows, not one list, as there is no bound on them."""
    return results.where(F.col("error").isNotNull()).select("url", "error")


def reuse_keys(raw_ids: DataFrame, listings: DataFrame, as_of: dt.date) -> DataFrame:
    """Key per raw id: the stored one whatever its date, else a new dated key.

    Only keys of the form ``PROP#<date>_<id>`` can be found again; of several the
    smallest is taken.
    """
    dated = F.regexp_extract("property_id", "#([^#]*)", 1).contains("_")
    if "sort_key" in listings.columns:
        dated &= F.col("sort_key") == "META"  # history rows are no listings
    stored = (
        listings.where(dated)
        .groupBy(parse_key("property_id", second_token_only=True).alias("raw_id"))
        .agg(F.min("property_id").alias("_stored"))
    )
    return raw_ids.join(stored, "raw_id", "left").select(
        "raw_id",
        F.coalesce("_stored", build_key("raw_id", F.lit(as_of))).alias("property_id"),
        F.col("_stored").isNotNull().alias("reused"),
    )
