"""Explicit schemas of every table; nothing is inferred from data.

Absent and zero are the same thing in the stored tables, so absent is NULL.
"""

from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def struct(spec: str, **nested: T.DataType) -> T.StructType:
    """Schema from ``name type, ...``; nested types are given by name. Needs no session."""
    fields = []
    for part in spec.split(", "):
        name, kind = part.split(" ")
        fields.append(T.StructField(name, nested[name] if kind == "nested" else _SIMPLE[kind]))
    return T.StructType(fields)


OBSERVATIONS = struct(
    "crawl_id string, page_no bigint, pos int, url string, price bigint, city string, state string, "
    "address string, property_id string, source string"
)

TRACKED_URLS = struct("url string, processed boolean, city string, price bigint")

PAGES = struct("crawl_id string, page_no bigint, url string, html string, error string")

# The saved part of a listing, in storage order.
LISTING_SAVED = struct(
    "property_id string, sort_key string, listing_url string, listing_status string, "
    "analysis_date date, first_seen_date timestamp, price bigint, price_per_sqft double, size_sqft int, "
    "beds int, baths double, lot_size_sqft int, lot_size_acres double, year_built int, "
    "property_type string, address string, city string, state string, zip_code string, "
    "latitude double, longitude double, hoa_fee int, mls_number string, site_id string, "
    "listing_source string, date_listed string, date_updated string, days_on_market int, "
    "parking string, amenities array<string>, description string, image_count int, "
    "image_urls array<string>, extraction_timestamp timestamp"
)

LISTING_ANALYSIS = struct(
    "price_per_acre double, city_median_price_per_sqft double, city_discount_pct double, "
    "city_property_count bigint, last_analyzed timestamp, analysis_date date"
)

LISTING_PRICE_TRACKING = struct(
    "original_price bigint, previous_price bigint, last_price_change bigint, "
    "last_price_change_pct double, total_price_change bigint, total_price_change_pct double, "
    "price_update_count bigint, last_price_update timestamp"
)

PRICE_HISTORY = struct(
    "property_id string, change_no bigint, ts timestamp, price bigint, previous_price bigint, "
    "price_change_amount bigint, price_drop_pct double, listing_status string, expires_at timestamp"
)

PREFERENCES = struct(
    "user_id bigint, property_id string, preference_type string, created_at timestamp, "
    "property_summary nested, analysis_status string, analysis_requested_at timestamp, "
    "analysis_completed_at timestamp, analysis_result nested, last_error string, retry_count bigint",
    property_summary=struct(
        "price bigint, city string, state string, address string, size_sqft int, beds int, "
        "baths double, property_type string, image_url string, listing_url string"
    ),
    analysis_result=struct("analysis_markdown string, verdict string, analysis_text string"),
)

# Columns a search returns.
SEARCH_COLUMNS = [
    "property_id", "price", "size_sqft", "beds", "baths", "city", "state", "zip_code", "address",
    "property_type", "listing_url", "image_urls", "image_count", "price_per_sqft",
    "city_discount_pct", "city_median_price_per_sqft", "days_on_market", "analysis_date",
    "first_seen_date", "year_built", "lot_size_sqft", "hoa_fee", "mls_number",
]
