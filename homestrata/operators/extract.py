"""Typed listing records from detail pages.

One Python stage reads the HTML; the rules on what was found are Column expressions:
page meta tags first, structured data fills what they leave open, page text the rest.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.functions import text as text_rules
from homestrata.functions.common import as_col, digits_to_long, extract, non_blank
from homestrata.functions.ids import build_key, listing_id
from homestrata.functions.prices import parse_price, price_per_sqft
from homestrata.functions.records import first_present
from homestrata.site import (
    COORDINATE_META,
    DEFAULT_SITE,
    LISTING_ITEM_TYPES,
    META_FIELDS,
    SiteRules,
)
from homestrata.sources.html import read_pages, unescape_html

IMAGES_KEPT = 20
ITEM_IMAGES_KEPT = 40
DESCRIPTION_KEPT = 1000

# Columns a source may give, in output order, with the type sources are merged by.
FIELDS = {
    "price": "bigint", "beds": "int", "baths": "double", "size_sqft": "int", "address": "string",
    "city": "string", "state": "string", "zip_code": "string", "description": "string",
    "listing_source": "string", "latitude": "double", "longitude": "double", "title": "string",
    "date_listed": "string", "date_updated": "string", "year_built": "int",
    "property_type": "string", "parking": "string", "amenities": "array<string>",
    "image_urls": "array<string>", "image_count": "int", "lot_size_acres": "double",
    "lot_size_sqft": "int", "hoa_fee": "int", "mls_number": "string", "days_on_market": "int",
}


def meta_fields(metas: Column | str = "metas") -> dict[str, Column]:
    """Listing fields from page meta tags; unreadable numbers count as missing.

    Prices here have no lower bound, unlike free-text prices.
    """
    metas = as_col(metas)
    raw = {field: non_blank(metas[name]) for name, field in META_FIELDS.items()}
    number = r"([0-9,]+)"
    fields = dict(raw)
    fields["price"] = digits_to_long(extract(raw["price"], number))
    fields["beds"] = raw["beds"].try_cast("int")
    fields["baths"] = F.when(
        raw["baths"].contains("."), raw["baths"].try_cast("double")
    ).otherwise(raw["baths"].try_cast("bigint").cast("double"))
    fields["size_sqft"] = digits_to_long(extract(raw["size_sqft"], number)).try_cast("int")
    point = F.split(metas[COORDINATE_META], ",")
    latitude = F.trim(F.get(point, F.lit(0))).try_cast("double")
    longitude = F.trim(F.get(point, F.lit(1))).try_cast("double")
    usable = (F.size(point) == 2) & latitude.isNotNull()
    fields["latitude"] = F.when(usable, latitude)
    fields["longitude"] = F.when(usable, longitude)
    return fields


_ITEM = (
    "`@type` string, offers string, address string, description string, name string, "
    "datePosted string, lastReviewed string, mainEntity string"
)
_ENTITY = (
    "yearBuilt string, accommodationCategory string, geo string, amenityFeature string, image string"
)
_ADDRESS = (
    "streetAddress string, addressLocality string, addressRegion string, postalCode string"
)


def _object(text: Column, schema: str) -> Column:
    """Typed fields of a JSON object text; anything else gives NULL fields."""
    return F.from_json(F.when(F.ltrim(text).startswith("{"), text), schema)


def _strings(text: Column) -> Column:
    """Elements of a JSON array text as strings; nested values keep their JSON text."""
    return F.from_json(F.when(F.ltrim(text).startswith("["), text), "array<string>")


def ld_items(scripts: Column | str = "ld_json") -> Column:
    """Listing fields of every structured-data item that describes a listing, in page order.

    Scripts that are not valid JSON are left out. Each JSON text is parsed once: every
    step below reads the structs the step before has made.
    """
    valid = F.filter(as_col(scripts), lambda s: F.try_parse_json(s).isNotNull())
    texts = F.flatten(
        F.transform(
            valid,
            lambda s: F.when(F.ltrim(s).startswith("["), _strings(s)).otherwise(F.array(s)),
        )
    )
    wanted = F.array(*[F.lit(t) for t in LISTING_ITEM_TYPES])

    def is_listing(item: Column) -> Column:
        kind = item["@type"]
        kinds = F.when(F.ltrim(kind).startswith("["), _strings(kind)).otherwise(F.array(kind))
        return F.coalesce(F.arrays_overlap(kinds, wanted), F.lit(False))

    def open_nested(item: Column) -> Column:
        return F.struct(
            item.alias("top"),
            _object(item["address"], _ADDRESS).alias("address"),
            _object(item["mainEntity"], _ENTITY).alias("entity"),
        )

    def open_parts(item: Column) -> Column:
        entity = item["entity"]
        # only objects have a name; what is no JSON at all would cost an exception each
        amenities = F.transform(
            _strings(entity["amenityFeature"]),
            lambda e: F.when(F.ltrim(e, F.lit(" \t\r\n")).startswith("{"), F.get_json_object(e, "$.name")),
        )
        images = F.transform(
            _strings(entity["image"]),
            lambda e: F.when(F.ltrim(e).startswith("{"), F.get_json_object(e, "$.url")).otherwise(e),
        )
        return F.struct(
            item["top"].alias("top"),
            item["address"].alias("address"),
            entity.alias("entity"),
            F.get_json_object(item["top"]["offers"], "$.price").alias("price"),
            F.get_json_object(entity["geo"], "$.latitude").try_cast("double").alias("latitude"),
            F.get_json_object(entity["geo"], "$.longitude").try_cast("double").alias("longitude"),
            *[
                F.filter(names, lambda n: non_blank(n).isNotNull()).alias(name)
                for name, names in (("amenities", amenities), ("images", images))
            ],
        )

    def fields(item: Column) -> Column:
        top, address, entity = item["top"], item["address"], item["entity"]
        values = {
            "price": parse_price(item["price"]),
            "address": non_blank(address["streetAddress"]),
            "city": non_blank(address["addressLocality"]),
            "state": non_blank(address["addressRegion"]),
            "zip_code": non_blank(address["postalCode"]),
            "description": non_blank(top["description"]),
            "title": non_blank(top["name"]),
            "date_listed": non_blank(top["datePosted"]),
            "date_updated": non_blank(top["lastReviewed"]),
            "year_built": F.nullif(entity["yearBuilt"].try_cast("double").try_cast("int"), F.lit(0)),
            "property_type": non_blank(entity["accommodationCategory"]),
            "latitude": F.nullif(item["latitude"], F.lit(0.0)),
            "longitude": F.nullif(item["longitude"], F.lit(0.0)),
            "amenities": F.when(F.size(item["amenities"]) > 0, item["amenities"]),
            "image_urls": F.when(F.size(item["images"]) > 0, item["images"]),
        }
        return F.struct(*[c.alias(n) for n, c in values.items()])

    listed = F.filter(F.transform(texts, lambda t: _object(t, _ITEM)), is_listing)
    return F.transform(F.transform(F.transform(listed, open_nested), open_parts), fields)


_LAST_WINS = (
    "price", "address", "city", "state", "zip_code", "description", "title", "date_listed",
    "date_updated", "year_built", "property_type", "latitude", "longitude", "amenities",
)


def _first(images: Column, count: int | None) -> Column:
    return images if count is None else F.slice(images, 1, count)


def ld_fields(items: Column | str = "ld_items", item_images: int | None = ITEM_IMAGES_KEPT) -> dict[str, Column]:
    """Listing fields from structured-data items; the last one that gives a value wins."""
    items = as_col(items)

    def last(read) -> Column:
        values = F.filter(F.transform(items, read), lambda v: v.isNotNull())
        return F.try_element_at(values, F.lit(-1))

    def parking(item: Column) -> Column:
        named = F.filter(item["amenities"], lambda n: F.lower(n).rlike("parking|garage"))
        return F.try_element_at(named, F.lit(-1))

    def field(name: str) -> Column:
        return last(lambda item: item[name])

    images = field("image_urls")
    return {
        **{name: field(name) for name in _LAST_WINS},
        "parking": last(parking),
        "image_urls": _first(images, item_images),
        "image_count": F.size(images),
    }


def text_fields(text: Column | str, as_of_year: int, site: SiteRules = DEFAULT_SITE) -> dict[str, Column]:
    """Listing fields from the visible text of a page."""
    return {
        "year_built": text_rules.year_built(text, as_of_year),
        "lot_size_acres": text_rules.lot_acres(text),
        "lot_size_sqft": text_rules.lot_sqft(text).try_cast("int"),
        "property_type": text_rules.property_type(text),
        "hoa_fee": text_rules.hoa_fee(text).try_cast("int"),
        "mls_number": text_rules.mls_number(text),
        "days_on_market": text_rules.days_on_market(text, site.days_on_label),
    }


def photo_urls(images: Column | str = "images", site: SiteRules = DEFAULT_SITE) -> Column:
    """Photos of the site: meta tags, then preloads, then large image elements; distinct."""
    images = as_col(images)
    large = "|".join(site.photo_size_marks)

    def of_kind(kind: str) -> Column:
        return F.filter(images, lambda i: (i["kind"] == kind) & i["url"].contains(site.photo_host))

    elements = F.filter(of_kind("img"), lambda i: i["url"].rlike(large))
    ordered = F.concat(of_kind("meta"), of_kind("preload"), elements)
    return F.array_distinct(F.transform(ordered, lambda i: i["url"]))


def extract_listings(
    pages: DataFrame,
    as_of: dt.datetime,
    site: SiteRules = DEFAULT_SITE,
    images: int | None = IMAGES_KEPT,
    item_images: int | None = ITEM_IMAGES_KEPT,
    description: int | None = DESCRIPTION_KEPT,
) -> DataFrame:
    """One record per fetched detail page (url, html, error); failed pages keep their error.

    ``images`` (photos of the page), ``item_images`` (of its structured data) and
    ``description`` (characters) say how much is kept; None keeps all.

    Narrow from end to end: no shuffle, whatever the number of pages.
    """
    read = read_pages(pages.select("url", "html", "error"), ["text", "metas", "ld_json", "images"])
    read = read.withColumn("_items", ld_items("ld_json")).withColumn("_photos", photo_urls("images", site))
    meta = meta_fields("metas")
    ld = ld_fields("_items", item_images)
    page_text = text_fields("text", as_of.year, site)
    # each source is evaluated once, then merged by precedence
    by_source = read.select(
        "url",
        "error",
        "_photos",
        *[
            F.struct(*[c.alias(n) for n, c in fields.items()]).alias(name)
            for name, fields in (("_meta", meta), ("_ld", ld), ("_text", page_text))
        ],
    )
    given = {"_meta": meta, "_ld": ld, "_text": page_text}
    merged = {
        name: first_present(
            *[F.col(f"{source}.{name}") for source, fields in given.items() if name in fields],
            kind=kind,
        ).cast(kind)
        for name, kind in FIELDS.items()
    }
    has_photos = F.size("_photos") > 0
    merged["image_urls"] = F.when(has_photos, _first(F.col("_photos"), images)).otherwise(
        merged["image_urls"]
    )
    merged["image_count"] = F.when(has_photos, F.size("_photos")).otherwise(merged["image_count"])
    merged["description"] = unescape_html(merged["description"])
    if description is not None:
        merged["description"] = F.left(merged["description"], F.lit(description))
    raw_id = listing_id("url")
    return by_source.select(
        build_key(raw_id, F.lit(as_of)).alias("property_id"),
        raw_id.alias("site_id"),
        F.col("url").alias("listing_url"),
        "error",
        F.lit(as_of).cast("timestamp").alias("extraction_timestamp"),
        *[c.alias(n) for n, c in merged.items()],
    ).withColumn("price_per_sqft", price_per_sqft("price", "size_sqft"))
