"""Turning extracted fields into stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestrata.functions.common import non_blank

# Columns of older records that keep zero and false.
KEEP_ZERO = (
    "floor", "building_floors", "price", "size_sqm", "price_per_sqm", "management_fee",
    "repair_reserve_fee", "total_monthly_costs", "station_distance_minutes", "num_bedrooms",
    "building_age_years", "building_year", "image_count", "good_lighting", "view_obstructed",
)

# Older records carry some fields under their original names.
ORIGINAL_NAMES = {
    "address": "所在地",
    "building_name": "建物名",
    "direction_facing": "向き",
    "zoning": "用途地域",
    "land_rights": "土地権利",
    "national_land_use_notification": "国土法届出",
    "transaction_type": "取引態様",
    "current_occupancy": "現況",
    "handover_timing": "引渡し",
}


def present(name: str, dtype: T.DataType, keep_zero: bool = False) -> Column:
    """The column, or NULL where its value counts as absent: '', [], 0 and false."""
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(dtype, T.ArrayType):
        return F.when(F.size(c) > 0, c)
    if isinstance(dtype, T.BooleanType) and not keep_zero:
        return F.when(c, c)
    if isinstance(dtype, T.NumericType) and not keep_zero:
        return F.when(c != 0, c)
    return c


def prune(rows: DataFrame, keep_zero: tuple[str, ...] = (), never: tuple[str, ...] = ()) -> DataFrame:
    """NULL for every value that counts as absent.

    ``keep_zero`` columns keep 0 and false; ``never`` columns are left alone.
    """
    return rows.select(
        *[
            F.col(f.name)
            if f.name in never
            else present(f.name, f.dataType, f.name in keep_zero).alias(f.name)
            for f in rows.schema.fields
        ]
    )


def first_present(*candidates: Column, kind: str) -> Column:
    """First candidate that is neither absent nor empty nor zero: sources by precedence."""
    if kind == "string":
        return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])
    if kind.startswith("array"):
        return F.coalesce(*[F.when(F.size(c) > 0, c) for c in candidates])
    return F.coalesce(*[F.when(c != 0, c) for c in candidates])


def _optional(rows: DataFrame, name: str, kind: str) -> Column:
    """``name`` as ``kind``; NULL when the column is missing or cannot be read."""
    return F.col(name).try_cast(kind) if name in rows.columns else F.lit(None).cast(kind)


def legacy_record(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Complete record of the older market with typed defaults.

    Amounts default to 0, counts stay NULL when unknown, texts default to ''. Fields
    under their original names fill the translated ones. With ``known`` (raw_id,
    price) the previous price is set where a known positive price differs.
    """

    def text(name: str) -> Column:
        original = ORIGINAL_NAMES.get(name)
        found = non_blank(_optional(rows, name, "string"))
        if original:
            found = F.coalesce(found, non_blank(_optional(rows, original, "string")))
        return F.coalesce(found, F.lit(""))

    def amount(name: str, kind: str = "double") -> Column:
        return F.coalesce(_optional(rows, name, kind), F.lit(0).cast(kind))

    def count(name: str) -> Column:
        return _optional(rows, name, "int")

    ward = text("ward")
    facing = text("direction_facing")
    stripped = ("zoning", "land_rights", "national_land_use_notification")
    stripped += ("transaction_type", "current_occupancy", "handover_timing")
    price = amount("price", "bigint")
    record = {
        "property_id": F.col("property_id"),
        "sort_key": F.lit("META"),
        "listing_url": text("url"),
        "title": text("title"),
        "address": text("address"),
        "price": price,
        **{n: amount(n) for n in ("size_sqm", "price_per_sqm", "management_fee")},
        **{n: amount(n) for n in ("repair_reserve_fee", "total_monthly_costs")},
        **{n: count(n) for n in ("building_age_years", "floor", "station_distance_minutes")},
        **{n: count(n) for n in ("num_bedrooms", "building_floors", "building_year")},
        "ward": ward,
        "district": text("district"),
        "district_key": F.when(ward != "", F.concat(F.lit("DIST#"), ward)),
        "building_name": text("building_name"),
        "direction_facing": facing,
        "orientation": F.coalesce(non_blank(_optional(rows, "orientation", "string")), facing),
        **{n: text(n) for n in ("primary_light", "closest_station", "photo_filenames")},
        "image_count": F.coalesce(_optional(rows, "image_count", "int"), F.lit(0)),
        "balcony_size_sqm": F.nullif(_optional(rows, "balcony_size_sqm", "double"), F.lit(0.0)),
        **{
            n: F.coalesce(_optional(rows, n, "boolean"), F.lit(False))
            for n in ("view_obstructed", "good_lighting")
        },
        **{n: non_blank(F.trim(text(n))) for n in stripped},
    }
    columns = [c.alias(n) for n, c in record.items()]
    if known is None:
        return rows.select(*columns)
    before = known.select(
        F.col("raw_id").alias("_raw_id"), F.col("price").cast("bigint").alias("_known_price")
    )
    joined = rows.withColumn("_raw_id", F.regexp_extract("property_id", "#([^#]*)", 1)).join(
        before, "_raw_id", "left"
    )
    differs = (F.col("_known_price") > 0) & (F.col("_known_price") != price)
    return joined.select(*columns, F.when(differs, F.col("_known_price")).alias("previous_price"))


def merge_extras(rows: DataFrame, extras: DataFrame, key: str = "property_id") -> DataFrame:
    """Fill empty slots of a record from an extras row; filled slots are kept."""
    renamed = extras.select(key, *[F.col(c).alias(f"_x_{c}") for c in extras.columns if c != key])
    joined = rows.join(renamed, key, "left")
    out = []
    for f in rows.schema.fields:
        if f.name != key and f.name in extras.columns:
            own = present(f.name, f.dataType, keep_zero=True)
            out.append(F.coalesce(own, F.col(f"_x_{f.name}")).alias(f.name))
        else:
            out.append(F.col(f.name))
    added = [F.col(f"_x_{c}").alias(c) for c in extras.columns if c not in rows.columns]
    return joined.select(*out, *added)
