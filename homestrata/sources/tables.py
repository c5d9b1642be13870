"""Reading and writing the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestrata.functions.ids import listing_id, parse_key
from homestrata.schemas import struct
from homestrata.operators.ordered import first_rows, latest_by, placed

DUMP_SCHEMA = struct("url string, price bigint, price_text string, duplicate string")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_listings(listings: DataFrame, path: str) -> None:
    """Listings laid out by city and price per sqft, which is what they are looked up by.

    ``place`` names the folder a city's rows are in, so looking one up lists no others.
    Ranges of (place, price, id) give every task few cities, and a large city several
    tasks, each with its own range of prices: Parquet's statistics tell them apart.
    """
    laid = listings.withColumn("place", _place(F.col("city")))
    keys = [c for c in ("place", "price_per_sqft", "property_id") if c in laid.columns]
    ranged = laid.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.write.mode("errorifexists").partitionBy("place").parquet(path)


def read_listings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Listings as ``write_listings`` has laid them out; ``place`` is kept for ``by_city``."""
    laid = T.StructType([*[f for f in schema.fields if f.name != "place"], T.StructField("place", T.StringType())])
    return spark.read.schema(laid).parquet(path)


def _place(city: Column) -> Column:
    # no city and a blank one share a folder; the city itself is stored as it is
    return F.concat(F.lit("c-"), F.coalesce(city, F.lit("")))


def current_listings(listings: DataFrame) -> DataFrame:
    """Current records only; history rows share the table in old data."""
    return listings.where(F.col("sort_key") == "META")


def known_listings(listings: DataFrame, url_id=listing_id, second_token_only: bool = False) -> DataFrame:
    """Current listings by raw id; of several keys for one id the latest wins.

    A key without an id falls back on the URL, unless ``url_id`` is None. Older keys
    were read up to their second token only.
    """
    raw_id = parse_key("property_id", second_token_only)
    if url_id is not None:
        raw_id = F.coalesce(raw_id, url_id("listing_url"))
    rows = current_listings(listings).select(
        raw_id.alias("raw_id"),
        "property_id",
        F.coalesce("price", F.lit(0)).cast("bigint").alias("price"),
        F.coalesce("listing_url", F.lit("")).alias("listing_url"),
        "analysis_date",
    )
    return latest_by(
        rows.where(F.col("raw_id").isNotNull()),
        ["raw_id"],
        [F.coalesce("analysis_date", F.lit("0001-01-01").cast("date")), "property_id"],
    )


def tracked_urls(tracked: DataFrame, city: str | None = None, exclude_city: str | None = None) -> DataFrame:
    """Set of tracked URLs of one city, or of all but one; ``city`` wins over the other.

    A row without a city is kept by ``exclude_city``.
    """
    rows = tracked.where(F.col("url") != "")
    if city:
        rows = rows.where(F.col("city") == city)
    elif exclude_city:
        rows = rows.where(~F.col("city").eqNullSafe(exclude_city))
    return rows.select("url").distinct()


def is_unprocessed() -> Column:
    return ~F.coalesce(F.col("processed"), F.lit(False))


def unprocessed_urls(tracked: DataFrame, with_details: bool = False, place: str = "city") -> DataFrame:
    """URLs still to process; older tables name the place of a URL ``ward``."""
    rows = tracked.where(is_unprocessed() & (F.col("url") != ""))
    if not with_details:
        return rows.select("url")
    return rows.select("url", place, F.coalesce("price", F.lit(0)).cast("bigint").alias("price"))


def unprocessed_batch(tracked: DataFrame, batch_size: int = 100, place: str = "city") -> DataFrame:
    """The next ``batch_size`` unprocessed URLs, always the same ones for the same table."""
    return first_rows(unprocessed_urls(tracked, True, place), [(F.col("url"), False)], batch_size)


def lookup(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``table`` for a set of keys, as one join whatever the number of keys."""
    return table.join(keys.select(*on).distinct(), on, "left_semi")


def by_city(listings: DataFrame, city: str, order: str = "price_per_sqft") -> DataFrame:
    """One city's listings in index order: cheapest per sqft first, or newest first.

    ``rank`` is a row's place in that order. Of listings laid out by ``write_listings`` only
    the city's files are read.
    """
    columns = ["city", "price_per_sqft", "property_id", "listing_url", "price", "size_sqft"]
    columns += ["beds", "baths", "year_built", "property_type"]
    rows = listings.where(F.col("city") == city)
    if "place" in listings.columns:
        rows = rows.where(F.col("place") == _place(F.lit(city))).drop("place")
    if order == "price_per_sqft":
        # rows without the ordering attribute are not in that index
        rows = rows.where(F.col("price_per_sqft").isNotNull()).select(*columns)
        return placed(rows, [F.col("price_per_sqft"), F.col("property_id")])
    return placed(rows.where(F.col("analysis_date").isNotNull()), [F.col("analysis_date").desc(), F.col("property_id")])


def write_summary(summary: DataFrame, path: str) -> None:
    """A one-row job summary as one JSON file, in a folder of its own."""
    summary.coalesce(1).write.mode("errorifexists").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_observed(rows: DataFrame, path: str, metrics: list[Column]) -> DataFrame:
    """Write ``rows`` and return one row of ``metrics`` over them, counted by the write itself.

    They are counted in the stage that writes, whose tasks count once each, lost executors
    or not.
    """
    seen = Observation()
    rows.observe(seen, *metrics).write.mode("errorifexists").parquet(path)
    found = seen.get
    fields = [T.StructField(name, T.LongType()) for name in found]
    return rows.sparkSession.createDataFrame([tuple(found.values())], T.StructType(fields))


def write_dump(rows: DataFrame, path: str) -> None:
    """Listing dump as CSV with a header; text values that need it are quoted."""
    rows.select(*DUMP_SCHEMA.fieldNames()).write.mode("errorifexists").option("header", True).csv(path)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DUMP_SCHEMA).option("header", True).csv(path)
