"""City statistics and discounts kept up to date batch by batch, without reading it all again.

A batch brings listings, new or changed. What each was before is taken away from, and what
it is now added to, two tables of counts: per city and bin of prices, and per city, bin and
price. For the cities that a batch touches the bin counts tell which bins hold the two
middle ranks; only the prices of those bins are read, and the medians are exact. Then the
listings of these cities are enriched anew, and no others.

What a batch reads follows the listings of its cities as they are, never how many batches
there were. A large city's listings lie in ``PARTS`` parts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestrata.functions.common import strip
from homestrata.operators import stats
from homestrata.operators.ordered import latest_by
from homestrata.schemas import LISTING_ANALYSIS, struct
from homestrata.sources.epochs import BUCKETS, BucketTable
from homestrata.sources.staging import stage, staged_scope
from homestrata.streaming.incremental import Run

PARTS = 16
_CITY = ["city"]
_BIN = ["city", "bin"]
_VALUE = ["city", "bin", "value"]
_PLACE = ["_city", "_part", "property_id"]


class CityTables:
    """The tables of an incremental analysis under one folder.

    ``listing`` is the schema of the listings that come in, with property_id, city and
    price_per_sqft; ``enriched`` has them with what the analysis adds.
    """

    def __init__(self, spark: SparkSession, path: str, listing: T.StructType, buckets: int = BUCKETS) -> None:
        def table(name: str, schema: T.StructType, keys: list[str], by: list[str] | None = None) -> BucketTable:
            return BucketTable(spark, f"{path.rstrip('/')}/{name}", schema, keys, buckets, by)

        self.columns = [f for f in listing.fieldNames() if f not in stats.ENRICHMENT]
        self.placed = table("placed", struct("property_id string, city string, price_per_sqft double"), ["property_id"])
        self.counts = table("counts", struct("city string, bin bigint, n bigint"), _BIN, _CITY)
        self.values = table("values", struct("city string, bin bigint, value double, n bigint"), _VALUE, _BIN)
        self.stats = table("stats", struct("city string, median_price_per_sqft double, property_count bigint"), _CITY)
        place = struct("_city string, _part int").fields
        whole = T.StructType([*place, *[listing[c] for c in self.columns], *LISTING_ANALYSIS.fields])
        self.enriched = table("enriched", whole, _PLACE, _PLACE[:2])

    def read(self) -> DataFrame:
        """Enriched listings as they are now."""
        return self.enriched.read().drop("_city", "_part")


def _part() -> Column:
    return F.pmod(F.xxhash64("property_id"), F.lit(PARTS)).cast("int")


def _added(stored: DataFrame, deltas: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Counts after ``deltas``: those that are left, and those that have come to nothing."""
    touched = stored.join(deltas.select(*keys), keys, "left_semi")
    summed = stage(touched.unionByName(deltas).groupBy(*keys).agg(F.sum("n").alias("n")), "counts")
    return summed.where(F.col("n") != 0), summed.where(F.col("n") == 0)


def _deltas(before: DataFrame, now: DataFrame) -> DataFrame:
    """(city, bin, value, n): by how much the number of listings of each price changes."""
    both = stats.usable_prices(before).withColumn("n", F.lit(-1).cast("bigint"))
    both = both.unionByName(stats.usable_prices(now).withColumn("n", F.lit(1).cast("bigint")))
    value = F.col("price_per_sqft").cast("double")
    counted = both.select("city", stats.value_bin(value).cast("bigint").alias("bin"), value.alias("value"), "n")
    return counted.groupBy(*_VALUE).agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def analyze_batches(tables: CityTables, order: list[str], as_of: dt.datetime) -> Callable[[DataFrame, int], None]:
    """Fold batches of listings into ``tables``; of several rows of one listing the last in ``order`` counts."""
    runs = Run()

    def handle(batch: DataFrame, epoch: int) -> None:
        run = runs.of(batch, tables.placed)
        at = run, epoch
        with staged_scope(batch.sparkSession):
            now = stage(latest_by(batch, ["property_id"], order).select(*tables.columns), "changed")
            slim = now.select("property_id", "city", F.col("price_per_sqft").cast("double").alias("price_per_sqft"))
            before = tables.placed.of(slim, *at).join(slim.select("property_id"), "property_id", "left_semi")
            before = stage(before, "before")
            deltas = stage(_deltas(before, slim), "deltas")
            cities = stage(deltas.select("city").distinct(), "cities")

            # counts, then the medians of the cities whose counts changed
            left, gone = _added(tables.values.of(deltas, *at), deltas, _VALUE)
            tables.values.write(left, *at, deleted=gone)
            per_bin = deltas.groupBy(*_BIN).agg(F.sum("n").alias("n"))
            left, gone = _added(tables.counts.of(per_bin, *at), per_bin, _BIN)
            tables.counts.write(left, *at, deleted=gone)
            counts = tables.counts.current(among=tables.counts.buckets_of(cities)).join(cities, "city", "left_semi")
            bins = stage(stats.bins_of_medians(counts, "city"), "middle-bins")
            values = tables.values.current(among=tables.values.buckets_of(bins))
            found = stage(stats.as_city_stats(stats.counted_medians(values, bins, "city")), "city-stats")
            tables.stats.write(found, *at, deleted=cities.join(found, "city", "left_anti"))

            # the listings of those cities, as they were or as they are now: their buckets' other rows
            # stay, so all is written in one pass and only what may have come or gone is compared by key
            place = [F.coalesce(strip("city"), F.lit("")).alias("_city"), _part().alias("_part")]
            put = now.select("property_id", *place)
            moved = stage(before.select("property_id", *place).join(put, _PLACE, "left_anti"), "moved")
            parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part")
            lying = cities.select(F.col("city").alias("_city"), parts)
            touched = put.unionByName(moved)
            stored = tables.enriched.of(touched.select(*_PLACE[:2]).unionByName(lying), *at)
            named = cities.withColumnRenamed("city", "_city")
            same = stored.join(named, "_city", "left_semi").join(now.select("property_id"), "property_id", "left_anti")
            listed = same.select(*tables.columns).unionByName(now)
            cities_now = now.select(strip("city").alias("city")).unionByName(cities)
            known = tables.stats.current(among=tables.stats.buckets_of(cities_now))
            others = tables.enriched.without(stored.join(named, "_city", "left_anti"), touched)
            enriched = stats.enrich(listed, known, as_of).select("*", *place)
            tables.enriched.replace(enriched.unionByName(others), *at, deleted=moved)
            tables.placed.write(slim, *at)

    return handle
