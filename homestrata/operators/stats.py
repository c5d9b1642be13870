"""Group medians and what listings get from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from homestrata.functions.common import strip
from homestrata.functions.prices import discount_pct, price_per_acre
from homestrata.operators.ordered import first_rows
from homestrata.schemas import LISTING_ANALYSIS
from homestrata.sources.staging import stage

_BINS_PER_OCTAVE = 64
_REFINE = 4096
_FINEST = _BINS_PER_OCTAVE * _REFINE**2

# Columns an analysis sets.
ENRICHMENT = LISTING_ANALYSIS.fieldNames()


def _bin(value: Column, per_octave: int) -> Column:
    """Order-preserving bin of a number; ``per_octave`` bins for each factor of two."""
    octave = F.floor(F.log2(F.abs(value)) * per_octave)
    return F.when(value > 0, octave).when(value == 0, -(2**42)).otherwise(-(2**43) - octave)


def _holds(rank: Column) -> Column:
    return (F.col("_start") <= rank) & (rank < F.col("_end"))


def _middle_bins(rows: DataFrame, group: str, per_octave: int, within: DataFrame | None) -> DataFrame:
    """Bins holding the two middle ranks: (group, _bin, _n, _before, _c).

    ``_before`` counts the rows of the group in lower bins. With ``within``, bins of the
    coarser level before, only rows in those are looked at.
    """
    if within is None:
        counts = rows.groupBy(group, _bin(F.col("_v"), per_octave).alias("_bin")).agg(F.count("*").alias("_c"))
        ordered = Window.partitionBy(group).orderBy("_bin")
        total = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        counts = counts.withColumn("_n", F.sum("_c").over(total)).withColumn("_before", F.lit(0))
    else:
        inside = _rows_in(rows, group, per_octave // _REFINE, within)
        counts = inside.groupBy(
            group, F.col("_bin").alias("_outer"), "_n", "_before", _bin(F.col("_v"), per_octave).alias("_bin")
        ).agg(F.count("*").alias("_c"))
        ordered = Window.partitionBy(group, "_outer").orderBy("_bin")
    return _holding_middle(counts, ordered).select(group, "_bin", "_n", F.col("_start").alias("_before"), "_c")


def _holding_middle(counts: DataFrame, ordered: WindowSpec) -> DataFrame:
    """Of counts ``_c`` in order, behind ``_before`` others, those that hold a middle rank of ``_n``."""
    up_to = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    return (
        counts.withColumn("_end", F.col("_before") + F.sum("_c").over(up_to))
        .withColumn("_start", F.col("_end") - F.col("_c"))
        .where(_holds(low) | _holds(high))
    )


def _rows_in(rows: DataFrame, group: str, per_octave: int, bins: DataFrame) -> DataFrame:
    """Rows that lie in the given bins."""
    binned = rows.withColumn("_bin", _bin(F.col("_v"), per_octave))
    return binned.join(bins.drop("_c"), [group, "_bin"])


def exact_medians(rows: DataFrame, group: str, value: str, bin_rows: int = 50_000_000) -> DataFrame:
    """Exact middle values per group: (group, lower, upper, n).

    ``lower`` and ``upper`` are the sorted values at (n-1)//2 and n//2; NULL and NaN are no
    values and do not count. One group may
    hold a large share of all rows, so rows are neither collected nor shuffled by group:

    * a first pass counts rows per bin, combined before the exchange to a few thousand
      counts per group at most, and finds the bins holding the two middle ranks;
    * while such a bin holds more than ``bin_rows`` rows, another pass cuts it into up
      to 4096 finer ones;
    * the last pass keeps only the rows in those bins (about one in a hundred or fewer),
      counts equal values, and ranks what is left.

    The bins found are staged: later passes filter by a broadcast while they are few,
    and join by (group, bin) when there are too many groups for that.
    """
    values = rows.select(group, F.col(value).cast("double").alias("_v")).where(~F.isnan("_v"))
    per_octave = _BINS_PER_OCTAVE
    bins = stage(_middle_bins(values, group, per_octave, None), "median-bins")
    while per_octave < _FINEST and (bins.agg(F.max("_c")).first()[0] or 0) > bin_rows:
        per_octave *= _REFINE
        bins = stage(_middle_bins(values, group, per_octave, bins), "median-bins")
    counted = _rows_in(values, group, per_octave, bins).groupBy(group, "_bin", "_v", "_n", "_before")
    return _middle_values(counted.agg(F.count("*").alias("_c")), group)


def _middle_values(counted: DataFrame, group: str) -> DataFrame:
    """(group, lower, upper, n) from the counted values of the bins that hold the middle ranks."""
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    return (
        _holding_middle(counted, Window.partitionBy(group, "_bin").orderBy("_v"))
        .groupBy(group)
        .agg(
            F.max(F.when(_holds(low), F.col("_v"))).alias("lower"),
            F.max(F.when(_holds(high), F.col("_v"))).alias("upper"),
            F.max("_n").alias("n"),
        )
    )


def value_bin(value: Column) -> Column:
    """The bin that ``exact_medians`` and ``counted_medians`` count a number in."""
    return _bin(value, _BINS_PER_OCTAVE)


def bins_of_medians(counts: DataFrame, group: str) -> DataFrame:
    """Bins that hold the middle ranks, from counts (group, bin, n) per bin."""
    whole = Window.partitionBy(group)
    counts = counts.select(group, F.col("bin").alias("_bin"), F.col("n").alias("_c"))
    counts = counts.withColumn("_n", F.sum("_c").over(whole)).withColumn("_before", F.lit(0))
    held = _holding_middle(counts, Window.partitionBy(group).orderBy("_bin"))
    return held.select(group, F.col("_bin").alias("bin"), "_n", F.col("_start").alias("_before"))


def counted_medians(values: DataFrame, bins: DataFrame, group: str) -> DataFrame:
    """(group, lower, upper, n) from counted values (group, bin, value, n) and ``bins_of_medians``.

    A bin's distinct values meet in one task, so values are to be of limited precision.
    """
    inside = values.join(bins, [group, "bin"])
    counted = inside.select(group, F.col("bin").alias("_bin"), F.col("value").alias("_v"), "_n", "_before", F.col("n").alias("_c"))
    return _middle_values(counted, group)


def usable_prices(listings: DataFrame) -> DataFrame:
    """Cities and prices per sqft that count in a city's statistics."""
    return listings.select(strip("city").alias("city"), "price_per_sqft").where(
        (F.col("city") != "") & (F.col("price_per_sqft") > 0) & ~F.isnan("price_per_sqft")
    )


def as_city_stats(medians: DataFrame) -> DataFrame:
    return medians.select(
        "city",
        ((F.col("lower") + F.col("upper")) / 2).alias("median_price_per_sqft"),
        F.col("n").alias("property_count"),
    )


def city_stats(listings: DataFrame) -> DataFrame:
    """Exact median price per sqft and number of usable listings per city."""
    return as_city_stats(exact_medians(usable_prices(listings), "city", "price_per_sqft"))


def ward_stats(listings: DataFrame, min_count: int = 3) -> DataFrame:
    """Upper median price per sqm of wards with at least ``min_count`` listings."""
    usable = listings.where(
        (F.col("ward") != "") & (F.col("ward") != "unknown") & (F.col("price_per_sqm") != 0)
    )
    return (
        exact_medians(usable, "ward", "price_per_sqm")
        .where(F.col("n") >= min_count)
        .select(
            "ward",
            F.col("upper").alias("ward_avg_price_per_sqm"),
            F.col("n").alias("ward_property_count"),
        )
    )


def enrich(listings: DataFrame, stats: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Listings with unit prices and their discount to the city median.

    A listing whose city has no statistics is compared with itself.
    """
    psf = F.coalesce(F.col("price_per_sqft"), F.lit(0.0))
    median = F.coalesce(F.col("median_price_per_sqft"), psf)
    base = [c for c in listings.columns if c not in ENRICHMENT]
    joined = listings.withColumn("_city", strip("city")).join(
        stats.withColumnRenamed("city", "_city"), "_city", "left"
    )
    return joined.select(
        *base,
        price_per_acre("price", "lot_size_acres", "lot_size_sqft").alias("price_per_acre"),
        median.alias("city_median_price_per_sqft"),
        discount_pct(psf, median).alias("city_discount_pct"),
        F.coalesce("property_count", F.lit(1)).cast("bigint").alias("city_property_count"),
        F.lit(as_of).cast("timestamp").alias("last_analyzed"),
        F.lit(as_of.date()).alias("analysis_date"),
    )


def first_listings(listings: DataFrame, max_properties: int = 0) -> DataFrame:
    """Optional cap of an analysis run; statistics are then over the capped set."""
    if max_properties <= 0:
        return listings
    return first_rows(listings, [(F.col("property_id"), False)], max_properties)


def analyze(listings: DataFrame, as_of: dt.datetime, max_properties: int = 0) -> DataFrame:
    """City statistics, then enrichment, over the whole table or its first rows."""
    chosen = first_listings(listings, max_properties)
    # the medians read their rows more than once: two columns are written for that, not the table
    prices = stage(chosen.select("city", "price_per_sqft"), "city-prices")
    return enrich(chosen, stage(city_stats(prices), "city-stats"), as_of)


def analysis_metrics() -> list[Column]:
    """Counts over analyzed listings: those done, and rows that cannot be keyed."""
    has_key = F.col("property_id").isNotNull()
    return [F.count_if(has_key).alias("properties_analyzed"), F.count_if(~has_key).alias("errors")]


def with_cities(counted: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: the counts of ``analysis_metrics`` and the number of cities with statistics."""
    cities = stats.agg(F.count("*").alias("cities_analyzed"))
    return counted.unionByName(cities, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("properties_analyzed", "errors", "cities_analyzed")]
    )


def analysis_summary(listings: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: listings analyzed, rows that cannot be keyed, cities with statistics."""
    return with_cities(listings.agg(*analysis_metrics()), stats)


def _as_comparables(rows: DataFrame) -> DataFrame:
    """Rows that can serve as comparables; unknown texts are blank."""
    usable = rows.where((F.col("price_per_sqm") != 0) & (F.col("size_sqm") != 0))
    blank = sorted({"district", "building_name", "layout_type"} & set(rows.columns))
    return usable.fillna("", subset=blank) if blank else usable


def comparables(listings: DataFrame, per_ward: int = 200) -> DataFrame:
    """Newest listings of every ward that can serve as comparables.

    The newest ``per_ward`` are chosen first and unusable ones dropped after, as the
    index query does. The rank filter is applied before the exchange too
    (WindowGroupLimit), so a large ward never travels whole.
    """
    newest = Window.partitionBy("ward").orderBy(
        F.col("analysis_date").desc_nulls_last(), F.col("property_id")
    )
    ranked = listings.withColumn("_rank", F.row_number().over(newest))
    return _as_comparables(ranked.where(F.col("_rank") <= per_ward).drop("_rank"))


def ward_comparables(listings: DataFrame, ward: str | None = None, limit: int = 200) -> DataFrame:
    """Comparables of one ward; of any ward when it is unknown. Newest first."""
    known = bool(ward) and ward != "unknown"
    rows = listings.where(F.col("ward") == ward) if known else listings
    newest = [(F.col("analysis_date"), True), (F.col("property_id"), False)]
    return _as_comparables(first_rows(rows, newest, limit))
