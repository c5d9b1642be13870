"""Texts handed to an analyst: one listing, or several to compare.

The request to a model is not made here; these are the columns it would be made from.
A listing is shown as its facts, one a line under the name of its column; what is not
known is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.functions.common import round_exact

DEFAULT_REQUEST = "Is this listing worth its price? Give a verdict, the reasons for it and what to check."
DEFAULT_COMPARISON_REQUEST = "Which of these listings is the best choice, and what speaks for the others?"

# What an analyst is told, in order.
LISTING_FACTS = (
    "property_id", "property_type", "year_built", "beds", "baths", "size_sqft", "lot_size_sqft", "lot_size_acres",
    "price", "price_per_sqft", "hoa_fee", "city_median_price_per_sqft", "city_discount_pct", "days_on_market",
    "address", "zip_code", "city", "state", "mls_number", "listing_url",
)
COMPARED_FACTS = (
    "property_id", "year_built", "beds", "baths", "size_sqft", "price", "price_per_sqft", "city_discount_pct",
    "days_on_market", "city", "state",
)
FRACTIONS = frozenset("baths lot_size_acres price_per_sqft city_median_price_per_sqft city_discount_pct".split())


def facts(names: tuple[str, ...]) -> Column:
    """``name: value`` lines of the columns that have a value; fractions with two decimals."""
    lines = []
    for name in names:
        value = F.format_string("%.2f", round_exact(name)) if name in FRACTIONS else F.col(name).cast("string")
        lines.append(F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{name}: "), value)))
    return F.concat_ws("\n", *lines)


def analysis_prompt(request: str = DEFAULT_REQUEST) -> Column:
    """What is asked, then the facts of one enriched listing."""
    return F.concat_ws("\n\n", F.lit(request), facts(LISTING_FACTS))


def comparison_items(requests: DataFrame, listings: DataFrame, preferences: DataFrame) -> DataFrame:
    """Requested listings in order, with what is missing about each.

    Requests are (request_id, user_id, property_ids). ``problem`` names the first thing
    that is wrong: fewer than two listings asked for, no such listing, or no finished
    analysis of it by this user. A request for none is one row without a listing.
    """
    few = F.coalesce(F.size("property_ids"), F.lit(0)) < 2
    asked = requests.select(
        "request_id", "user_id", few.alias("_few"), F.posexplode_outer("property_ids").alias("pos", "property_id")
    )
    known = listings.withColumn("_listed", F.lit(True))
    done = preferences.where(F.col("analysis_result").isNotNull()).select(
        "user_id", "property_id", F.lit(True).alias("_analyzed"), "analysis_result"
    )
    joined = asked.join(known, "property_id", "left").join(done, ["user_id", "property_id"], "left")
    problem = (
        F.when(F.col("_few"), "fewer than two listings")
        .when(F.col("_listed").isNull(), "listing missing")
        .when(F.col("_analyzed").isNull(), "analysis missing")
    )
    return joined.withColumn("problem", problem).drop("_few", "_listed", "_analyzed")


def comparison_gate(items: DataFrame) -> DataFrame:
    """Per request whether it can be answered; if not, the first listing that fails it."""
    bad = F.col("problem").isNotNull()
    return items.groupBy("request_id").agg(
        F.count("pos").alias("property_count"),
        (F.count_if(bad) == 0).alias("valid"),
        F.min_by("property_id", F.when(bad, F.coalesce("pos", F.lit(0)))).alias("first_missing_id"),
        F.min_by("problem", F.when(bad, F.coalesce("pos", F.lit(0)))).alias("first_problem"),
    )


def comparison_section() -> Column:
    """One listing's part of a comparison: its place, its facts, what was found before."""
    found = F.coalesce("analysis_result.analysis_markdown", F.lit("none"))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("option: "), (F.col("pos") + 1).cast("string")),
        facts(COMPARED_FACTS),
        F.concat(F.lit("analysis: "), found),
    )


def comparison_prompts(items: DataFrame, request: str = DEFAULT_COMPARISON_REQUEST) -> DataFrame:
    """One text per answerable request, sections in the order asked for.

    A request's listings came in one row, so putting its sections back into one is as
    large as the request was.
    """
    parts = items.select(
        "request_id", "user_id", F.col("problem").isNotNull().alias("_bad"),
        F.struct("pos", comparison_section().alias("text")).alias("_part"),
    )
    whole = parts.groupBy("request_id", "user_id").agg(
        F.max("_bad").alias("_bad"), F.sort_array(F.collect_list("_part")).alias("_parts")
    )
    sections = F.array_join(F.transform("_parts", lambda p: p["text"]), "\n\n")
    return whole.where(~F.col("_bad")).select(
        "request_id",
        "user_id",
        F.size("_parts").alias("property_count"),
        F.concat_ws("\n\n", F.lit(request), sections).alias("prompt"),
    )
