"""User preferences and the state of their analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.functions.common import as_col
from homestrata.functions.text import cut, truncate_report, verdict
from homestrata.operators.mutate import insert_if_absent
from homestrata.operators.ordered import first_by, latest_by
from homestrata.schemas import struct

KEY = ["user_id", "property_id"]

STATUS_STATE = struct(
    "user_id bigint, property_id string, status string, ts timestamp, seq bigint, "
    "completed_at timestamp, failures bigint, error string, error_ts timestamp, error_seq bigint"
)
IMAGES_SHOWN = 5

STATE_SCHEMA = struct(
    "user_id bigint, property_id string, preference_type string, created_at timestamp, "
    "created_seq bigint"
)

# Columns copied into a preference, with what an unknown listing shows.
_SUMMARY = {
    "price": 0, "city": "", "state": "", "address": "", "size_sqft": 0, "beds": 0, "baths": 0.0,
    "property_type": "",
}


def replay_preferences(events: DataFrame) -> DataFrame:
    """Preferences that result from a log of (user_id, property_id, action, ts, seq).

    ``favorite`` and ``hidden`` insert, ``remove`` deletes. An insert is ignored while
    the pair exists, whatever its type, so what counts is the first insert after the
    last removal.
    """
    at = F.struct("ts", "seq")
    removed = (
        events.where(F.col("action") == "remove").groupBy(*KEY).agg(F.max(at).alias("_removed"))
    )
    alive = (
        events.where(F.col("action").isin("favorite", "hidden"))
        .join(removed, KEY, "left")
        .where(F.col("_removed").isNull() | (at > F.col("_removed")))
        .select(*KEY, "action", "ts", "seq")
    )
    return first_by(alive, KEY, ["ts", "seq"]).select(
        *KEY,
        F.col("action").alias("preference_type"),
        F.col("ts").alias("created_at"),
        F.col("seq").alias("created_seq"),
    )


def status_parts(events: DataFrame) -> DataFrame:
    """Each status event (status, error, ts, seq) as the state it alone would leave."""
    failed = F.col("status") == "failed"
    return events.select(
        *KEY,
        "status",
        "ts",
        "seq",
        F.when(F.col("status") == "completed", F.col("ts")).alias("completed_at"),
        F.when(failed, 1).otherwise(0).cast("bigint").alias("failures"),
        F.when(failed, cut("error")).alias("error"),
        F.when(failed, F.col("ts")).alias("error_ts"),
        F.when(failed, F.col("seq")).alias("error_seq"),
    )


def merge_status(parts: DataFrame) -> DataFrame:
    """State per pair from the states of any split of its events, in any order."""
    at = F.struct("ts", "seq")
    error_at = F.when(F.col("error_ts").isNotNull(), F.struct("error_ts", "error_seq"))
    merged = parts.groupBy(*KEY).agg(
        F.max_by("status", at).alias("status"),
        F.max(at).alias("_at"),
        F.max("completed_at").alias("completed_at"),
        F.sum("failures").alias("failures"),
        F.max_by("error", error_at).alias("error"),
        F.max(error_at).alias("_error_at"),
    )
    return merged.select(
        *KEY,
        "status",
        "_at.ts",
        "_at.seq",
        "completed_at",
        "failures",
        "error",
        "_error_at.error_ts",
        "_error_at.error_seq",
    )


def status_view(state: DataFrame) -> DataFrame:
    return state.select(
        *KEY,
        F.col("status").alias("analysis_status"),
        F.col("ts").alias("status_at"),
        F.col("completed_at").alias("analysis_completed_at"),
        F.col("failures").alias("retry_count"),
        F.col("error").alias("last_error"),
    )


def replay_status(events: DataFrame) -> DataFrame:
    """Latest analysis status per pair, with the number of failures and the last one."""
    return status_view(merge_status(status_parts(events)))


def listing_summary(alias: str = "") -> Column:
    """Copy of the listing a preference keeps; '' and 0 where the listing is unknown."""
    prefix = f"{alias}." if alias else ""
    fields = [F.coalesce(F.col(prefix + n), F.lit(v)).alias(n) for n, v in _SUMMARY.items()]
    fields.append(F.get(F.col(prefix + "image_urls"), F.lit(0)).alias("image_url"))
    fields.append(F.coalesce(F.col(prefix + "listing_url"), F.lit("")).alias("listing_url"))
    return F.struct(*fields)


def with_listing_summary(preferences: DataFrame, listings: DataFrame) -> DataFrame:
    needed = [*_SUMMARY, "image_urls", "listing_url"]
    side = listings.select("property_id", F.struct(*needed).alias("_listing"))
    joined = preferences.join(side, "property_id", "left")
    return joined.withColumn("property_summary", listing_summary("_listing")).drop("_listing")


def new_preferences(requests: DataFrame, listings: DataFrame) -> DataFrame:
    """Preference rows for (user_id, property_id, preference_type, created_at).

    Favorites also ask for an analysis.
    """
    favorite = F.col("preference_type") == "favorite"
    return with_listing_summary(requests, listings).select(
        *KEY,
        "preference_type",
        "created_at",
        "property_summary",
        F.when(favorite, "pending").alias("analysis_status"),
        F.when(favorite, F.col("created_at")).alias("analysis_requested_at"),
    )


def add_preferences(preferences: DataFrame, requests: DataFrame, listings: DataFrame) -> DataFrame:
    """Preferences with the first request of every new pair added; existing pairs stay."""
    first = first_by(requests, KEY, ["created_at", "preference_type"])
    return insert_if_absent(preferences, new_preferences(first, listings), KEY)


def analysis_view(
    requested: DataFrame, preferences: DataFrame, listings: DataFrame, images: int | None = IMAGES_SHOWN
) -> DataFrame:
    """Analysis details of requested pairs; ``found`` is false where there is no preference.

    ``images`` says how many are shown; None shows all.
    """
    prefs = preferences.select(
        *KEY,
        F.lit(True).alias("_found"),
        *[c for c in ("analysis_status", "analysis_result", "property_summary") if c in preferences.columns],
    )
    some = F.col("image_urls") if images is None else F.slice("image_urls", 1, images)
    shown = listings.select("property_id", some.alias("_images"))
    joined = requested.select(*KEY).join(prefs, KEY, "left").join(shown, "property_id", "left")
    found = F.coalesce("_found", F.lit(False))
    columns = [c for c in prefs.columns if c not in (*KEY, "_found", "analysis_status")]
    return joined.select(
        *KEY,
        found.alias("found"),
        F.when(found, F.coalesce("analysis_status", F.lit("pending"))).alias("analysis_status"),
        F.when(found, F.coalesce("_images", F.array().cast("array<string>"))).alias("property_images"),
        *columns,
    )


def _record_size(report: Column) -> Column:
    """Bytes of the printed record: the text twice, plus some eighty characters around it.

    Line breaks, tabs and backslashes print as two characters, and the widest character
    of the text sets the width of all of them: 4 bytes with emoji, 2 with other symbols
    beyond Latin-1, else 1.
    """
    doubled = F.length(F.regexp_replace(report, r"[^\n\r\t\\]", ""))
    width = (
        F.when(report.rlike(r"[\x{10000}-\x{10FFFF}]"), 4).when(report.rlike(r"[\x{100}-\x{FFFF}]"), 2).otherwise(1)
    )
    return (2 * (F.length(report) + doubled) + 80) * width


def analysis_result(report: Column | str) -> Column:
    """Stored result of a finished analysis; over-long records keep a short report."""
    report = as_col(report)
    return F.struct(
        truncate_report(report, _record_size(report)).alias("analysis_markdown"),
        verdict(report).alias("verdict"),
        report.alias("analysis_text"),
    )


def comparison_rows(requests: DataFrame) -> DataFrame:
    """Preference rows for comparison requests (user_id, property_ids, requested_at).

    Comparisons live among the favorites under an id made of their time; requests with
    fewer than two listings are refused.
    """
    valid = requests.where(F.size("property_ids") >= 2)
    stamp = F.date_format("requested_at", "yyyy-MM-dd_HH-mm-ss")
    rows = valid.select(
        "user_id",
        F.concat(F.lit("COMPARISON_"), stamp).alias("property_id"),
        F.lit("favorite").alias("preference_type"),
        F.lit("processing").alias("analysis_status"),
        F.col("requested_at").alias("created_at"),
        F.col("requested_at").alias("comparison_date"),
        F.size("property_ids").alias("property_count"),
        F.col("property_ids").alias("compared_properties"),
    )
    # two requests of one user in the same second share an id: the later one is kept
    return latest_by(rows, KEY, ["created_at", F.to_json(F.struct("compared_properties"))])

