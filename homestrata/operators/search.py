"""Listing search: optional filters, sorts, pages and favorite flags."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestrata.operators.ordered import Keys, first_rows, placed
from homestrata.schemas import SEARCH_COLUMNS
from homestrata.sources.staging import stage

MAX_PAGE = 300
DEFAULT_PAGE = 100

# Search parameter -> (column, comparison, type of the value).
FILTERS = {
    "city": ("city", "==", str),
    "state": ("state", "==", str),
    "min_price": ("price", ">=", int),
    "max_price": ("price", "<=", int),
    "min_beds": ("beds", ">=", int),
    "max_beds": ("beds", "<=", int),
    "min_baths": ("baths", ">=", float),
    "min_sqft": ("size_sqft", ">=", int),
    "max_sqft": ("size_sqft", "<=", int),
    "property_type": ("property_type", "==", str),
}

# Sort name without its direction -> column.
SORTS = {
    "price": "price",
    "price_per_sqft": "price_per_sqft",
    "sqft": "size_sqft",
    "beds": "beds",
    "date": "analysis_date",
    "days_on_market": "days_on_market",
}

_COMPARE = {
    "==": lambda c, v: c == v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
}


def page_size(limit: int | str | None = None) -> int:
    """Rows per page: 100 unless asked otherwise, between 1 and 300."""
    asked = DEFAULT_PAGE if limit is None else int(limit)
    return max(1, min(asked, MAX_PAGE))


def search_predicate(params: Mapping[str, object]) -> Column:
    """Conjunction of the given filters; blank ones do not filter.

    A listing without the attribute fails its filter.
    """
    terms = [F.lit(True)]
    for name, (column, op, kind) in FILTERS.items():
        value = params.get(name)
        if value:
            terms.append(_COMPARE[op](F.col(column), F.lit(kind(value))))
    return reduce(lambda a, b: a & b, terms)


def search_columns(listings: DataFrame) -> list[str]:
    return [c for c in SEARCH_COLUMNS if c in listings.columns]


def search(listings: DataFrame, params: Mapping[str, object]) -> DataFrame:
    """All matches among the current records, with the search columns only.

    Filters and columns reach the scan; history rows of a table that holds both stay out.
    """
    current = listings.where(F.col("sort_key") == "META") if "sort_key" in listings.columns else listings
    found = current.where(search_predicate(params))
    return found.select(*search_columns(listings))


def sort_keys(listings: DataFrame, sort: str | None) -> Keys:
    """Keys for a sort name; unknown names mean newest first.

    A missing value sorts as zero (dates: before all others); ties go by id.
    """
    base, _, direction = (sort or "").rpartition("_")
    if base not in SORTS or direction not in ("asc", "desc"):
        base, direction = "date", "desc"
    column = SORTS[base]
    dated = dict(listings.dtypes)[column] in ("date", "timestamp", "timestamp_ntz", "string")
    key = F.col(column) if dated else F.coalesce(F.col(column), F.lit(0))
    return [(key, direction == "desc"), (F.col("property_id"), False)]


def sort_columns(listings: DataFrame, sort: str | None) -> list[Column]:
    """``sort_keys`` as Spark orders by them."""
    return [k.desc_nulls_last() if descending else k.asc_nulls_first() for k, descending in sort_keys(listings, sort)]


def top_k(found: DataFrame, sort: str | None = None, limit: int = DEFAULT_PAGE) -> DataFrame:
    """Best ``limit`` rows of the whole result, however many that is."""
    return first_rows(found, sort_keys(found, sort), limit)


def next_page(found: DataFrame, cursor: str | None = None, limit: int = DEFAULT_PAGE) -> DataFrame:
    """Rows after ``cursor`` in id order; ``next_cursor`` tells where the following page begins."""
    rows = found if cursor is None else found.where(F.col("property_id") > cursor)
    return first_rows(rows, [(F.col("property_id"), False)], limit)


def next_cursor(page: DataFrame, limit: int) -> DataFrame:
    """One row: rows of the page, and its last id if there may be a page after it."""
    count = F.count("*")
    return page.agg(count.alias("total_in_page"), F.when(count >= limit, F.max("property_id")).alias("next_cursor"))


def all_pages(found: DataFrame, limit: int = DEFAULT_PAGE) -> DataFrame:
    """Every page that following the cursors would give, from one ordering of the ids.

    ``page_no`` counts from 0; ``total_in_page`` and ``next_cursor`` are those of the row's
    page. A full page has a cursor even if none comes after it.
    """
    numbered = placed(found, [F.col("property_id")], "_place")
    rows = stage(numbered.withColumn("page_no", F.floor((F.col("_place") - 1) / limit)).drop("_place"), "pages")
    count = F.count("*")
    pages = rows.groupBy("page_no").agg(
        count.alias("total_in_page"), F.when(count >= limit, F.max("property_id")).alias("next_cursor")
    )
    return rows.join(pages, "page_no")


def sort_page(page: DataFrame, sort: str | None = None) -> DataFrame:
    """Order within one page only, whatever the other pages hold."""
    return page.orderBy(*sort_columns(page, sort))


def favorite_ids(preferences: DataFrame, user_id: object | None) -> DataFrame:
    """Ids the user favorited; nobody's favorites are empty."""
    rows = preferences.where(F.col("preference_type") == "favorite")
    anonymous = user_id is None or user_id == "anonymous"
    rows = rows.where(F.lit(False)) if anonymous else rows.where(F.col("user_id") == F.lit(user_id))
    return rows.select("property_id").distinct()


def flag_favorites(listings: DataFrame, favorites: DataFrame) -> DataFrame:
    """Add ``is_favorited`` by one existence join."""
    marks = favorites.select("property_id").distinct().withColumn("_mark", F.lit(True))
    joined = listings.join(marks, "property_id", "left")
    return joined.withColumn("is_favorited", F.col("_mark").isNotNull()).drop("_mark")


def first_image(listings: DataFrame) -> DataFrame:
    return listings.withColumn("image_url", F.get("image_urls", F.lit(0)))


def search_page(
    listings: DataFrame,
    preferences: DataFrame,
    params: Mapping[str, object],
    user_id: object | None = None,
    global_sort: bool = False,
) -> DataFrame:
    """One answer of the search API: a page with images, favorite flags and its order.

    With ``global_sort`` the page is the best ``limit`` of all matches; otherwise it is
    the next ``limit`` in id order and only sorted within. The API's bounds on ``limit``
    hold here. The page, at most MAX_PAGE rows, is found once and written: its ids then
    choose among the preferences and its rows are shown.
    """
    found = search(listings, params)
    sort, limit = params.get("sort"), page_size(params.get("limit"))
    page = top_k(found, sort, limit) if global_sort else next_page(found, params.get("cursor"), limit)
    page = stage(page, "search-page")
    favorites = favorite_ids(preferences, user_id).join(
        F.broadcast(page.select("property_id")), "property_id", "left_semi"
    )
    return sort_page(first_image(flag_favorites(page, favorites)), sort)


def user_preferences(preferences: DataFrame, user_id: object, preference_type: str) -> DataFrame:
    """A user's favorites or hidden listings; ``rank`` 1 is the most recent."""
    rows = preferences.where(
        (F.col("user_id") == F.lit(user_id)) & (F.col("preference_type") == preference_type)
    )
    return placed(rows, [F.col("created_at").desc(), F.col("property_id")])
