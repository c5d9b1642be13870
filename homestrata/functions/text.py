"""Fields read from page text, and rules on report texts.

``text`` is the visible text of a page in its original case. ``(?U)`` makes white space
and word boundaries Unicode-aware: pages are full of no-break spaces and accents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from homestrata.functions.common import as_col, digits_to_long, extract
from homestrata.site import (
    DAYS_ON_PATTERN,
    DEFAULT_SITE,
    HOA_FEE_PATTERN,
    LOT_ACRES_PATTERN,
    LOT_SQFT_PATTERN,
    MLS_NUMBER_PATTERN,
    PROPERTY_TYPE_PATTERNS,
    SQFT_PER_ACRE,
    YEAR_BUILT_PATTERN,
)


def year_built(text: Column | str, as_of_year: Column | int) -> Column:
    """First year after 'built', if between 1800 and the current year."""
    year = extract(F.lower(as_col(text)), YEAR_BUILT_PATTERN).try_cast("int")
    return F.when((year >= 1800) & (year <= as_of_year), year)


def lot_acres(text: Column | str) -> Column:
    number = extract(F.lower(as_col(text)), LOT_ACRES_PATTERN)
    acres = F.regexp_replace(number, ",", "").try_cast("double")
    return F.when((acres > 0) & (acres < 10000), acres)


def lot_sqft(text: Column | str) -> Column:
    """Square feet of the lot: from acres when given, else as written."""
    written = extract(F.lower(as_col(text)), LOT_SQFT_PATTERN)
    from_acres = F.floor(lot_acres(text) * SQFT_PER_ACRE)
    return F.coalesce(from_acres, digits_to_long(written)).cast("bigint")


def property_type(text: Column | str) -> Column:
    """First of the ordered type patterns that occurs in the text.

    The text is scanned once for the words of all types; what is found, words never
    overlapping, says which types occur.
    """
    bare = [pattern.removeprefix(r"\b(").removesuffix(r")\b") for pattern, _ in PROPERTY_TYPE_PATTERNS]
    found = F.regexp_extract_all(F.lower(as_col(text)), F.lit(rf"(?U)\b({'|'.join(bare)})\b"), F.lit(1))

    def place(word: Column) -> Column:
        which = F.when(word.rlike(f"^({bare[0]})$"), 1)
        for k, words in enumerate(bare[1:], 2):
            which = which.when(word.rlike(f"^({words})$"), k)
        return which

    first = F.array_min(F.transform(F.array_distinct(found), place))
    return F.get(F.array(*[F.lit(name) for _, name in PROPERTY_TYPE_PATTERNS]), first - 1)


def hoa_fee(text: Column | str) -> Column:
    return digits_to_long(extract(F.lower(as_col(text)), HOA_FEE_PATTERN))


def days_on_market(text: Column | str, label: str = DEFAULT_SITE.days_on_label) -> Column:
    return extract(F.lower(as_col(text)), DAYS_ON_PATTERN + label).try_cast("int")


def mls_number(text: Column | str) -> Column:
    """Case-sensitive, unlike the other fields."""
    return extract(as_col(text), MLS_NUMBER_PATTERN)


def verdict(text: Column | str) -> Column:
    """Verdict named in a report; plain substring tests on the lowered text."""
    t = F.lower(as_col(text))
    named = t.contains("verdict")
    return (
        F.when(t.contains("strong buy"), "STRONG BUY")
        .when(t.contains("pass") & named, "PASS")
        .when(t.contains("buy") & named, "BUY")
        .otherwise("CONSIDER")
    )


def truncate_report(
    markdown: Column | str,
    total_size: Column | str,
    size_limit: int = 300000,
    keep: int = 10000,
    marker: str = "\n\n... [truncated]",
) -> Column:
    """Cut a report to ``keep`` characters when the whole record is over the limit."""
    markdown, total_size = as_col(markdown), as_col(total_size)
    cut = F.concat(F.left(markdown, F.lit(keep)), F.lit(marker))
    return F.when((total_size > size_limit) & (F.length(markdown) > keep), cut).otherwise(markdown)


def cut(text: Column | str, length: int = 500) -> Column:
    """Stored error texts and descriptions keep this many characters."""
    return F.left(as_col(text), F.lit(length))
