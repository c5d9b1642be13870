"""Listing ids, keys and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from homestrata.functions.common import as_col, extract, first_match, non_blank
from homestrata.site import (
    DEFAULT_SITE,
    LEGACY_ID_PATTERNS,
    PORTAL_ID_PATTERNS,
    PORTAL_SLUG_PATTERN,
)

# Path component of any URL reference (RFC 3986, appendix B).
_URL_PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)"


# Characters of an id made of words; None, where it is an argument, for all of them.
SLUG_CHARS = 100


def _slug(words: Column, chars: int | None) -> Column:
    return words if chars is None else F.left(words, F.lit(chars))


def listing_id(url: Column | str, slug_chars: int | None = SLUG_CHARS) -> Column:
    """Digits after ``/home/``, else the last three path segments joined by ``_``."""
    url = as_col(url)
    segments = F.filter(F.split(F.regexp_extract(url, _URL_PATH, 1), "/"), lambda s: s != "")
    tail = F.slice(segments, F.greatest(F.size(segments) - 2, F.lit(1)), F.lit(3))
    slug = _slug(non_blank(F.array_join(tail, "_")), slug_chars)
    return F.coalesce(extract(url, "/home/([0-9]+)"), slug)


def portal_listing_id(url: Column | str, slug_chars: int | None = SLUG_CHARS) -> Column:
    """Id by the ordered patterns of the older portal, else its URL slug."""
    url = as_col(url)
    slug = _slug(F.replace(extract(url, PORTAL_SLUG_PATTERN), F.lit("/"), F.lit("_")), slug_chars)
    return F.coalesce(first_match(url, PORTAL_ID_PATTERNS), slug)


def legacy_listing_id(url: Column | str) -> Column:
    return first_match(url, LEGACY_ID_PATTERNS)


def build_key(raw_id: Column | str, as_of: Column | str | None = None) -> Column:
    """``PROP#<yyyymmdd>_<id>``, or ``PROP#<id>`` without a date."""
    raw_id = as_col(raw_id)
    if as_of is None:
        return F.concat(F.lit("PROP#"), raw_id)
    return F.concat(F.lit("PROP#"), F.date_format(as_col(as_of), "yyyyMMdd"), F.lit("_"), raw_id)


def parse_key(key: Column | str, second_token_only: bool = False) -> Column:
    """The id inside a key: what follows the first ``_`` after ``#``, or all of it.

    ``second_token_only`` stops at the next ``_``, as older keys were read.
    """
    body = extract(key, "#([^#]*)")
    rest = "^[^_]*_([^_]*)" if second_token_only else "(?s)^[^_]*_(.*)$"
    return F.when(body.contains("_"), extract(body, rest)).otherwise(body)


def raw_listing_id(key: Column | str, url: Column | str, url_id=listing_id) -> Column:
    """Id from the key, else from the URL."""
    return F.coalesce(parse_key(key), url_id(url))


def absolute_url(href: Column | str, base_url: str = DEFAULT_SITE.base_url) -> Column:
    """Site-relative links get the site prefix; NULL for anything not http."""
    href = as_col(href)
    return F.when(href.startswith("/"), F.concat(F.lit(base_url), href)).when(
        href.startswith("http"), href
    )


def address_from_url(url: Column | str) -> Column:
    """Address words of the segment before ``/home/<digits>``."""
    return F.translate(extract(url, "/([^/]+)/home/[0-9]+"), "-", " ")
