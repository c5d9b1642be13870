"""Fixed values of the listing site whose pages are read.

All of these are plain data that pages must match literally; a different site is a
different ``SiteRules``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SiteRules:
    base_url: str
    source: str
    photo_host: str
    photo_size_marks: tuple[str, ...]
    days_on_label: str


# Fixed values.
DEFAULT_SITE = SiteRules(
    base_url="https://www.redfin.com",
    source="redfin",
    photo_host="cdn-redfin.com/photo",
    photo_size_marks=("bigphoto", "mbpaddedwide", "genMid"),
    days_on_label="redfin",
)

# Page meta name -> listing column.
META_FIELDS = {
    "twitter:text:price": "price",
    "twitter:text:beds": "beds",
    "twitter:text:baths": "baths",
    "twitter:text:sqft": "size_sqft",
    "twitter:text:street_address": "address",
    "twitter:text:city": "city",
    "twitter:text:state_code": "state",
    "twitter:text:zip": "zip_code",
    "twitter:text:description_simple": "description",
    "twitter:text:listing_source": "listing_source",
}
COORDINATE_META = "ICBM"

# Structured-data item types that describe a listing.
LISTING_ITEM_TYPES = ("Product", "RealEstateListing", "Residence", "SingleFamilyResidence", "House")

# Words that mark a price text as "no price".
NO_PRICE_WORDS = ("contact", "call", "price upon request", "auction", "n/a")
PRICE_FLOOR = 10000
SQFT_PER_ACRE = 43560.0

# Ordered page-text patterns, first match names the property type.
PROPERTY_TYPE_PATTERNS = (
    (r"\b(single family|single-family)\b", "Single Family"),
    (r"\b(condo|condominium)\b", "Condo"),
    (r"\b(townhouse|townhome)\b", "Townhouse"),
    (r"\b(multi-?family|duplex|triplex)\b", "Multi-Family"),
    (r"\b(land|lot|vacant)\b", "Land"),
    (r"\b(mobile|manufactured)\b", "Mobile"),
)

# Patterns of page texts, lower-cased but for the MLS number. Digits are written
# [0-9] here and below, as (?U) would let the digit class take those of other scripts, which no
# number column can hold.
YEAR_BUILT_PATTERN = r"(?U)(?:built|year built)[\s:]*([0-9]{4})"
LOT_ACRES_PATTERN = r"(?U)([0-9,.]+)\s*(?:acre|ac)\b"
LOT_SQFT_PATTERN = r"(?U)lot[\s:]*size[\s:]*[^0-9]*([0-9,]+)\s*(?:sq\s*ft|sqft)"
HOA_FEE_PATTERN = r"(?U)hoa[\s:]*\$?([0-9,]+)"
DAYS_ON_PATTERN = r"(?U)([0-9]+)\s*days?\s*on\s*"
MLS_NUMBER_PATTERN = r"(?U)MLS#?\s*[:\s]?([0-9]+)"

# Ordered URL patterns of two older portals.
PORTAL_ID_PATTERNS = (
    r"(?i)_M([0-9]+-[0-9]+)$",
    r"(?i)_M([0-9]+)$",
    r"(?i)/realestateandhomes-detail/[^/]+_([A-Z0-9-]+)$",
    r"(?i)/([A-Z0-9]+-[0-9]+)/?$",
    r"(?i)property[_-]?id[=:]([A-Za-z0-9-]+)",
)
PORTAL_SLUG_PATTERN = r"/realestateandhomes-detail/([^?]+)"
LEGACY_ID_PATTERNS = (
    r"property[_-]?id[=:]([0-9]+)",
    r"/([0-9]{10,})",
    r"M([0-9]{10,})",
    r"/([A-Z0-9]{8,})",
)
