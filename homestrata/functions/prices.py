"""Prices, unit prices and their displays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from homestrata.functions.common import as_col, round_exact
from homestrata.site import NO_PRICE_WORDS, PRICE_FLOOR, SQFT_PER_ACRE


def parse_price(text: Column | str) -> Column:
    """Price in whole dollars from free text, NULL when there is none.

    Texts that name no price, unparsable numbers and amounts under the floor are NULL;
    cents are cut off.
    """
    text = as_col(text)
    worded = F.lower(text).rlike("|".join(NO_PRICE_WORDS))
    number = F.regexp_replace(text, "[^0-9.]", "")
    amount = F.when(
        number.contains("."), F.floor(number.try_cast("double")).try_cast("bigint")
    ).otherwise(number.try_cast("decimal(38,0)").try_cast("bigint"))
    return F.when(~worded & (amount >= PRICE_FLOOR), amount)


def to_stored_decimal(x: Column | str) -> Column:
    """Four decimals, the precision numbers are stored with."""
    return round_exact(x, 4).cast("decimal(38,4)")


def price_per_sqft(price: Column | str, sqft: Column | str) -> Column:
    price, sqft = as_col(price).cast("double"), as_col(sqft).cast("double")
    return F.when((price != 0) & (sqft > 0), round_exact(price / sqft))


def price_per_acre(price: Column | str, acres: Column | str, lot_sqft: Column | str) -> Column:
    """Acres win over square feet; NULL without a price or any lot size."""
    price = as_col(price).cast("double")
    acres, lot_sqft = as_col(acres).cast("double"), as_col(lot_sqft).cast("double")
    size = F.when(acres > 0, acres).when(lot_sqft > 0, lot_sqft / SQFT_PER_ACRE)
    return F.when(price > 0, round_exact(price / size))


def pct_change(new: Column | str, old: Column | str) -> Column:
    """Signed change in percent of ``old``, 0 when there is no positive ``old``."""
    new, old = as_col(new).cast("double"), as_col(old).cast("double")
    return F.when(old > 0, round_exact((new - old) / old * 100)).otherwise(0.0)


def discount_pct(psf: Column | str, median: Column | str) -> Column:
    """Distance from the city median in percent; negative is cheaper."""
    psf, median = as_col(psf).cast("double"), as_col(median).cast("double")
    return F.when(
        (median > 0) & (psf > 0), round_exact((psf - median) / median * 100)
    ).otherwise(0.0)


def price_changed(new: Column | str, old: Column | str) -> Column:
    """True when both prices are known and differ; NULL counts as unknown."""
    new, old = F.coalesce(as_col(new), F.lit(0)), F.coalesce(as_col(old), F.lit(0))
    return (new > 0) & (old > 0) & (new != old)


def discount_bucket(pct: Column | str) -> Column:
    """Market position against the city median."""
    pct = as_col(pct)
    return F.when(pct < -10, "below").when(pct > 10, "above").otherwise("near")


def market_position(pct: Column | str) -> Column:
    """Market position as a sentence."""
    pct = F.coalesce(as_col(pct).cast("double"), F.lit(0.0))
    shown = round_exact(pct, 1)
    return (
        F.when(pct < -10, F.format_string("%.1f%% BELOW city median (good value)", F.abs(shown)))
        .when(pct > 10, F.format_string("%.1f%% ABOVE city median (premium priced)", shown))
        .otherwise(F.format_string("Near city median (%+.1f%%)", shown))
    )


def discount_class(pct: Column | str) -> Column:
    """Display class of a discount; a NULL discount is neutral."""
    pct = as_col(pct)
    return F.when(pct < 0, "below").when(pct > 5, "above").otherwise("neutral")


def price_display(price: Column | str) -> Column:
    """'$450,000'"""
    return F.concat(F.lit("$"), F.format_number(as_col(price), 0))
