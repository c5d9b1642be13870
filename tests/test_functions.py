from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from homestrata.functions import ids, prices, records
from homestrata.functions import text as rules
from homestrata.functions.common import round_exact


def column_of(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn("v").alias("out")).orderBy("i").select("out").collect()]


def test_parse_price(spark):
    given = ["$450,000", "450000", "$12,000.75", "$9,999", "Call for price", "1.2.3", "$1.2M", None, "", ".",
             "Auction $900,000", "n/a 50000", "$10,000", "x" * 5 + "9" * 30]
    want = [450000, 450000, 12000, None, None, None, None, None, None, None, None, None, 10000, None]
    assert column_of(spark, prices.parse_price, given) == want


def test_listing_id(spark):
    long = "https://x.example/" + "a" * 60 + "/" + "b" * 60
    given = ["https://s.example/CO/Paonia/123-Main-St-81428/home/12345", "/CO/A/b/home/7?x", "https://s.example/a/b/c/d",
             "https://s.example/a//b/", "https://s.example", "https://s.example/?q=/x/y", long, None]
    want = ["12345", "7", "b_c_d", "a_b", None, None, ("a" * 60 + "_" + "b" * 60)[:100], None]
    assert column_of(spark, ids.listing_id, given) == want


def test_portal_ids(spark):
    base = "https://p.example/realestateandhomes-detail/"
    given = [base + "123-Main-St_Paonia_CO_81428_M12345-67890", base + "a_m777", base + "slug_AB-12", base + "a/b?x",
             "https://p.example/z/AB1-22/", "p?property-id=Q-1", "https://s.example/x/123-Main-St-81428/home/12345"]
    assert column_of(spark, ids.portal_listing_id, given) == ["12345-67890", "777", "AB-12", "a_b", "AB1-22", "Q-1", None]
    given = ["property_id:55", "/1234567890/x", "/x/M1234567890", "/x/ABCDEFGH", "/x/abcdefgh"]
    assert column_of(spark, ids.legacy_listing_id, given) == ["55", "1234567890", "1234567890", "ABCDEFGH", None]


def test_keys(spark, value):
    keys = ["PROP#20240101_123_4", "PROP#77", "nohash", "PROP#", "A#b_c#d"]
    assert column_of(spark, ids.parse_key, keys) == ["123_4", "77", None, None, "c"]
    short = lambda k: ids.parse_key(k, second_token_only=True)
    assert column_of(spark, short, keys[:2]) == ["123", "77"]
    day = F.lit(dt.date(2024, 1, 2))
    assert value(ids.build_key("k", day), k="9") == "PROP#20240102_9"
    assert value(ids.build_key("k"), k="9") == "PROP#9"
    assert value(ids.raw_listing_id("k", "u"), k="bad", u="/home/4") == "4"


def test_urls(spark):
    assert column_of(spark, lambda c: ids.absolute_url(c, "https://s"), ["/a", "http://b", "c"]) == ["https://s/a", "http://b", None]
    assert column_of(spark, ids.address_from_url, ["/CO/1-Main-St/home/3", "/x"]) == ["1 Main St", None]


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_round_exact_is_python_round(spark, digits):
    rng = random.Random(digits)
    given = [1.005, 2.675, 0.125, -0.125, 2.5, 3.5, -2.5, 0.0, -0.001, 1e17, 123456789.125, 1e-9]
    given += [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    given += [rng.randint(-(10**7), 10**7) / 1000 for _ in range(3000)]
    given += [rng.randint(1, 10**6) / rng.randint(1, 10**4) for _ in range(3000)]
    got = column_of(spark, lambda c: round_exact(c, digits), given, "double")
    assert got == [round(x, digits) for x in given]


def test_unit_prices(value):
    assert value(prices.price_per_sqft("p", "s"), p=100001, s=3) == round(100001 / 3, 2)
    assert value(prices.price_per_sqft("p", "s"), p=0, s=3) is None
    assert value(prices.price_per_sqft("p", "s"), p=5, s=0) is None
    ppa = prices.price_per_acre("p", "a", "s")
    assert value(ppa, p=435600, a=2.0, s=9) == 217800
    assert value(ppa, p=435600, a=0.0, s=43560) == 435600
    assert value(ppa, p=435600, a=0.0, s=0) is None
    assert value(ppa, p=0, a=2.0, s=1) is None


def test_discounts(spark, value):
    assert value(prices.discount_pct("p", "m"), p=90.0, m=100.0) == -10.0
    assert value(prices.discount_pct("p", "m"), p=0.0, m=100.0) == 0.0
    assert column_of(spark, prices.discount_bucket, [-10.0, -10.01, 10.0, 10.01], "double") == ["near", "below", "near", "above"]
    shown = column_of(spark, prices.market_position, [-12.25, 12.25, 0.25, -3.0, None], "double")
    assert shown == ["12.2% BELOW city median (good value)", "12.2% ABOVE city median (premium priced)",
                     "Near city median (+0.2%)", "Near city median (-3.0%)", "Near city median (+0.0%)"]
    assert column_of(spark, prices.discount_class, [-0.1, 0.0, 5.0, 5.1, None], "double") == ["below", "neutral", "neutral", "above", "neutral"]
    assert column_of(spark, prices.price_display, [450000, None], "bigint") == ["$450,000", None]


def test_price_changed(spark):
    df = spark.createDataFrame([(2, 1), (1, 1), (0, 1), (1, 0), (None, 1), (1, None)], "n int, o int")
    assert [r[0] for r in df.select(prices.price_changed("n", "o")).collect()] == [True] + [False] * 5


def test_stored_decimal(value):
    assert str(value(prices.to_stored_decimal("x"), x=1.00005)) == f"{round(1.00005, 4):.4f}"


def test_text_fields(spark):
    year = lambda c: rules.year_built(c, 2024)
    assert column_of(spark, year, ["Built: 1987", "YEAR BUILT 1799", "built in 1990", "built 2025", "Year Built 1900"]) == [1987, None, None, None, 1900]
    assert column_of(spark, rules.lot_acres, ["1,234.5 acre", "2 ac.", "3 acres", "0 acre", "20000 ac", ". ac", "1.2.3 ac", "5 acé"]) == [1234.5, 2.0, None, None, None, None, None, None]
    assert column_of(spark, rules.lot_sqft, ["0.5 acre, lot size 900 sqft", "Lot Size: about 9,000 sq ft", "lot size 5", "lot size: , sqft"]) == [21780, 9000, None, None]
    kinds = ["A single-family condo", "Condominium", "townhome", "multifamily", "vacant", "manufactured", "island", "lots", "élot"]
    assert column_of(spark, rules.property_type, kinds) == ["Single Family", "Condo", "Townhouse", "Multi-Family", "Land", "Mobile", None, None, None]
    assert column_of(spark, rules.hoa_fee, ["HOA: $1,250 monthly", "hoa dues 5", "HOA ,"]) == [1250, None, None]
    assert column_of(spark, rules.days_on_market, ["14 days on Redfin", "1 day on redfin", "3 days on other"]) == [14, 1, None]
    assert column_of(spark, rules.mls_number, ["MLS# 123", "MLS#:456", "mls# 1", "MLS 9"]) == ["123", "456", None, "9"]


def test_reports(spark, value):
    given = ["Strong Buy now", "Verdict: PASS", "verdict: buy", "buy", "a compass verdict", "nothing"]
    assert column_of(spark, rules.verdict, given) == ["STRONG BUY", "PASS", "BUY", "CONSIDER", "PASS", "CONSIDER"]
    cut = rules.truncate_report("t", F.length("t") * 2, size_limit=10, keep=3)
    assert value(cut, t="abcdef") == "abc\n\n... [truncated]"
    assert value(cut, t="abcde") == "abcde"
    assert value(rules.cut("t"), t="x" * 600) == "x" * 500


def test_prune_and_precedence(spark, value):
    df = spark.createDataFrame([(1, "", 0, False, []), (0, "a", 2, True, ["x"])], "k int, s string, n int, b boolean, a array<string>")
    assert [tuple(r) for r in records.prune(df, never=("k",)).collect()] == [(1, None, None, None, None), (0, "a", 2, True, ["x"])]
    kept = records.prune(df, keep_zero=("n", "b"), never=("k",)).collect()
    assert tuple(kept[0]) == (1, None, 0, False, None)
    assert value(records.first_present(F.col("a"), F.col("b"), kind="string"), a="", b="z") == "z"
    assert value(records.first_present(F.col("a"), F.col("b"), kind="int"), a=0, b=7) == 7


def test_legacy_record_and_extras(spark):
    df = spark.createDataFrame([("PROP#1", "500", "", " 住居 "), ("PROP#2", "x", "w", None)], "property_id string, price string, ward string, `用途地域` string")
    known = spark.createDataFrame([("1", 400), ("2", 0)], "raw_id string, price bigint")
    rows = {r["property_id"]: r for r in records.legacy_record(df, known).collect()}
    one, two = rows["PROP#1"], rows["PROP#2"]
    assert (one["price"], one["previous_price"], one["ward"], one["district_key"], one["zoning"]) == (500, 400, "", None, "住居")
    assert (two["price"], two["previous_price"], two["district_key"], two["zoning"], two["floor"]) == (0, None, "DIST#w", None, None)
    base = spark.createDataFrame([("a", "", 0), ("b", "t", 1)], "property_id string, title string, price int")
    extra = spark.createDataFrame([("a", "T", 9, "e")], "property_id string, title string, price int, more string")
    merged = {r[0]: tuple(r) for r in records.merge_extras(base, extra).collect()}
    assert merged == {"a": ("a", "T", 0, "e"), "b": ("b", "t", 1, None)}
