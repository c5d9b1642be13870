from __future__ import annotations

import datetime as dt

from homestrata.plans import jobs
from homestrata.schemas import LISTING_SAVED, TRACKED_URLS

AS_OF = dt.datetime(2024, 5, 6)


def result_page(*cards):
    return "".join(f'<div class="card"><a href="/CO/P/{n}-St/home/{n}">x</a><b class="price">${p}</b></div>' for n, p in cards)


def detail(n, price, sqft, city="Paonia"):
    t = "twitter:text:"
    tags = {"price": price, "sqft": sqft, "city": city}
    return "".join(f'<meta name="{t}{k}" content="{v}">' for k, v in tags.items()) + "<p>2.0 acre</p>"


def test_collect_process_analyze(spark, tmp_path):
    tracked = spark.createDataFrame([], TRACKED_URLS)
    listings = spark.createDataFrame([], LISTING_SAVED)
    site = "https://www.redfin.com/CO/P/"

    # first run: two pages, everything is new
    pages = spark.createDataFrame(
        [("c", 1, "Paonia", "CO", result_page((1, 100000), (2, 200000)), None), ("c", 2, "Paonia", "CO", result_page((3, 300000)), None),
         ("c", 3, "Paonia", "CO", "", None), ("c", 4, "Paonia", "CO", result_page((4, 400000)), None)],
        "crawl_id string, page_no bigint, city string, state string, html string, error string")
    one = str(tmp_path / "one")
    jobs.collect_job(pages, tracked, listings, one, AS_OF)
    tracked = spark.read.parquet(one + "/tracked_urls")
    assert sorted(r.url for r in tracked.collect()) == [f"{site}{n}-St/home/{n}" for n in (1, 2, 3)]
    summary = spark.read.json(one + "/summary").first()
    assert (summary.total_urls_found, summary.new_urls_tracked) == (3, 3)

    # detail pages: one fails, one has no city of its own
    details = spark.createDataFrame(
        [(f"{site}1-St/home/1", detail(1, "$100,000", 1000), None), (f"{site}2-St/home/2", detail(2, "$200,000", 1000, ""), None),
         (f"{site}3-St/home/3", None, "403 Forbidden"), (f"{site}9-St/home/9", detail(9, "$1", 1), None)],
        "url string, html string, error string")
    two = str(tmp_path / "two")
    jobs.process_job(details, tracked, listings, two, AS_OF)
    listings = spark.read.parquet(two + "/listings")
    rows = {r.site_id: r for r in listings.collect()}
    assert {k: (r.price, r.city, r.price_per_sqft, r.lot_size_acres) for k, r in rows.items()} == {
        "1": (100000, "Paonia", 100.0, 2.0), "2": (200000, "Paonia", 200.0, 2.0)}
    assert spark.read.json(two + "/summary").first().blocked == 1
    assert [r.error for r in spark.read.parquet(two + "/errors").collect()] == ["403 Forbidden"]
    tracked = spark.read.parquet(two + "/tracked_urls")
    assert tracked.where("processed").count() == 2

    # a bounded batch takes the first URLs in order
    batch = str(tmp_path / "batch")
    jobs.process_job(details, spark.read.parquet(one + "/tracked_urls"), spark.createDataFrame([], LISTING_SAVED), batch, AS_OF, batch_size=1)
    assert [r.site_id for r in spark.read.parquet(batch + "/listings").collect()] == ["1"]

    # analysis
    three = str(tmp_path / "three")
    jobs.analyze_job(listings, three, AS_OF)
    listings = spark.read.parquet(three + "/listings")
    got = {r.site_id: (r.city_median_price_per_sqft, r.city_discount_pct, r.price_per_acre) for r in listings.collect()}
    assert got == {"1": (150.0, -33.33, 50000.0), "2": (150.0, 33.33, 100000.0)}
    capped = str(tmp_path / "capped")
    jobs.analyze_job(listings, capped, AS_OF, max_properties=1)
    assert sorted(r.city_property_count for r in spark.read.parquet(capped + "/listings").collect()) == [1, 2]

    # second collection: a price moved
    again = spark.createDataFrame([("c", 1, "Paonia", "CO", result_page((1, 110000), (2, 200000), (5, 1)), None)], pages.schema)
    four = str(tmp_path / "four")
    status = jobs.collect_job(again, tracked, listings, four, AS_OF)
    assert {r.property_id: r.status for r in status.collect()} == {"1": "price_changed", "2": "unchanged", "5": "new"}
    row = spark.read.parquet(four + "/listings").where("site_id = '1'").first()
    assert (row.price, row.original_price, row.last_price_change_pct, row.city_discount_pct) == (110000, 100000, 10.0, -33.33)
