from __future__ import annotations

import datetime as dt
import json
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from homestrata.operators import collect, extract
from homestrata.sources import html

AS_OF = dt.datetime(2024, 5, 6, 7, 8)
PAGE = """
<html><head><title>x</title><script>"<a href='/CO/n/home/1'>"</script></head><body>
<div class="HomeCard"><a href="/CO/Paonia/1-Main-St/home/11">a</a>
  <span class="homecardV2Price">$450,000</span><a href="/CO/Paonia/1-Main-St/home/11">again</a></div>
<article class="listing x"><a href="https://www.redfin.com/CO/Paonia/2-Oak/home/22">b</a><p>Now $99,500!</p></article>
<div class="plain"><a href="/CO/Paonia/3-Elm/home/33">outside</a> $77,000</div>
<div class="card"><div class="inner-card"><b class="price">Call us</b><a href="/CO/P/4/home/44">d</a></div><i>$88,000</i></div>
<a href="/CO/Paonia/home/none">no digits</a><a href="/UT/x/home/5">other state</a><a href="x/CO/y/home/6">relative</a>
<div class="card"><a href="/CO/P/7/home/77">c</a><b class="Price-old">$5</b><b class="price">$60,000</b></div>
</body></html>
"""


def links_of(spark, pages):
    df = spark.createDataFrame(pages, "crawl_id string, page_no bigint, html string")
    return collect.listing_links(df, F.lit("Paonia"), F.lit("CO"))


def test_listing_links(spark):
    links = links_of(spark, [("c", 1, PAGE)])
    rows = [tuple(r) for r in links.orderBy("pos").select("url", "price", "address", "property_id").collect()]
    site = "https://www.redfin.com"
    assert rows == [
        (site + "/CO/Paonia/1-Main-St/home/11", 450000, "1 Main St", "11"),
        (site + "/CO/Paonia/1-Main-St/home/11", 450000, "1 Main St", "11"),
        (site + "/CO/Paonia/2-Oak/home/22", 99500, "2 Oak", "22"),
        (site + "/CO/Paonia/3-Elm/home/33", 0, "3 Elm", "33"),
        # the nearest card counts: its price element names no price and it holds no dollar text
        (site + "/CO/P/4/home/44", 0, "4", "44"),
        # the first price element is under the floor, and so is the first dollar text
        (site + "/CO/P/7/home/77", 0, "7", "77"),
    ]
    assert collect.first_seen(links).count() == 5


def card(n):
    return f'<div class="card"><a href="/CO/x/{n}/home/{n}">l</a></div>'


def test_crawl_stops(spark):
    pages = [("a", 1, card(1) + card(2)), ("a", 2, card(2) + card(3)), ("a", 3, card(1)), ("a", 4, card(4)),
             ("b", 1, card(1)), ("b", 2, ""), ("b", 3, card(9)),
             ("c", 1, card(1)), ("c", 2, None), ("c", 3, card(3)), ("c", 4, None), ("c", 5, card(5))]
    errors = {("c", 2): "Read Timeout", ("c", 4): "403 Forbidden"}
    links = links_of(spark, [p for p in pages if p[2] is not None])
    meta = spark.createDataFrame([(c, n, errors.get((c, n))) for c, n, _ in pages], "crawl_id string, page_no bigint, error string")
    got = collect.collected(meta, links).select("crawl_id", "page_no", "property_id").collect()
    assert sorted(map(tuple, got)) == [("a", 1, "1"), ("a", 1, "2"), ("a", 2, "3"), ("b", 1, "1"), ("c", 1, "1"), ("c", 3, "3")]


def meta(name, content, key="name"):
    return f'<meta {key}="{name}" content="{content}">'


def extracted(spark, *bodies):
    rows = [(f"https://s.example/CO/x/home/{i + 1}", b, None) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "url string, html string, error string")
    return extract.extract_listings(df, AS_OF).orderBy("listing_url").collect()


def test_meta_fields(spark):
    t = "twitter:text:"
    page = "".join([
        meta(t + "price", "$9,500"), meta(t + "price", "$1"), meta(t + "beds", "3"), meta(t + "baths", "2.5"),
        meta(t + "sqft", "1,900 sq ft"), meta(t + "street_address", "1 A St"), meta(t + "city", "Paonia"),
        meta(t + "state_code", "CO"), meta(t + "zip", "81428"), meta(t + "description_simple", "Big &amp;amp; old &amp;eacute;"),
        meta(t + "listing_source", "MLS"), meta("ICBM", "38.8, -107.5"),
    ])
    bad = meta(t + "beds", "2.5") + meta(t + "baths", "x") + meta(t + "price", "ask") + meta("ICBM", "1,2,3")
    good, none = extracted(spark, page, bad)
    assert (good.price, good.beds, good.baths, good.size_sqft) == (9500, 3, 2.5, 1900)
    assert (good.address, good.city, good.state, good.zip_code) == ("1 A St", "Paonia", "CO", "81428")
    assert (good.description, good.listing_source) == ("Big & old é", "MLS")
    assert (good.latitude, good.longitude, good.price_per_sqft) == (38.8, -107.5, 5.0)
    assert (good.property_id, good.site_id) == ("PROP#20240506_1", "1")
    assert (none.price, none.beds, none.baths, none.latitude) == (None, None, None, None)


def ld(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return f'<script type="application/ld+json">{text}</script>'


def test_structured_data(spark):
    house = {
        "@type": ["Thing", "House"], "name": "T1", "description": "d" * 1500, "datePosted": "2024-01-01",
        "offers": {"price": 450000}, "address": {"streetAddress": "9 B", "addressLocality": "Hotchkiss"},
        "mainEntity": {
            "yearBuilt": "1975", "accommodationCategory": "Cabin", "geo": {"latitude": "38.5", "longitude": -107},
            "amenityFeature": [{"name": "Covered Parking"}, {"name": "Garage 2"}, {"name": "Pool"}, "x", {"n": 1}],
            "image": ["u1", {"url": "u2"}, {"x": 1}] + [f"v{i}" for i in range(60)],
        },
    }
    later = [{"@type": "Event", "name": "no"}, {"@type": "Product", "offers": {"price": "$460,000"}, "name": "T2"}]
    (row,) = extracted(spark, ld(house) + ld("{broken") + ld(later) + ld("3"))
    assert (row.price, row.title, row.address, row.city, row.state) == (460000, "T2", "9 B", "Hotchkiss", None)
    assert (row.year_built, row.property_type, row.latitude, row.longitude) == (1975, "Cabin", 38.5, -107.0)
    assert (row.parking, row.amenities) == ("Garage 2", ["Covered Parking", "Garage 2", "Pool"])
    assert (len(row.image_urls), row.image_count, row.image_urls[:3]) == (40, 62, ["u1", "u2", "v0"])
    assert (len(row.description), row.date_listed) == (1000, "2024-01-01")


def test_text_and_precedence(spark):
    text = """<body><style>built 1800</style><p>Year&nbsp;Built: 1962</p><p>2.5 acre</p> HOA $50 <b>12 days</b> on
        Redfin <i>MLS#</i> 777 townhouse condo</body>"""
    plain, merged = extracted(spark, text, meta("twitter:text:beds", "0") + ld({"@type": "House", "mainEntity": {"yearBuilt": 2001}}) + text)
    assert (plain.year_built, plain.lot_size_acres, plain.lot_size_sqft) == (1962, 2.5, 108900)
    assert (plain.hoa_fee, plain.days_on_market, plain.mls_number, plain.property_type) == (50, 12, "777", "Condo")
    assert (merged.year_built, merged.beds) == (2001, None)


def test_photos(spark):
    host = "https://ssl.cdn-redfin.com/photo/"
    page = (
        '<img src="' + host + 'genMid.1.jpg"><img data-src="' + host + 'bigphoto/2.jpg"><img src="' + host + 'thumb.jpg">'
        + '<img src="https://other/bigphoto.jpg">' + meta("og:image", host + "m.jpg", key="property")
        + meta("twitter:image:src", host + "genMid.1.jpg") + f'<link rel="preload" as="image" href="{host}p.jpg">'
        + "".join(f'<img src="{host}mbpaddedwide/{i}.jpg">' for i in range(30))
    )
    (row,) = extracted(spark, page)
    assert row.image_urls[:4] == [host + "m.jpg", host + "genMid.1.jpg", host + "p.jpg", host + "bigphoto/2.jpg"]
    assert (len(row.image_urls), row.image_count) == (20, 34)


def test_page_text_and_broken_html(spark):
    pages = ["<p>a <b>b</b><script>x</script></p></div>c&amp;d<!-- no -->", "<div><p>open", None, "plain < text"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    got = [r.text for r in html.read_pages(df, ["text"]).orderBy("i").collect()]
    assert got == ["a b c&d", "open", "", "plain < text"]


def test_a_worker_holds_few_pages(spark):
    """A large batch is read in pieces, each handed on before the next is read."""
    n = 3 * html.PAGES_AT_ONCE + 1
    pages = pa.table({"page_id": list(range(n)), "html": [f"<p>a{i}</p>" if i % 5 else None for i in range(n)]})
    batch = pages.combine_chunks().to_batches()[0]
    read = list(html._read_batches(iter([batch, batch.slice(0, 0)]), "html", ["page_id"], ["text"]))
    assert [b.num_rows for b in read] == [html.PAGES_AT_ONCE] * 3 + [1]
    rows = pa.Table.from_batches(read).to_pylist()
    assert rows == [{"page_id": i, "text": f"a{i}" if i % 5 else ""} for i in range(n)]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


ODD = """<div class="homecard">|</div>|<a href="/x?a=1&amp;b=2">|</a>|<a href=x/>|<A HREF = "q">|<br/>|<br / >|<img src="a" SRC="b" data-src>
<script>|<script type="application/ld+json">|{"a":"</b>"}|</script>|</ script >|</script x>|<style>|</style>|p{}<|<!-- c -->|<!--|-->
<!DOCTYPE html>|<!doctype|<?pi?>|<![CDATA[x]]>|<!x>|</>|</ x>|< |<|>|&|&amp|&#39;|&copy x| text $1,200 |\x0b|\xa0|<p class=price>
<span class="price">|</span>|<span class="Price" class="b">$5|<meta name="a" content="b&lt;">|<meta property="og:image" content="u"/>
<link rel="preload" as="image" href="z">|<a href='1' >|<a\x0bhref="x">|<a b"c="d">|<a b="c"d="e">|<x:y-z k.l:m="1">|<\xe9>|<p \xe9="1">
<template>|</template>|"|'|=|/|<a href="|<input disabled value="">|<a/b="c">|<a =b>|<p a=>|<script/>|<title>|</title>|\x00|<a\x00>|<1>|</1>"""


def found_by(reader):
    links = [(href, card and (card.price, card.dollar)) for href, card in reader.links]
    return reader.words, reader.metas, reader.ld_json, reader.images, links


def test_odd_pages_read_as_by_the_library():
    rng, parts = random.Random(4), re.split(r"[|\n]", ODD)
    for _ in range(5000):
        page = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        one, other = html._PageReader(), html._PageReader()
        one.read(page)
        other.feed(page)
        other.close()
        assert found_by(one) == found_by(other), page


def test_plain_tags_take_one_pattern_each(monkeypatch):
    """The library's rules, several patterns and calls for each tag, are for odd tags only."""
    seen = []
    monkeypatch.setattr(html._PageReader, "parse_starttag", lambda self, i: seen.append(i) or -1)
    batch = pa.record_batch([pa.array([re.sub("(?<=<|/)script", "b", PAGE).replace("'", '"'), None])], names=["html"])
    read = pa.Table.from_batches(html._read_batches(iter([batch]), "html", [], ["links"])).to_pylist()
    assert not seen and [len(row["links"]) for row in read] == [10, 0]
