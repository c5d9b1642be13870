"""Listing-shaped views over the given tables.

The given tables hold orders, events and texts, not listings. These views read them as
listings, crawls, price observations, preference events and pages; each has the same
definition in Spark (functions) and in SQL (``VIEWS``). An order is a listing, its
lines are its rooms, a customer's nation is its city.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestrata.functions.prices import price_per_sqft
from homestrata.session import configure

AS_OF = dt.datetime(2002, 1, 1)
TRACKED_UNTIL = dt.datetime(1998, 1, 1)


class Tables:
    """The given tables of one directory, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


class StreamTables(Tables):
    """The same tables read as streams of files; every view works on either."""

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        schema = super().__getattr__(name).schema
        files = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
        return files.parquet(self.dir)


def _utc(c: str) -> Column:
    return F.col(c).cast("timestamp")


def listings(t: Tables) -> DataFrame:
    rooms = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("_qty"),
        F.count("*").alias("_n"),
        F.max("l_linenumber").alias("_ln"),
        F.max("l_shipdate").alias("_shipped"),
    )
    # nation and region are fixed code tables of 25 and 5 rows
    places = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    owners = t.customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    # both sides are as large as the data: joined by key at any size, on all cores
    rows = t.orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).join(
        rooms.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    key = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    price = F.floor("o_totalprice")
    sqft = (F.col("_qty") * 10).cast("int")
    city = F.when(status == "P", F.concat("n_name", F.lit(" "))).otherwise(F.col("n_name"))
    urls = F.transform(
        F.sequence(F.lit(1), F.col("_n").cast("int")),
        lambda i: F.concat(F.lit("https://img.example/"), key, F.lit("/"), i.cast("string")),
    )
    return rows.select(
        F.concat(F.lit("PROP#"), key).alias("property_id"),
        F.lit("META").alias("sort_key"),
        F.concat(
            F.lit("https://www.redfin.com/"), "r_name", F.lit("/"), "n_name", F.lit("/"), key,
            F.lit("-Main-St/home/"), key,
        ).alias("listing_url"),
        price.alias("price"),
        sqft.alias("size_sqft"),
        price_per_sqft(price, sqft).alias("price_per_sqft"),
        F.col("_n").cast("int").alias("beds"),
        (F.col("_ln") / F.lit(2.0)).alias("baths"),
        F.when(status == "F", F.col("_qty") / 10).alias("lot_size_acres"),
        F.when(status == "O", (F.col("_qty") * 100).cast("int")).alias("lot_size_sqft"),
        city.alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(F.col("o_custkey").cast("string"), 5, "0").alias("zip_code"),
        F.concat(key, F.lit(" Main St")).alias("address"),
        F.col("o_orderpriority").alias("property_type"),
        (F.year("o_orderdate") - 10 * F.col("_n")).cast("int").alias("year_built"),
        F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal").cast("int")).alias("hoa_fee"),
        key.alias("mls_number"),
        F.datediff("_shipped", "o_orderdate").alias("days_on_market"),
        urls.alias("image_urls"),
        F.col("_n").cast("int").alias("image_count"),
        _utc("o_orderdate").alias("first_seen_date"),
        F.to_date("_shipped").alias("analysis_date"),
    )


def tracked(t: Tables) -> DataFrame:
    """A tracked URL per listing; those first seen later are of another site, so not observed."""
    kind = F.col("property_type")
    elsewhere = F.concat(F.lit("https://elsewhere.example/home/"), F.col("mls_number"))
    return listings(t).select(
        F.when(F.col("first_seen_date") < F.lit(TRACKED_UNTIL), F.col("listing_url")).otherwise(elsewhere).alias("url"),
        F.when(kind == "1-URGENT", F.lit(True))
        .when(kind == "2-HIGH", F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
        .alias("processed"),
        F.when(kind != "5-LOW", F.col("city")).alias("city"),
        "price",
    )


def known(t: Tables) -> DataFrame:
    """A known listing per order; those of one kind have other ids and URLs, so are not observed."""
    other = F.col("property_type") == "3-MEDIUM"
    number = F.col("mls_number")
    key = F.when(other, F.concat(F.lit("PROP#M"), number)).otherwise(F.col("property_id"))
    url = F.when(other, F.concat(F.lit("https://elsewhere.example/"), number)).otherwise(F.col("listing_url"))
    return listings(t).withColumn("property_id", key).withColumn("listing_url", url)


def observations(t: Tables) -> DataFrame:
    raised = F.when(F.col("property_type") == "4-NOT SPECIFIED", F.col("price") + 1000)
    return listings(t).select(
        F.col("listing_url").alias("url"), F.coalesce(raised, "price").alias("price"), "city"
    )


def order_observations(t: Tables) -> DataFrame:
    """Observations from orders alone, without the joins a stream could not make.

    Orders of a status other than 'F' show a price 1000 above the stored one.
    """
    key = F.col("o_orderkey").cast("string")
    price = F.floor("o_totalprice")
    return t.orders.select(
        F.lit("crawl").alias("crawl_id"),
        F.col("o_orderkey").alias("page_no"),
        F.lit(0).alias("pos"),
        F.concat(F.lit("https://www.redfin.com/x/home/"), key).alias("url"),
        F.when(F.col("o_orderstatus") == "F", price).otherwise(price + 1000).alias("price"),
        F.lit(None).cast("string").alias("city"),
        _utc("o_orderdate").alias("ts"),
    )


def crawl_pages(t: Tables) -> DataFrame:
    """One result page per order; a crawl is a customer's orders."""
    timed_out = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    error = F.when(timed_out, "Read timeout").when(F.col("o_totalprice") < 5000, "500 Server Error")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("crawl_id"),
        F.col("o_orderkey").alias("page_no"),
        error.alias("error"),
    )


def crawl_observations(t: Tables) -> DataFrame:
    good = crawl_pages(t).where(F.col("error").isNull())
    return t.lineitem.join(good, F.col("l_orderkey") == F.col("page_no")).select(
        "crawl_id",
        "page_no",
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.concat(F.lit("/home/"), F.col("l_suppkey").cast("string")).alias("url"),
    )


PRICE_TIES = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


def price_observations(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("PROP#"), F.col("l_partkey").cast("string")).alias("property_id"),
        _utc("l_shipdate").alias("ts"),
        (F.floor(F.col("l_extendedprice") / 20000) * 20000).alias("price"),
        *PRICE_TIES,
    )


def _event_key() -> Column:
    return F.concat(F.lit("PROP#"), F.get_json_object("props", "$.k"))


def preference_events(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    action = F.when(kind.isin("view", "signup"), "favorite").when(kind == "click", "hidden").otherwise("remove")
    return t.events.select(
        "user_id",
        _event_key().alias("property_id"),
        action.alias("action"),
        _utc("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def status_events(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind.isin("signup", "view"), "processing").when(kind == "error", "failed").otherwise("completed")
    return t.events.select(
        "user_id",
        _event_key().alias("property_id"),
        status.alias("status"),
        F.when(kind == "error", F.concat(F.lit("error "), F.col("value").cast("string"))).alias("error"),
        _utc("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def texts(t: Tables) -> DataFrame:
    """Documents opened by a phrase built from the document's own numbers."""
    n, d = F.col("n_chars").cast("string"), F.col("doc_id").cast("string")
    year = (1700 + F.col("n_chars") / 10).cast("int").cast("string")
    lang = F.col("lang")
    price_text = (
        F.when(lang == "en", F.concat(F.lit("Asking $"), n, F.lit("00.50")))
        .when(lang == "fr", F.concat(F.lit("Call for price "), n, F.lit("000")))
        .when(lang == "de", F.concat(F.lit("$1.2."), n))
        .otherwise(F.concat(F.lit("USD "), n, F.lit("9")))
    )
    facts = (
        F.when(
            lang == "en",
            F.concat(F.lit(". Year Built: "), year, F.lit(". Lot "), n, F.lit(".5 acre, HOA $"), n,
                     F.lit("/month. MLS# "), d, F.lit(". 12 days on Redfin. ")),
        )
        .when(lang == "fr", F.concat(F.lit(". Lot size: "), n, F.lit(" sq ft, built "), year,
                                     F.lit(", 1 day on redfin, duplex. ")))
        .when(lang == "de", F.concat(F.lit(" Mobile home, 9"), n, F.lit(",000 ac, hoa: "), d, F.lit(". ")))
        .otherwise(F.concat(F.lit(" single-family condo, 0."), n, F.lit(" acres, mls "), d, F.lit(". ")))
    )
    return t.documents.select(
        "doc_id", "lang", price_text.alias("price_text"), F.concat(price_text, facts, "text").alias("text")
    )


def _or_blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def _spread(t: Tables, rows: DataFrame) -> DataFrame:
    """All cores for the page stage: few bytes per row, but each becomes a page to parse.

    Stored pages need no such thing, they are read in splits.
    """
    cores = t.spark.sparkContext.defaultParallelism
    return rows.repartition(max(cores, int(t.spark.conf.get("spark.sql.shuffle.partitions"))))


def result_pages(t: Tables) -> DataFrame:
    """A search-result page per listing: cards, a repeated link and links that do not count."""
    path = F.regexp_replace("listing_url", "^https://[^/]*", "")
    html = F.concat(
        F.lit("<html><head><title>Results</title><script>var a='<a href=\"/x/home/1\">';</script></head><body>"),
        F.lit('<div class="bp-HomeCard"><a class="link" href="'), path, F.lit('"><b>'), "address",
        F.lit('</b></a><span class="homecardV2Price">$'), F.format_number("price", 0),
        F.lit('</span><a href="'), path, F.lit('">again</a></div>'),
        F.lit('<article class="listing"><p>unit</p><a href="https://www.redfin.com'), path,
        F.lit("/unit-1/home/7"), "mls_number", F.lit('">unit</a><p>From $'), _or_blank("hoa_fee"),
        F.lit(',000 now</p></article><p><a href="'), path, F.lit('-b/home/77">no card</a></p>'),
        F.lit('<a href="/about/home/9">about</a><a href="/'), "state", F.lit('/x/home/">none</a></body></html>'),
    )
    return _spread(t, listings(t)).select(
        F.col("mls_number").alias("crawl_id"),
        F.lit(1).cast("bigint").alias("page_no"),
        F.trim("city").alias("city"),
        "state",
        html.alias("html"),
    )


def detail_pages(t: Tables) -> DataFrame:
    """A detail page per listing; which sources it has depends on the kind of listing."""
    kind = F.col("property_type")

    def meta(name: str, content: Column) -> Column:
        return F.concat(F.lit(f'<meta name="{name}" content="'), _or_blank(content), F.lit('">'))

    text_tag = "twitter:text:"
    metas = F.concat(
        meta(text_tag + "price", F.concat(F.lit("$"), F.format_number("price", 0))),
        meta(text_tag + "beds", F.col("beds")),
        meta(text_tag + "baths", F.col("baths")),
        meta(text_tag + "sqft", F.concat(F.col("size_sqft").cast("string"), F.lit(" sq ft"))),
        meta(text_tag + "city", F.trim("city")),
        meta(text_tag + "description_simple", F.lit("Nice &amp;amp; big")),
        meta("ICBM", F.concat(F.lit("12.5, -"), "mls_number")),
    )
    data = F.concat(
        F.lit('<script type="application/ld+json">[{"@type":"Organization","name":"x"},{"@type":["House","Thing"],'),
        F.lit('"name":"T '), "mls_number", F.lit('","offers":{"price":"$'), F.col("price").cast("string"),
        F.lit('.75"},"address":{"streetAddress":"'), "address",
        F.lit('","addressLocality":"LD City","addressRegion":"","postalCode":"99"},"mainEntity":{"yearBuilt":1980,'),
        F.lit('"accommodationCategory":"Cabin","geo":{"latitude":1.5,"longitude":-2.5},"amenityFeature":'),
        F.lit('[{"name":"Pool"},{"name":"2 Car Garage"},"x"],"image":["https://a/1.jpg",{"url":"https://a/2.jpg"}]}}]'),
        F.lit('</script><script type="application/ld+json">{broken</script>'),
    )
    photo = F.lit("https://ssl.cdn-redfin.com/photo/1/")
    images = F.concat(
        F.lit('<meta property="og:image" content="'), photo, F.lit("bigphoto/"), "mls_number", F.lit('.jpg">'),
        F.lit('<img src="'), photo, F.lit("genMid."), "mls_number", F.lit('.jpg"><img data-src="'), photo,
        F.lit('thumb.jpg"><img src="https://other.example/bigphoto.jpg"><img src="'), photo, F.lit("bigphoto/"),
        "mls_number", F.lit('.jpg">'),
    )
    body = F.concat(
        F.lit("<style>p{}</style><p>Year&nbsp;built: 1950</p><p>Lot size: "), _or_blank("lot_size_sqft"),
        F.lit(" sq ft</p><div>HOA&nbsp;$120/month <b>15 days</b> on Redfin</div><p>MLS# "), "mls_number",
        F.lit(" Townhouse</p>"),
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>Home</title>"),
        F.when(kind.isin("1-URGENT", "2-HIGH"), metas).otherwise(""),
        F.when(kind == "1-URGENT", images).otherwise(""),
        F.when(kind.isin("2-HIGH", "3-MEDIUM", "5-LOW"), data).otherwise(""),
        F.lit("</head><body>"),
        body,
        F.lit("</body></html>"),
    )
    return _spread(t, listings(t)).select(
        F.col("listing_url").alias("url"),
        html.alias("html"),
        F.lit(None).cast("string").alias("error"),
    )


# The same views for DuckDB. R2/R1 mark rounding to 2/1 decimals.
VIEWS = {
    "li": """
        SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS n, max(l_linenumber) AS ln, max(l_shipdate) AS sd
        FROM lineitem GROUP BY l_orderkey""",
    "listings": """
        SELECT 'PROP#' || o_orderkey AS property_id, 'META' AS sort_key,
          'https://www.redfin.com/' || r_name || '/' || n_name || '/' || o_orderkey || '-Main-St/home/' || o_orderkey
            AS listing_url,
          CAST(floor(o_totalprice) AS BIGINT) AS price,
          CAST(qty * 10 AS INTEGER) AS size_sqft,
          CASE WHEN floor(o_totalprice) <> 0 AND qty > 0 THEN R2(floor(o_totalprice) / (qty * 10)) END AS price_per_sqft,
          CAST(n AS INTEGER) AS beds,
          ln / CAST(2 AS DOUBLE) AS baths,
          CASE WHEN o_orderstatus = 'F' THEN qty / 10 END AS lot_size_acres,
          CASE WHEN o_orderstatus = 'O' THEN CAST(qty * 100 AS INTEGER) END AS lot_size_sqft,
          CASE WHEN o_orderstatus = 'P' THEN n_name || ' ' ELSE n_name END AS city,
          r_name AS state,
          lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS zip_code,
          o_orderkey || ' Main St' AS address,
          o_orderpriority AS property_type,
          CAST(year(o_orderdate) - 10 * n AS INTEGER) AS year_built,
          CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS INTEGER) END AS hoa_fee,
          CAST(o_orderkey AS VARCHAR) AS mls_number,
          CAST(date_diff('day', o_orderdate, sd) AS INTEGER) AS days_on_market,
          CASE WHEN n IS NOT NULL THEN
            list_transform(range(1, n + 1), lambda i: 'https://img.example/' || o_orderkey || '/' || i) END AS image_urls,
          CAST(n AS INTEGER) AS image_count,
          o_orderdate AS first_seen_date,
          CAST(sd AS DATE) AS analysis_date
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey LEFT JOIN li ON o_orderkey = l_orderkey""",
    "tracked": """
        SELECT CASE WHEN first_seen_date < TIMESTAMP '1998-01-01' THEN listing_url
            ELSE 'https://elsewhere.example/home/' || mls_number END AS url,
          CASE property_type WHEN '1-URGENT' THEN TRUE WHEN '2-HIGH' THEN NULL ELSE FALSE END AS processed,
          CASE WHEN property_type <> '5-LOW' THEN city END AS city, price
        FROM listings""",
    "known": """
        SELECT * REPLACE (
          CASE WHEN property_type = '3-MEDIUM' THEN 'PROP#M' || mls_number ELSE property_id END AS property_id,
          CASE WHEN property_type = '3-MEDIUM' THEN 'https://elsewhere.example/' || mls_number
            ELSE listing_url END AS listing_url)
        FROM listings""",
    "observations": """
        SELECT listing_url AS url,
          CASE WHEN property_type = '4-NOT SPECIFIED' THEN price + 1000 ELSE price END AS price, city
        FROM listings""",
    "crawl_pages": """
        SELECT CAST(o_custkey AS VARCHAR) AS crawl_id, o_orderkey AS page_no,
          CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Read timeout'
               WHEN o_totalprice < 5000 THEN '500 Server Error' END AS error
        FROM orders""",
    "crawl_obs": """
        SELECT crawl_id, page_no, l_partkey * 10 + l_linenumber AS pos, '/home/' || l_suppkey AS url
        FROM lineitem JOIN crawl_pages ON l_orderkey = page_no WHERE error IS NULL""",
    "price_obs": """
        SELECT 'PROP#' || l_partkey AS property_id, l_shipdate AS ts,
          CAST(floor(l_extendedprice / 20000) * 20000 AS BIGINT) AS price,
          l_orderkey, l_linenumber, l_suppkey, l_extendedprice
        FROM lineitem""",
    "pref_events": """
        SELECT user_id, 'PROP#' || json_extract_string(props, '$.k') AS property_id,
          CASE WHEN event_type IN ('view', 'signup') THEN 'favorite' WHEN event_type = 'click' THEN 'hidden'
            ELSE 'remove' END AS action,
          ts, event_id AS seq
        FROM events""",
    "status_events": """
        SELECT user_id, 'PROP#' || json_extract_string(props, '$.k') AS property_id,
          CASE WHEN event_type IN ('signup', 'view') THEN 'processing' WHEN event_type = 'error' THEN 'failed'
            ELSE 'completed' END AS status,
          CASE WHEN event_type = 'error' THEN 'error ' || value END AS error, ts, event_id AS seq
        FROM events""",
    "texts": """
        SELECT doc_id, lang, price_text, price_text || CASE lang
            WHEN 'en' THEN '. Year Built: ' || yr || '. Lot ' || n_chars || '.5 acre, HOA $' || n_chars ||
              '/month. MLS# ' || doc_id || '. 12 days on Redfin. '
            WHEN 'fr' THEN '. Lot size: ' || n_chars || ' sq ft, built ' || yr || ', 1 day on redfin, duplex. '
            WHEN 'de' THEN ' Mobile home, 9' || n_chars || ',000 ac, hoa: ' || doc_id || '. '
            ELSE ' single-family condo, 0.' || n_chars || ' acres, mls ' || doc_id || '. ' END || text AS text
        FROM (
          SELECT *, CAST(trunc(1700 + n_chars / 10) AS INTEGER) AS yr, CASE lang
            WHEN 'en' THEN 'Asking $' || n_chars || '00.50' WHEN 'fr' THEN 'Call for price ' || n_chars || '000'
            WHEN 'de' THEN '$1.2.' || n_chars ELSE 'USD ' || n_chars || '9' END AS price_text
          FROM documents)""",
    "city_stats": """
        SELECT trim(city) AS city, median(price_per_sqft) AS med, count(*) AS n
        FROM listings WHERE trim(city) <> '' AND price_per_sqft > 0 GROUP BY trim(city)""",
    "changes": """
        SELECT *, row_number() OVER w AS change_no FROM (
          SELECT *, first_value(price) OVER w0 AS original_price FROM (
            SELECT *, lag(price) OVER w0 AS previous_price FROM price_obs WHERE price > 0
            WINDOW w0 AS (PARTITION BY property_id ORDER BY ts, l_orderkey, l_linenumber, l_suppkey, l_extendedprice))
          WINDOW w0 AS (PARTITION BY property_id ORDER BY ts, l_orderkey, l_linenumber, l_suppkey, l_extendedprice))
        WHERE previous_price <> price
        WINDOW w AS (PARTITION BY property_id ORDER BY ts, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)""",
    "preferences": """
        SELECT e.user_id, e.property_id, arg_min(e.action, e.seq) AS preference_type, min(e.ts) AS created_at
        FROM pref_events e LEFT JOIN (
          SELECT user_id, property_id, max(seq) AS gone FROM pref_events WHERE action = 'remove'
          GROUP BY user_id, property_id) r
        ON e.user_id = r.user_id AND e.property_id = r.property_id
        WHERE e.action <> 'remove' AND (gone IS NULL OR e.seq > gone)
        GROUP BY e.user_id, e.property_id""",
}
_NEEDS = {
    "listings": ["li"], "tracked": ["listings"], "known": ["listings"], "observations": ["listings"],
    "crawl_obs": ["crawl_pages"], "city_stats": ["listings"], "changes": ["price_obs"],
    "preferences": ["pref_events"],
}


def sql(body: str, *views: str) -> str:
    """``body`` over the named views; rounding marks are resolved."""
    order: list[str] = []

    def need(name: str) -> None:
        for parent in _NEEDS.get(name, []):
            need(parent)
        if name not in order:
            order.append(name)

    for view in views:
        need(view)
    ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in order)
    return _resolve_rounding((f"WITH {ctes} " if order else "") + body)


def _resolve_rounding(text: str) -> str:
    """R2(x) -> the double nearest to x printed with 2 decimals (R1, R4 alike)."""
    for digits in (1, 2, 4):
        mark = f"R{digits}("
        while mark in text:
            start = text.index(mark)
            depth, end = 1, start + len(mark)
            while depth:
                depth += {"(": 1, ")": -1}.get(text[end], 0)
                end += 1
            inner = text[start + len(mark) : end - 1]
            shown = f"(CAST(format('{{:.{digits}f}}', CAST({inner} AS DOUBLE)) AS DOUBLE) + 0.0)"
            text = text[:start] + shown + text[end:]
    return text
