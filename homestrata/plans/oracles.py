"""SQL twins of the registered queries, written independently of the operators."""

from __future__ import annotations

from homestrata.plans.standins import sql

ORACLES: dict[str, str] = {}


def _add(name: str, body: str, *views: str) -> None:
    ORACLES[name] = sql(body, *views)


# --- scans, lookups, sinks ---------------------------------------------------------

_add("q_scan_current", "SELECT property_id, price, city FROM listings WHERE sort_key = 'META'", "listings")
_add(
    "q_known_listings",
    "SELECT substr(property_id, 6) AS raw_id, property_id, price, listing_url, analysis_date FROM known",
    "known",
)
_add(
    "q_tracked_urls",
    """SELECT DISTINCT url, 'others' AS part FROM tracked WHERE city IS DISTINCT FROM 'NATION_3'
    UNION ALL SELECT DISTINCT url, 'city' FROM tracked WHERE city = 'NATION_3'""",
    "tracked",
)
_add(
    "q_unprocessed",
    "SELECT url, city, price FROM tracked WHERE processed IS NOT TRUE",
    "tracked",
)
_add(
    "q_unprocessed_batch",
    "SELECT url, city, price FROM tracked WHERE processed IS NOT TRUE ORDER BY url LIMIT 100",
    "tracked",
)
_add(
    "q_keyed_lookup",
    "SELECT property_id, price FROM listings WHERE property_id IN (SELECT property_id FROM status_events)",
    "listings",
    "status_events",
)
_add(
    "q_city_by_psf",
    """SELECT city, price_per_sqft, property_id, listing_url, price, size_sqft, beds, baths, year_built,
      property_type, row_number() OVER (ORDER BY price_per_sqft, property_id) AS rank
    FROM listings WHERE city = 'NATION_3' AND price_per_sqft IS NOT NULL""",
    "listings",
)
_add(
    "q_city_newest",
    """SELECT city, property_id, analysis_date,
      row_number() OVER (ORDER BY analysis_date DESC, property_id) AS rank FROM listings
    WHERE city = 'NATION_3' AND analysis_date IS NOT NULL""",
    "listings",
)
_add(
    "q_track_new_urls",
    """SELECT url, processed, city, price FROM tracked
    UNION ALL SELECT url, FALSE, coalesce(city, 'Unknown'), coalesce(price, 0) FROM observations
    WHERE url NOT IN (SELECT url FROM tracked)""",
    "tracked",
    "observations",
)
_add(
    "q_listing_dump",
    """SELECT url, price, '$' || format('{:,}', price) AS price_text,
      CASE WHEN count(*) OVER (PARTITION BY url) > 1 THEN 'yes' ELSE 'no' END AS duplicate
    FROM observations""",
    "observations",
)

# --- pages -------------------------------------------------------------------------

_add("q_pages_scan", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages")
_SPACE = r"[\s\x{a0}]+"
_add(
    "q_page_text",
    rf"""SELECT page_id, array_to_string(list_filter(list_transform(string_split(
        regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', chr(1), 'g'),
          '<[^>]*>', chr(1), 'g'), chr(1)),
        lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          regexp_replace(x, '^{_SPACE}|{_SPACE}$', '', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'),
          '&quot;?', chr(34), 'g'), '&copy;?', chr(169), 'g'), '&middot;?', chr(183), 'g'), '&amp;?', '&', 'g')),
        lambda x: x <> ''), ' ') AS text
    FROM pages""",
)
_add(
    "q_page_links",
    r"""SELECT page_id, CAST(unnest(range(len(links))) AS INTEGER) AS pos, unnest(links) AS href
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)""",
)
_PATH = "'/' || b.state || '/' || trim(b.city) || '/' || b.mls_number || '-Main-St/home/' || b.mls_number"
_add(
    "q_listing_links",
    f"""SELECT mls_number AS crawl_id, trim(city) AS city, state, 'redfin' AS source, l.*
    FROM (SELECT *, price AS asked FROM listings) b, LATERAL (
      SELECT 0 AS pos, 'https://www.redfin.com' || {_PATH} AS url,
        CASE WHEN b.asked >= 10000 THEN b.asked ELSE 0 END AS price,
        b.mls_number || ' Main St' AS address, b.mls_number AS property_id
      UNION ALL SELECT 2, 'https://www.redfin.com' || {_PATH} || '/unit-1/home/7' || b.mls_number,
        CASE WHEN b.hoa_fee * 1000 >= 10000 THEN b.hoa_fee * 1000 ELSE 0 END,
        b.mls_number || ' Main St', b.mls_number
      UNION ALL SELECT 3, 'https://www.redfin.com' || {_PATH} || '-b/home/77', 0, b.mls_number || ' Main St',
        b.mls_number
      ) l""",
    "listings",
)
_HAS_META = "property_type IN ('1-URGENT', '2-HIGH')"
_HAS_DATA = "property_type IN ('2-HIGH', '3-MEDIUM', '5-LOW')"
_add(
    "q_page_meta",
    f"""SELECT listing_url AS url, CASE WHEN {_HAS_META} THEN price END AS price,
      CASE WHEN {_HAS_META} THEN beds END AS beds, CASE WHEN {_HAS_META} THEN baths END AS baths,
      CASE WHEN {_HAS_META} THEN size_sqft END AS size_sqft, CAST(NULL AS VARCHAR) AS address,
      CASE WHEN {_HAS_META} THEN trim(city) END AS city, CAST(NULL AS VARCHAR) AS state,
      CAST(NULL AS VARCHAR) AS zip_code, CASE WHEN {_HAS_META} THEN 'Nice &amp; big' END AS description,
      CAST(NULL AS VARCHAR) AS listing_source, CASE WHEN {_HAS_META} THEN CAST(12.5 AS DOUBLE) END AS latitude,
      CASE WHEN {_HAS_META} THEN -CAST(mls_number AS DOUBLE) + 0.0 END AS longitude
    FROM listings""",
    "listings",
)
_add(
    "q_extract_listings",
    f"""SELECT *, CASE WHEN price <> 0 AND size_sqft > 0 THEN R2(price / size_sqft) END AS price_per_sqft FROM (
      SELECT 'PROP#20020101_' || mls_number AS property_id, mls_number AS site_id, listing_url,
        CASE WHEN {_HAS_META} THEN price WHEN {_HAS_DATA} AND price >= 10000 THEN price END AS price,
        CASE WHEN {_HAS_META} THEN beds END AS beds, CASE WHEN {_HAS_META} THEN baths END AS baths,
        CASE WHEN {_HAS_META} THEN size_sqft END AS size_sqft,
        CASE WHEN {_HAS_DATA} THEN address END AS address,
        CASE WHEN {_HAS_META} THEN trim(city) WHEN {_HAS_DATA} THEN 'LD City' END AS city,
        CAST(NULL AS VARCHAR) AS state, CASE WHEN {_HAS_DATA} THEN '99' END AS zip_code,
        CASE WHEN {_HAS_META} THEN 'Nice & big' END AS description,
        CASE WHEN {_HAS_META} THEN CAST(12.5 AS DOUBLE) WHEN {_HAS_DATA} THEN 1.5 END AS latitude,
        CASE WHEN {_HAS_META} AND mls_number <> '0' THEN -CAST(mls_number AS DOUBLE) WHEN {_HAS_DATA} THEN -2.5 END
          AS longitude,
        CASE WHEN {_HAS_DATA} THEN 'T ' || mls_number END AS title, CAST(NULL AS VARCHAR) AS date_listed,
        CAST(NULL AS VARCHAR) AS date_updated, CASE WHEN {_HAS_DATA} THEN 1980 ELSE 1950 END AS year_built,
        CASE WHEN {_HAS_DATA} THEN 'Cabin' ELSE 'Townhouse' END AS property_type,
        CASE WHEN {_HAS_DATA} THEN '2 Car Garage' END AS parking,
        CASE WHEN {_HAS_DATA} THEN 'Pool 2 Car Garage' END AS amenities,
        CASE WHEN property_type = '1-URGENT' THEN 'https://ssl.cdn-redfin.com/photo/1/bigphoto/' || mls_number ||
            '.jpg https://ssl.cdn-redfin.com/photo/1/genMid.' || mls_number || '.jpg'
          WHEN {_HAS_DATA} THEN 'https://a/1.jpg https://a/2.jpg' END AS image_urls,
        CASE WHEN {_HAS_DATA} OR property_type = '1-URGENT' THEN 2 END AS image_count,
        CAST(NULL AS DOUBLE) AS lot_size_acres, lot_size_sqft, 120 AS hoa_fee, mls_number, 15 AS days_on_market
      FROM listings)""",
    "listings",
)
_add(
    "q_json_props",
    """SELECT event_id, CAST(CASE WHEN event_type IN ('view', 'click') THEN 2 ELSE 0 END AS INTEGER) AS n_items,
      CASE WHEN event_type IN ('view', 'click') AND value * 1000 >= 10000
        THEN CAST(trunc(value * 1000) AS BIGINT) END AS price,
      CASE WHEN event_type IN ('view', 'click')
        THEN CAST('19' || json_extract_string(props, '$.k') AS INTEGER) END AS year_built
    FROM events""",
)

# --- search ------------------------------------------------------------------------

_MATCH = """state = 'AMERICA' AND price >= 50000 AND price <= 400000 AND beds >= 2 AND beds <= 6
    AND baths >= 1.5 AND size_sqft >= 300 AND size_sqft <= 2500"""
_add(
    "q_search",
    f"""SELECT property_id, price, size_sqft, beds, baths, city, state, zip_code, address, property_type,
      listing_url, image_count, price_per_sqft, days_on_market, analysis_date, first_seen_date, year_built,
      lot_size_sqft, hoa_fee, mls_number FROM listings WHERE {_MATCH}""",
    "listings",
)
_add(
    "q_search_page",
    f"""SELECT property_id, price, image_urls[1] AS image_url,
      property_id IN (SELECT property_id FROM preferences WHERE user_id = 8 AND preference_type = 'favorite')
        AS is_favorited
    FROM listings WHERE {_MATCH} ORDER BY price DESC, property_id LIMIT 50""",
    "listings",
    "preferences",
)
for _name, _column in {
    "price": "price",
    "price_per_sqft": "price_per_sqft",
    "sqft": "size_sqft",
    "beds": "beds",
    "days_on_market": "days_on_market",
}.items():
    for _direction in ("asc", "desc"):
        _add(
            f"q_sort_{_name}_{_direction}",
            f"""SELECT property_id, row_number() OVER (ORDER BY coalesce({_column}, 0) {_direction}, property_id) AS rank
            FROM listings QUALIFY rank <= 1000""",
            "listings",
        )
_add(
    "q_sort_date_asc",
    """SELECT property_id, row_number() OVER (ORDER BY analysis_date ASC NULLS FIRST, property_id) AS rank FROM listings
    QUALIFY rank <= 1000""",
    "listings",
)
_add(
    "q_sort_date_desc",
    """SELECT property_id, row_number() OVER (ORDER BY analysis_date DESC NULLS LAST, property_id) AS rank FROM listings
    QUALIFY rank <= 1000""",
    "listings",
)
_add(
    "q_top_k",
    """SELECT property_id, price_per_sqft FROM listings WHERE beds >= 3
    ORDER BY coalesce(price_per_sqft, 0), property_id LIMIT 25""",
    "listings",
)
_add("q_page_sort", """SELECT property_id, beds, row_number() OVER (ORDER BY coalesce(beds, 0) DESC, property_id) AS rank
    FROM (SELECT * FROM listings ORDER BY property_id LIMIT 100)""", "listings")
_add(
    "q_keyset_page",
    "SELECT property_id, price FROM listings WHERE property_id > 'PROP#300' ORDER BY property_id LIMIT 1000",
    "listings",
)
_add(
    "q_keyset_pages",
    """SELECT page_no, property_id, price, count(*) OVER w AS total_in_page,
      CASE WHEN count(*) OVER w >= 1000 THEN max(property_id) OVER w END AS next_cursor
    FROM (SELECT property_id, price, CAST((row_number() OVER (ORDER BY property_id) - 1) // 1000 AS BIGINT) AS page_no
      FROM listings) WINDOW w AS (PARTITION BY page_no)""",
    "listings",
)
_add(
    "q_known_second_token",
    """SELECT CAST(o_orderkey AS VARCHAR) AS raw_id,
      'PROP#' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey || '_' || o_custkey AS property_id,
      CAST(floor(o_totalprice) AS BIGINT) AS price, '' AS listing_url, CAST(o_orderdate AS DATE) AS analysis_date
    FROM orders""",
)
_add(
    "q_track_ward_urls",
    """SELECT url, FALSE AS processed, nullif(coalesce(city, 'unknown'), '') AS ward,
      CAST(coalesce(price, 0) AS BIGINT) AS price FROM observations""",
    "observations",
)
_add(
    "q_saveable",
    """SELECT CAST(o_orderkey AS VARCHAR) AS property_id FROM orders
    WHERE o_orderpriority <> '1-URGENT' AND o_totalprice >= 5000 AND o_orderstatus <> 'P'""",
)
_add(
    "q_is_favorited",
    """SELECT property_id, property_id IN (SELECT property_id FROM preferences WHERE user_id = 8
      AND preference_type = 'favorite') AS is_favorited FROM listings""",
    "listings",
    "preferences",
)
_add(
    "q_user_prefs",
    """SELECT property_id, preference_type, created_at,
      row_number() OVER (ORDER BY created_at DESC, property_id) AS rank FROM preferences
    WHERE user_id = 8 AND preference_type = 'hidden'""",
    "preferences",
)

# --- scalar functions --------------------------------------------------------------

_PRICE = """SELECT doc_id, CASE WHEN amount >= 10000 AND NOT regexp_matches(lower({c}),
    'contact|call|price upon request|auction|n/a') THEN amount END AS price FROM (
      SELECT *, CASE WHEN contains(num, '.') THEN TRY_CAST(trunc(TRY_CAST(num AS DOUBLE)) AS BIGINT)
        ELSE TRY_CAST(num AS BIGINT) END AS amount
      FROM (SELECT *, regexp_replace({c}, '[^0-9.]', '', 'g') AS num FROM texts))"""
_add("q_parse_price", _PRICE.format(c="price_text"), "texts")
_add("q_parse_price_whole_text", _PRICE.format(c="text"), "texts")
_add(
    "q_listing_id",
    r"""SELECT url, CASE WHEN regexp_matches(url, '/home/\d+') THEN regexp_extract(url, '/home/(\d+)', 1)
      WHEN len(parts) > 0 THEN left(array_to_string(parts[greatest(len(parts) - 2, 1):], '_'), 100) END AS raw_id
    FROM (SELECT url, list_filter(string_split(
        regexp_replace(regexp_replace(url, '^https?://[^/?#]*', ''), '[?#].*$', ''), '/'),
        lambda p: p <> '') AS parts
      FROM (SELECT url FROM pages UNION ALL SELECT listing_url FROM listings))""",
    "listings",
)
_add(
    "q_listing_id_chain",
    r"""SELECT url,
      coalesce(nullif(regexp_extract(url, '(?i)_M(\d+-\d+)$', 1), ''), nullif(regexp_extract(url, '(?i)_M(\d+)$', 1), ''),
        nullif(regexp_extract(url, '(?i)/realestateandhomes-detail/[^/]+_([A-Z0-9-]+)$', 1), ''),
        nullif(regexp_extract(url, '(?i)/([A-Z0-9]+-[0-9]+)/?$', 1), ''),
        nullif(regexp_extract(url, '(?i)property[_-]?id[=:]([A-Za-z0-9-]+)', 1), ''),
        left(nullif(replace(regexp_extract(url, '/realestateandhomes-detail/([^?]+)', 1), '/', '_'), ''), 100))
        AS portal_id,
      coalesce(nullif(regexp_extract(url, 'property[_-]?id[=:](\d+)', 1), ''),
        nullif(regexp_extract(url, '/(\d{10,})', 1), ''), nullif(regexp_extract(url, 'M(\d{10,})', 1), ''),
        nullif(regexp_extract(url, '/([A-Z0-9]{8,})', 1), '')) AS legacy_id
    FROM (SELECT url FROM pages UNION ALL SELECT CASE o_orderpriority
        WHEN '1-URGENT' THEN 'https://portal.example/realestateandhomes-detail/' || o_orderkey || '-Main-St_M' ||
          o_orderkey || '-77'
        WHEN '2-HIGH' THEN 'https://portal.example/realestateandhomes-detail/' || o_orderkey || '-Main-St_m' || o_orderkey
        WHEN '3-MEDIUM' THEN 'https://portal.example/realestateandhomes-detail/' || o_orderkey || '-Main/St?x=1'
        WHEN '5-LOW' THEN 'https://x.example/p?property_id=' || o_orderkey
        ELSE 'https://x.example/90000' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '/ABCDEFGH12' END
      FROM orders)""",
)
_add(
    "q_id_keys",
    """SELECT 'PROP#' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey || '_' || o_custkey AS dated_key,
      'PROP#' || o_orderkey AS plain_key, o_orderkey || '_' || o_custkey AS dated_raw,
      CAST(o_orderkey AS VARCHAR) AS plain_raw, CAST(o_orderkey AS VARCHAR) AS second_token
    FROM orders""",
)
_add(
    "q_text_fields",
    r"""SELECT doc_id, CASE WHEN yr BETWEEN 1800 AND 2002 THEN yr END AS year_built,
      acres AS lot_size_acres, coalesce(CAST(floor(acres * 43560) AS BIGINT), sqft) AS lot_size_sqft,
      hoa AS hoa_fee, dom AS days_on_market, mls AS mls_number
    FROM (SELECT doc_id, TRY_CAST(regexp_extract(t, '(?:built|year built)[\s:]*(\d{4})', 1) AS INTEGER) AS yr,
        CASE WHEN ac > 0 AND ac < 10000 THEN ac END AS acres,
        TRY_CAST(replace(regexp_extract(t, 'lot[\s:]*size[\s:]*[^\d]*([\d,]+)\s*(?:sq\s*ft|sqft)', 1), ',', '')
          AS BIGINT) AS sqft,
        TRY_CAST(replace(regexp_extract(t, 'hoa[\s:]*\$?([\d,]+)', 1), ',', '') AS BIGINT) AS hoa,
        TRY_CAST(regexp_extract(t, '(\d+)\s*days?\s*on\s*redfin', 1) AS INTEGER) AS dom,
        nullif(regexp_extract(text, 'MLS#?\s*[:\s]?(\d+)', 1), '') AS mls
      FROM (SELECT *, lower(text) AS t, TRY_CAST(replace(regexp_extract(lower(text) || ' ',
          '([\d,\.]+)\s*(?:acre|ac)(?:[^\p{L}\p{N}_])', 1), ',', '') AS DOUBLE) AS ac FROM texts))""",
    "texts",
)
_WORD = r"(^|[^\p{{L}}\p{{N}}_])({})($|[^\p{{L}}\p{{N}}_])"
_TYPES = (
    ("single family|single-family", "Single Family"),
    ("condo|condominium", "Condo"),
    ("townhouse|townhome", "Townhouse"),
    ("multi-?family|duplex|triplex", "Multi-Family"),
    ("land|lot|vacant", "Land"),
    ("mobile|manufactured", "Mobile"),
)
_add(
    "q_property_type",
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN regexp_matches(lower(text), '{_WORD.format(p)}') THEN '{n}'" for p, n in _TYPES)
    + " END AS property_type FROM texts",
    "texts",
)
_add(
    "q_to_decimal",
    """SELECT CAST(R4(l_extendedprice / 7) AS DECIMAL(38, 4)) AS value, count(*) AS n
    FROM lineitem GROUP BY 1""",
)
_add("q_price_per_sqft", "SELECT property_id, price_per_sqft FROM listings", "listings")
_PPA = """CASE WHEN price > 0 AND lot_size_acres > 0 THEN R2(price / lot_size_acres)
    WHEN price > 0 AND lot_size_sqft > 0 THEN R2(price / (lot_size_sqft / CAST(43560 AS DOUBLE))) END"""
_add("q_price_per_acre", f"SELECT property_id, {_PPA} AS price_per_acre FROM listings", "listings")
_ENRICHED = f"""(SELECT *,
      coalesce(CASE WHEN med > 0 AND psf > 0 THEN R2((psf - med) / med * 100) END, 0.0) AS pct
    FROM (SELECT l.*, coalesce(l.price_per_sqft, 0) AS psf, coalesce(c.med, l.price_per_sqft, 0) AS med,
        coalesce(c.n, 1) AS n, {_PPA} AS price_per_acre
      FROM listings l LEFT JOIN city_stats c ON trim(l.city) = c.city))"""
_add(
    "q_market_position",
    f"""SELECT property_id, CASE WHEN pct < -10 THEN 'below' WHEN pct > 10 THEN 'above' ELSE 'near' END AS bucket,
      CASE WHEN pct < -10 THEN format('{{:.1f}}', abs(pct)) || '% BELOW city median (good value)'
        WHEN pct > 10 THEN format('{{:.1f}}', pct) || '% ABOVE city median (premium priced)'
        ELSE 'Near city median (' || format('{{:+.1f}}', R1(pct)) || '%)' END AS market_position,
      '$' || format('{{:,}}', price) AS price_display
    FROM {_ENRICHED}""",
    "listings",
    "city_stats",
)
_add(
    "q_discount_class",
    f"""SELECT property_id, CASE WHEN pct < 0 THEN 'below' WHEN pct > 5 THEN 'above' ELSE 'neutral' END
      AS discount_class FROM {_ENRICHED}""",
    "listings",
    "city_stats",
)
_add(
    "q_verdict",
    """SELECT conv_id, turn, CASE WHEN contains(r, 'strong buy') THEN 'STRONG BUY'
      WHEN contains(r, 'pass') AND contains(r, 'verdict') THEN 'PASS'
      WHEN contains(r, 'buy') AND contains(r, 'verdict') THEN 'BUY' ELSE 'CONSIDER' END AS verdict
    FROM (SELECT *, lower(CASE WHEN role = 'system' THEN 'Verdict: PASS. ' WHEN turn = 0 THEN 'A Strong Buy. '
        WHEN turn = 1 THEN 'My verdict: buy it. ' ELSE 'Buy? ' END || text) AS r FROM conversations)""",
)
_add(
    "q_truncate",
    r"""SELECT doc_id, CASE WHEN strlen(text) * 2 > 20000 AND length(text) > 5000
        THEN left(text, 5000) || chr(10) || chr(10) || '... [truncated]' ELSE text END AS report,
      left(text, 500) AS error_text FROM documents""",
)
_add(
    "q_array_prefix",
    """SELECT property_id, image_urls[1] AS image_url, array_to_string(image_urls[:5], ' ') AS shown,
      array_to_string(image_urls[:10], ' ') AS stored, CAST(len(image_urls) AS INTEGER) AS image_count FROM listings""",
    "listings",
)

# --- records -----------------------------------------------------------------------

_add(
    "q_sparse_prune",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status,
      CASE WHEN o_orderstatus <> 'O' AND o_totalprice <> 0 THEN o_totalprice END AS amount,
      CASE WHEN o_orderpriority = '1-URGENT' THEN TRUE END AS urgent FROM orders""",
)
_add(
    "q_sparse_prune_keep",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status,
      CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END AS price,
      o_orderpriority = '1-URGENT' AS good_lighting FROM orders""",
)
_add(
    "q_record_defaults",
    """SELECT 'PROP#' || o_orderkey AS property_id, '/p/' || o_orderkey AS listing_url, p AS price,
      CASE WHEN o_orderpriority <= '2-HIGH' AND old > 0 AND old <> p THEN old END AS previous_price,
      CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'ward ' || o_orderpriority END AS ward,
      CASE WHEN o_orderpriority <> '5-LOW' THEN 'DIST#ward ' || o_orderpriority END AS district_key,
      CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(2 AS INTEGER) END AS floor,
      o_orderstatus AS zoning,
      CASE WHEN o_orderstatus = 'F' THEN 'south' ELSE '' END AS direction_facing,
      CASE o_orderstatus WHEN 'O' THEN 'east' WHEN 'F' THEN 'south' ELSE '' END AS orientation,
      CAST(0 AS DOUBLE) AS size_sqm, FALSE AS good_lighting, CAST(0 AS INTEGER) AS image_count
    FROM (SELECT *, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS p,
      CAST(round(o_totalprice / 2 - 500) AS BIGINT) AS old FROM orders)""",
)
_add(
    "q_field_precedence",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN o_totalprice * 2
        ELSE o_totalprice * 3 END AS price,
      CASE o_orderstatus WHEN 'P' THEN 'ld name' ELSE o_orderpriority END AS name
    FROM orders""",
)
_add(
    "q_save_listings",
    """SELECT coalesce(n.property_id, k.property_id) AS property_id,
      coalesce(n.listing_url, k.listing_url) AS listing_url,
      CASE WHEN n.property_id IS NOT NULL THEN n.price ELSE k.price END AS price,
      CASE WHEN n.property_id IS NOT NULL THEN n.city ELSE k.city END AS city,
      CAST(NULL AS VARCHAR) AS parking,
      CASE WHEN n.property_id IS NOT NULL THEN 'active' END AS listing_status,
      CASE WHEN n.property_id IS NULL THEN k.first_seen_date
        ELSE least(coalesce(k.first_seen_date, TIMESTAMP '2002-01-01'), TIMESTAMP '2002-01-01') END AS first_seen_date,
      CASE WHEN n.property_id IS NOT NULL THEN DATE '2002-01-01' ELSE k.analysis_date END AS analysis_date,
      CASE WHEN n.property_id IS NULL THEN k.beds END AS beds
    FROM known k FULL JOIN (
      SELECT 'PROP#' || regexp_extract(url, '/home/([0-9]+)', 1) AS property_id, url AS listing_url, price, city
      FROM observations WHERE price >= 10000) n ON k.property_id = n.property_id""",
    "known",
    "observations",
)
_add(
    "q_city_fallback",
    """SELECT l.property_id, l.listing_url,
      CASE WHEN l.property_type = '2-HIGH' THEN t.city ELSE l.city END AS city
    FROM listings l LEFT JOIN tracked t ON l.listing_url = t.url""",
    "listings",
    "tracked",
)
_add(
    "q_process_summary",
    """SELECT count(*) AS processed, count(*) FILTER (o_totalprice >= 5000 AND o_orderpriority <> '5-LOW') AS success,
      count(*) FILTER (o_totalprice < 5000 OR o_orderpriority = '5-LOW') AS failed,
      count(*) FILTER (o_totalprice >= 5000 AND o_orderpriority = '5-LOW') AS blocked FROM orders""",
)
_add(
    "q_process_errors",
    """SELECT CAST(o_orderkey AS VARCHAR) AS url,
      CASE WHEN o_totalprice < 5000 THEN '500 Server Error' ELSE '403 Forbidden' END AS error
    FROM orders WHERE o_totalprice < 5000 OR o_orderpriority = '5-LOW'""",
)
_add(
    "q_id_reuse",
    """SELECT CAST(o_orderkey AS VARCHAR) AS raw_id,
      'PROP#' || CASE WHEN o_orderstatus <> 'F' THEN '20020101'
        WHEN o_orderpriority = '1-URGENT' THEN least(strftime(o_orderdate, '%Y%m%d'), '19990909')
        ELSE strftime(o_orderdate, '%Y%m%d') END || '_' || o_orderkey AS property_id,
      o_orderstatus = 'F' AS reused FROM orders""",
)

# --- collecting --------------------------------------------------------------------

_FIRST = """(SELECT crawl_id, url, page_no, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY crawl_id, url ORDER BY page_no, pos) AS rn FROM crawl_obs) WHERE rn = 1)"""
_add("q_first_seen", f"SELECT * FROM {_FIRST}", "crawl_obs")
_add(
    "q_crawl_cutoff",
    f"""SELECT f.* FROM {_FIRST} f LEFT JOIN (
      SELECT crawl_id, min(page_no) AS stop FROM crawl_pages p
      WHERE (error IS NULL OR error <> 'Read timeout')
        AND NOT EXISTS (SELECT 1 FROM {_FIRST} g WHERE g.crawl_id = p.crawl_id AND g.page_no = p.page_no)
      GROUP BY crawl_id) s ON f.crawl_id = s.crawl_id
    WHERE stop IS NULL OR f.page_no < stop""",
    "crawl_obs",
)
_CLASSIFIED = """(SELECT o.url, o.price, k.price AS old_price, k.property_id AS known_id,
      CASE WHEN t.url IS NULL THEN 'new'
        WHEN o.price > 0 AND k.price > 0 AND o.price <> k.price THEN 'price_changed' ELSE 'unchanged' END AS status
    FROM observations o LEFT JOIN tracked t ON o.url = t.url LEFT JOIN known k ON o.url = k.listing_url)"""
_VIEWS = ("observations", "tracked", "known")
_add("q_classify", f"SELECT url, price, old_price, status FROM {_CLASSIFIED}", *_VIEWS)
_add("q_new_urls", "SELECT url, price, city FROM observations WHERE url NOT IN (SELECT url FROM tracked)", *_VIEWS)
_add(
    "q_split_by_known_id",
    "SELECT url, url NOT IN (SELECT listing_url FROM known) AS is_new FROM observations",
    *_VIEWS,
)
_add(
    "q_price_changes",
    f"""SELECT known_id AS property_id, url, old_price, price AS new_price FROM {_CLASSIFIED}
    WHERE status = 'price_changed'""",
    *_VIEWS,
)
_add(
    "q_collect_summary",
    f"""SELECT count(*) AS total_urls_found, count(*) FILTER (status = 'new') AS new_urls_tracked,
      count(*) FILTER (status = 'unchanged') AS existing_listings,
      count(*) FILTER (status = 'price_changed') AS price_changed_listings FROM {_CLASSIFIED}""",
    *_VIEWS,
)
_add("q_url_except", "SELECT url FROM observations EXCEPT SELECT url FROM tracked", *_VIEWS)
_add("q_url_intersect", "SELECT url FROM observations INTERSECT SELECT url FROM tracked", *_VIEWS)
_add(
    "q_duplicates",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'yes' ELSE 'no' END AS duplicate
    FROM lineitem""",
)
_add(
    "q_uniqueness",
    """SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS unique_keys, count(*) FILTER (n > 1) AS repeated_keys
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
_add(
    "q_zero_price",
    """SELECT count(*) AS total, count(*) FILTER (price = 0) AS zero_price,
      R1(count(*) FILTER (price = 0) / count(*) * 100) AS zero_price_pct,
      count(*) BETWEEN 40 AND 120 AS count_in_range FROM price_obs""",
    "price_obs",
)

# --- statistics --------------------------------------------------------------------

_add(
    "q_city_stats",
    "SELECT city, med AS median_price_per_sqft, n AS property_count FROM city_stats",
    "city_stats",
)
_add(
    "q_enrich",
    f"""SELECT property_id, sort_key, listing_url, price, size_sqft, price_per_sqft, beds, baths, lot_size_acres,
      lot_size_sqft, city, state, zip_code, address, property_type, year_built, hoa_fee, mls_number, days_on_market,
      image_count, first_seen_date, price_per_acre, med AS city_median_price_per_sqft, pct AS city_discount_pct,
      n AS city_property_count, DATE '2002-01-01' AS analysis_date FROM {_ENRICHED}""",
    "listings",
    "city_stats",
)
_add(
    "q_analyze_limit",
    """, first AS (SELECT * FROM listings ORDER BY property_id LIMIT 500),
    st AS (SELECT trim(city) AS city, median(price_per_sqft) AS med, count(*) AS n FROM first
      WHERE price_per_sqft > 0 GROUP BY trim(city))
    SELECT property_id, coalesce(med, price_per_sqft, 0) AS city_median_price_per_sqft,
      coalesce(n, 1) AS city_property_count FROM first LEFT JOIN st ON trim(first.city) = st.city""",
    "listings",
)
_add(
    "q_analysis_summary",
    """SELECT (SELECT count(*) FROM listings) AS properties_analyzed, CAST(0 AS BIGINT) AS errors,
      (SELECT count(*) FROM city_stats) AS cities_analyzed""",
    "listings",
    "city_stats",
)
_WARDS = """(SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS property_id,
      CASE WHEN l_returnflag = 'R' THEN 'unknown' ELSE 'W' || l_suppkey || l_returnflag END AS ward,
      l_extendedprice / l_quantity AS price_per_sqm,
      CASE WHEN l_linestatus = 'F' THEN l_quantity END AS size_sqm, CAST(l_shipdate AS DATE) AS analysis_date
    FROM lineitem)"""
_add(
    "q_upper_median",
    f"""SELECT ward, max(price_per_sqm) FILTER (rn = n // 2 + 1) AS ward_avg_price_per_sqm, max(n) AS ward_property_count
    FROM (SELECT *, row_number() OVER (PARTITION BY ward ORDER BY price_per_sqm) AS rn,
      count(*) OVER (PARTITION BY ward) AS n FROM {_WARDS} WHERE ward <> 'unknown' AND price_per_sqm <> 0)
    GROUP BY ward HAVING max(n) >= 3""",
)
_add(
    "q_comparables",
    f"""SELECT ward, property_id, analysis_date, size_sqm FROM (
      SELECT *, row_number() OVER (PARTITION BY ward ORDER BY analysis_date DESC, property_id) AS rn FROM {_WARDS})
    WHERE rn <= 200 AND size_sqm <> 0 AND price_per_sqm <> 0""",
)

# --- price tracking ----------------------------------------------------------------

_PCT = "R2((price - {o}) / CAST({o} AS DOUBLE) * 100)"
_add(
    "q_price_tracking",
    f"""SELECT property_id, price, original_price, previous_price, price - previous_price AS last_price_change,
      {_PCT.format(o="previous_price")} AS last_price_change_pct,
      price - original_price AS total_price_change, {_PCT.format(o="original_price")} AS total_price_change_pct,
      change_no AS price_update_count, ts AS last_price_update
    FROM changes QUALIFY change_no = max(change_no) OVER (PARTITION BY property_id)""",
    "changes",
)
_add(
    "q_price_history_rows",
    f"""SELECT property_id, change_no, ts, price, previous_price, price - previous_price AS price_change_amount,
      {_PCT.format(o="previous_price")} AS price_drop_pct, 'price_updated' AS listing_status,
      ts + INTERVAL 365 DAYS AS expires_at FROM changes""",
    "changes",
)
_add(
    "q_price_history",
    """SELECT property_id, (change_no - 1) // 1000 AS chunk_no,
      string_agg(strftime(ts, '%Y-%m-%d') || ':' || price, '|' ORDER BY change_no) AS history
    FROM changes GROUP BY 1, 2""",
    "changes",
)
_add(
    "q_history_expiry",
    """SELECT property_id, change_no, ts + INTERVAL 365 DAYS AS expires_at FROM changes
    WHERE ts + INTERVAL 365 DAYS > TIMESTAMP '2002-01-01'""",
    "changes",
)
_add(
    "q_apply_price_changes",
    f"""SELECT k.property_id, coalesce(c.price, k.price) AS price, old_price AS original_price,
      old_price AS previous_price, c.price - old_price AS last_price_change,
      R2((c.price - old_price) / CAST(old_price AS DOUBLE) * 100) AS last_price_change_pct,
      c.price - old_price AS total_price_change,
      R2((c.price - old_price) / CAST(old_price AS DOUBLE) * 100) AS total_price_change_pct,
      CASE WHEN c.url IS NOT NULL THEN CAST(1 AS BIGINT) END AS price_update_count,
      CASE WHEN c.url IS NOT NULL THEN TIMESTAMP '2002-01-01' END AS last_price_update
    FROM known k LEFT JOIN (SELECT * FROM {_CLASSIFIED} WHERE status = 'price_changed') c
      ON k.listing_url = c.url""",
    *_VIEWS,
)
_add(
    "q_latest_per_key",
    """SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
)

# --- preferences and analyses ------------------------------------------------------

_add("q_pref_state", "SELECT * FROM preferences", "preferences")
_STATUS = """(SELECT user_id, property_id, arg_max(status, seq) AS analysis_status, max(ts) AS status_at,
      max(ts) FILTER (status = 'completed') AS analysis_completed_at,
      count(*) FILTER (status = 'failed') AS retry_count,
      arg_max(error, seq) FILTER (status = 'failed') AS last_error
    FROM status_events GROUP BY user_id, property_id)"""
_add("q_status_replay", f"SELECT * FROM {_STATUS}", "status_events")
_add(
    "q_pref_summary",
    """SELECT p.user_id, p.property_id, p.preference_type,
      CASE WHEN p.preference_type = 'favorite' THEN 'pending' END AS analysis_status,
      coalesce(l.price, 0) AS price, coalesce(l.city, '') AS city, coalesce(l.state, '') AS state,
      CAST(coalesce(l.beds, 0) AS INTEGER) AS beds, coalesce(l.baths, 0) AS baths, l.image_urls[1] AS image_url,
      coalesce(l.listing_url, '') AS listing_url
    FROM preferences p LEFT JOIN listings l ON p.property_id = l.property_id""",
    "preferences",
    "listings",
)
_add(
    "q_analysis_view",
    f"""SELECT k.user_id, k.property_id, p.user_id IS NOT NULL AS found,
      CASE WHEN p.user_id IS NOT NULL THEN coalesce(s.analysis_status, 'pending') END AS analysis_status,
      CASE WHEN p.user_id IS NOT NULL THEN coalesce(array_to_string(l.image_urls[:5], ' '), '') END AS images,
      CASE WHEN p.user_id IS NOT NULL AND s.analysis_completed_at IS NOT NULL THEN 'BUY' END AS verdict
    FROM (SELECT user_id, property_id FROM status_events UNION SELECT user_id, property_id FROM pref_events) k
      LEFT JOIN {_STATUS} s ON s.user_id = k.user_id AND s.property_id = k.property_id
      LEFT JOIN preferences p ON k.user_id = p.user_id AND k.property_id = p.property_id
      LEFT JOIN listings l ON k.property_id = l.property_id""",
    "status_events",
    "preferences",
    "listings",
)
_REQUESTS = """(SELECT event_id AS request_id, user_id, ts,
      CASE WHEN event_type = 'view' THEN ['PROP#' || json_extract_string(props, '$.k')]
        ELSE ['PROP#' || json_extract_string(props, '$.k'), CASE event_type WHEN 'purchase' THEN 'PROP#sold' ELSE 'PROP#' || user_id END] END AS property_ids FROM events)"""
_ITEMS = f"""(SELECT r.request_id, r.user_id, r.pos, r.property_id,
      CASE WHEN r.n < 2 THEN 'fewer than two listings' WHEN l.property_id IS NULL THEN 'listing missing'
        WHEN p.user_id IS NULL OR s.analysis_completed_at IS NULL THEN 'analysis missing' END AS problem
    FROM (SELECT request_id, user_id, unnest(property_ids) AS property_id, len(property_ids) AS n,
        unnest(range(len(property_ids))) AS pos FROM {_REQUESTS}) r
      LEFT JOIN listings l ON r.property_id = l.property_id
      LEFT JOIN preferences p ON r.user_id = p.user_id AND r.property_id = p.property_id
      LEFT JOIN {_STATUS} s ON r.user_id = s.user_id AND r.property_id = s.property_id)"""
_add(
    "q_compare_valid",
    f"""SELECT request_id, count(*) AS property_count, count(problem) = 0 AS valid,
      arg_min(property_id, pos) FILTER (problem IS NOT NULL) AS first_missing_id,
      arg_min(problem, pos) FILTER (problem IS NOT NULL) AS first_problem
    FROM {_ITEMS} GROUP BY request_id""",
    "listings",
    "preferences",
    "status_events",
)
_add(
    "q_comparison_record",
    f"""SELECT user_id, 'COMPARISON_' || strftime(ts, '%Y-%m-%d_%H-%M-%S') AS property_id,
      'processing' AS analysis_status, CAST(len(property_ids) AS INTEGER) AS property_count,
      array_to_string(property_ids, ' ') AS compared
    FROM {_REQUESTS} WHERE len(property_ids) >= 2
    QUALIFY row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') ORDER BY ts DESC) = 1""",
)

_WHOLE = "'{n}: ' || {c}"
_HUNDREDTHS = "'{n}: ' || format('{{:.2f}}', {c})"


def _facts(names: str) -> str:
    """SQL for lines of known facts; ``*`` marks what is shown with two decimals."""
    own = {"city_median_price_per_sqft": "med", "city_discount_pct": "pct"}
    lines = []
    for name in names.split():
        n = name.rstrip("*")
        lines.append((_HUNDREDTHS if name != n else _WHOLE).format(n=n, c="e." + own.get(n, n)))
    return "concat_ws(chr(10), " + ", ".join(lines) + ")"


_add(
    "q_prompt_text",
    f"""SELECT property_id, 'Is this listing worth its price? Give a verdict, the reasons for it and what to check.'
      || chr(10) || chr(10) || {_facts("""property_id property_type year_built beds baths* size_sqft lot_size_sqft
        lot_size_acres* price price_per_sqft* hoa_fee city_median_price_per_sqft* city_discount_pct* days_on_market
        address zip_code city state mls_number listing_url""")} AS prompt
    FROM {_ENRICHED} e""",
    "listings",
    "city_stats",
)
_add(
    "q_compare_prompt",
    f"""SELECT i.request_id, i.user_id, CAST(count(*) AS INTEGER) AS property_count,
      'Which of these listings is the best choice, and what speaks for the others?' || chr(10) || chr(10) ||
      string_agg(concat_ws(chr(10), 'option: ' || (pos + 1), {_facts("""property_id year_built beds baths* size_sqft
        price price_per_sqft* city_discount_pct* days_on_market city state""")},
        'analysis: Verdict: buy ' || i.property_id), chr(10) || chr(10) ORDER BY pos) AS prompt
    FROM {_ITEMS} i JOIN {_ENRICHED} e ON i.property_id = e.property_id
    GROUP BY i.request_id, i.user_id HAVING count(problem) = 0
      AND count(*) = (SELECT count(*) FROM {_ITEMS} j WHERE j.request_id = i.request_id)""",
    "listings",
    "city_stats",
    "preferences",
    "status_events",
)

# --- table changes -----------------------------------------------------------------

_STORED = "(SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT')"
_CHANGED = "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"
_add(
    "q_upsert_replace",
    f"""SELECT * FROM {_STORED} WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'X', NULL FROM {_CHANGED}""",
)
_add(
    "q_upsert_partial",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice
    FROM {_STORED}
    UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""",
)
_add(
    "q_update_existing",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice
    FROM {_STORED}""",
)
_add(
    "q_insert_if_absent",
    f"""SELECT * FROM {_STORED}
    UNION ALL SELECT o_orderkey, 'X', NULL FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""",
)
_add("q_delete_keys", f"SELECT * FROM {_STORED} WHERE o_orderstatus <> 'P'")
_add(
    "q_unmatched_keys",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'",
)
_add(
    "q_mark_processed",
    """SELECT coalesce(t.url, d.url) AS url, t.city, t.price,
      CASE WHEN d.url IS NOT NULL THEN TRUE ELSE t.processed END AS processed
    FROM tracked t FULL JOIN (SELECT DISTINCT url FROM observations WHERE city <> '' AND price > 250000) d
      ON t.url = d.url""",
    "tracked",
    "observations",
)

# --- streams -----------------------------------------------------------------------

ORACLES["q_summary_sink"] = ORACLES["q_process_summary"]
ORACLES["q_stream_url_dedup"] = "SELECT DISTINCT '/home/' || l_partkey AS url FROM lineitem"
ORACLES["q_stream_first_seen"] = (
    "SELECT '/home/' || l_partkey AS url, min(l_shipdate) AS ts FROM lineitem GROUP BY l_partkey"
)
ORACLES["q_stream_status"] = ORACLES["q_status_replay"]
ORACLES["q_stream_status_keyed"] = ORACLES["q_status_replay"]
ORACLES["q_stream_price_tracking"] = ORACLES["q_price_tracking"]
ORACLES["q_stream_price_keyed"] = ORACLES["q_price_tracking"]
ORACLES["q_stream_expiry"] = ORACLES["q_history_expiry"]
ORACLES["q_stream_pref_state"] = ORACLES["q_pref_state"]
ORACLES["q_stream_pref_late"] = ORACLES["q_pref_state"]
_add(
    "q_stream_enrich",
    f"""SELECT property_id, city, med AS city_median_price_per_sqft, pct AS city_discount_pct,
      n AS city_property_count, price_per_acre FROM {_ENRICHED}""",
    "listings",
    "city_stats",
)
_add(
    "q_stream_crawl",
    """SELECT count(*) AS total_urls_found, count(*) FILTER (fresh) AS new_urls_tracked,
      count(*) FILTER (NOT fresh AND NOT changed) AS existing_listings,
      count(*) FILTER (NOT fresh AND changed) AS price_changed_listings
    FROM (SELECT o_orderdate >= TIMESTAMP '1998-01-01' AS fresh,
        o_orderstatus <> 'F' AND o_totalprice >= 1 AND o_orderpriority <> '3-MEDIUM' AS changed FROM orders)""",
)
