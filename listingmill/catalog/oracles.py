"""SQL twins of the registered queries, written for DuckDB from the rules
themselves.  Each text is a chain of CTEs over the given tables; the derived
tables start from the same texts as the Spark side."""

from __future__ import annotations

import re

from listingmill import vocab
from listingmill.catalog import fixtures as fx

TODAY = "DATE '2025-06-01'"


def q(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def as_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def any_in(text: str, words) -> str:
    return "coalesce(" + " OR ".join(f"contains({text}, {q(w)})" for w in words) + ", false)"


def any_word(text: str, words) -> str:
    inner = "|".join(re.escape(w) for w in words)
    return f"coalesce(regexp_matches({text}, '(?:^|[^\\p{{L}}\\p{{N}}_])(?:{inner})(?:$|[^\\p{{L}}\\p{{N}}_])'), false)"


def floor_case(has) -> str:
    levels = "|".join(vocab.LEVEL_WORDS)
    return f"""coalesce(
      CASE WHEN {has("g", vocab.FLOOR_BASEMENT)} THEN -1 WHEN {has("g", vocab.FLOOR_GROUND)} THEN 0
        ELSE TRY_CAST(nullif(regexp_extract(g, '-?[0-9]+'), '') AS INTEGER) END,
      CASE WHEN {has("t", vocab.TITLE_HOUSE)} THEN 0 END,
      CASE WHEN {has("d", vocab.DESC_GROUND)} THEN 0 WHEN {has("d", vocab.DESC_BASEMENT)} THEN -1
        WHEN {has("d", ("studio",))} THEN 1
        ELSE TRY_CAST(nullif(regexp_extract(d, '(?:^|[^\\p{{L}}\\p{{N}}_])([0-9]{{1,2}})\\.[\\s\\p{{Z}}]*(?:{levels})', 1), '') AS INTEGER) END,
      CASE WHEN {has("t", vocab.TITLE_SHOP)} THEN 0 END)"""


CTES: dict[str, str] = {name: sql for name, (sql, _) in fx.DERIVED.items()}

CTES["postal"] = """
SELECT ord, TRY_CAST(plz AS INTEGER) AS zip_code, ort AS city, upper(trim(kt)) AS region, lower(trim(ort)) AS city_clean
FROM postal_ref"""

CTES["typed"] = """
SELECT * REPLACE (TRY_CAST(replace(rooms, ' ½', '.5') AS DOUBLE) AS rooms,
  TRY_CAST(nullif(regexp_extract(area_sqm, '[0-9]{2,5}'), '') AS INTEGER) AS area_sqm,
  TRY_CAST(price AS BIGINT) AS price) FROM raw_listings"""

_AVAILABLE = f"""CASE WHEN availability_date IN {in_list(vocab.AVAILABLE_NOW)} THEN {TODAY}
    WHEN availability_date IN {in_list(vocab.AVAILABLE_ON_AGREEMENT)} THEN {TODAY} + 30
    ELSE coalesce(try_strptime(availability_date, '%Y-%m-%d')::DATE, try_strptime(availability_date, '%d.%m.%Y')::DATE) END"""

_TEXTS = "SELECT *, lower(trim(floor)) AS g, lower(title) AS t, lower(description) AS d FROM"

CTES["ziptext"] = f"""
SELECT * EXCLUDE (c1) REPLACE (
  TRY_CAST(coalesce(zip_code, nullif(regexp_extract(description, '(?:^|[^\\p{{L}}\\p{{N}}_])([0-9]{{4}})(?:$|[^\\p{{L}}\\p{{N}}_])', 1), '')) AS INTEGER) AS zip_code,
  coalesce(city, nullif(trim(regexp_replace(c1, '(?i)[\\s\\p{{Z}}]+(?:{"|".join(vocab.CITY_TRAILING_VERBS)})(?:[^\\p{{L}}\\p{{N}}_\\n][^\\n]*|(\\n)|$)', '\\1', 'g'), ' ' || chr(10) || chr(9)), '')) AS city)
FROM (SELECT *, trim(regexp_extract(description,
  'in[\\s\\p{{Z}}]+((?:[A-ZÄÖÜ][\\p{{L}}\\p{{N}}_.-]+(?:[\\s\\p{{Z}}]+|$)){{1,3}})', 1), ' ' || chr(10) || chr(9)) AS c1 FROM typed)"""

CTES["places"] = """
SELECT src_id, arg_max(p.city, struct_pack(a := length(p.city), b := p.city)) AS place
FROM (SELECT src_id, lower(description) AS d FROM ziptext WHERE city IS NULL AND description IS NOT NULL) z
JOIN (SELECT DISTINCT city FROM postal) p ON contains(z.d, lower(p.city)) GROUP BY src_id"""

CTES["citied"] = """
SELECT z.* REPLACE (coalesce(z.city, place) AS city) FROM ziptext z LEFT JOIN places USING (src_id)"""

CTES["zipped"] = """
SELECT * REPLACE (CASE WHEN zip_code IN (SELECT zip_code FROM postal WHERE zip_code IS NOT NULL) THEN zip_code END AS zip_code)
FROM citied"""

CTES["regioned"] = """
SELECT * REPLACE (CASE WHEN length(trim(region)) <= 2 THEN upper(trim(region)) END AS region) FROM zipped"""

CTES["by_city"] = """
SELECT city_clean, arg_min(zip_code, ord) FILTER (zip_code IS NOT NULL) AS zip_code,
  arg_min(region, ord) FILTER (region IS NOT NULL) AS region FROM postal GROUP BY city_clean"""

CTES["by_zip"] = """
SELECT zip_code, arg_min(city_clean, ord) AS city_clean, arg_min(region, ord) FILTER (region IS NOT NULL) AS region
FROM postal WHERE zip_code IS NOT NULL GROUP BY zip_code"""

CTES["backfilled"] = """
SELECT a.* REPLACE (
  coalesce(a.city, array_to_string(list_transform(regexp_extract_all(z.city_clean, '\\p{L}+|[^\\p{L}]+'),
    lambda x: upper(x[1]) || lower(x[2:])), '')) AS city,
  coalesce(a.region, z.region) AS region)
FROM (SELECT l.* REPLACE (coalesce(l.zip_code, c.zip_code) AS zip_code, coalesce(l.region, c.region) AS region)
      FROM regioned l LEFT JOIN by_city c ON lower(trim(l.city)) = c.city_clean) a
LEFT JOIN by_zip z ON a.zip_code = z.zip_code"""

_AREA = f"""coalesce(area_sqm, TRY_CAST(nullif(regexp_extract(lower(description),
  '([0-9]{{2,4}})[\\s\\p{{Z}}]*(?:{"|".join(vocab.AREA_UNITS)})', 1), '') AS INTEGER))"""

CTES["located"] = f"SELECT * REPLACE ({_AREA} AS area_sqm) FROM backfilled"

CTES["area_sums"] = """
SELECT region, area_sqm, sum(price) AS s, count(*) AS n FROM located
WHERE price IS NOT NULL AND region IS NOT NULL AND area_sqm IS NOT NULL GROUP BY ALL"""

CTES["priced"] = """
SELECT l.* REPLACE (coalesce(l.price, CAST(trunc(e.m) AS BIGINT)) AS price)
FROM located l LEFT JOIN (
  SELECT src_id, CAST(sum(s) AS DOUBLE) / sum(n) AS m FROM located g JOIN area_sums a
    ON g.region = a.region AND a.area_sqm BETWEEN g.area_sqm - 10 AND g.area_sqm + 10
  WHERE g.price IS NULL GROUP BY src_id) e USING (src_id)"""

_SINGLE = f"""CASE WHEN {any_in("lower(title)", vocab.SINGLE_ROOM_TITLE)}
  OR {any_in("lower(description)", ("studio",))} THEN 1.0 END"""

_RENTAL = f"""CASE WHEN {any_in("x", vocab.RENTAL_WORDS)} THEN true WHEN {any_in("x", vocab.SALE_WORDS)} THEN false
  ELSE price < {vocab.RENTAL_PRICE_LIMIT} END"""

CTES["complete"] = f"""
SELECT * EXCLUDE (g, t, d) REPLACE (f AS floor, v AS availability_date, ro AS rooms)
FROM (SELECT *, {floor_case(any_in)} AS f, {_AVAILABLE} AS v, coalesce(rooms, {_SINGLE}) AS ro FROM ({_TEXTS} priced))
WHERE price IS NOT NULL AND address IS NOT NULL AND ro IS NOT NULL AND f IS NOT NULL AND area_sqm IS NOT NULL
  AND v IS NOT NULL AND description IS NOT NULL"""

CTES["clean_listings"] = f"""
SELECT src_id, coalesce(title, CASE WHEN r THEN 'Rental' ELSE 'Property' END) AS title, address, zip_code, city, region,
  price, rooms, floor, area_sqm, availability_date, has_balcony, description, image_urls, r AS is_rental, latitude, longitude
FROM (SELECT *, {_RENTAL} AS r FROM (SELECT *, lower(concat_ws(' ', title, description)) AS x FROM complete))"""

_AMENITIES = ", ".join(
    f"coalesce(list_has_any(string_split_regex(lower(description), '[\\s\\p{{Z}}]+'), {as_list(words)}), false) AS {flag}"
    for flag, words in vocab.AMENITIES.items())

CTES["properties"] = f"""
SELECT row_number() OVER (ORDER BY src_id) AS id, title, address, zip_code, city, region, price, nullif(rooms, 0) AS rooms,
  nullif(CAST(area_sqm AS DOUBLE), 0) AS area_sqm, floor, availability_date, has_balcony, description, is_rental,
  {_AMENITIES}, image_urls, latitude, longitude, src_id
FROM clean_listings"""

CTES["images"] = """
SELECT row_number() OVER (ORDER BY property_id, pos) AS id, property_id, url
FROM (SELECT id AS property_id, unnest(image_urls) AS url, generate_subscripts(image_urls, 1) AS pos FROM properties)"""

CTES["files"] = """
SELECT regexp_extract(name, '^([^-]*)-', 1) AS pid, regexp_extract(name, '^[^-]*-(.*)\\.[jJ][pP][gG]$', 1) AS imgid, name
FROM image_files WHERE lower(name) LIKE '%.jpg' AND contains(name, '-')"""

_NOISE = "|".join(vocab.ADDRESS_NOISE)


def _street(column: str) -> str:
    # RE2 has no look-around: noise words are found between kept separators,
    # twice, because neighbours share a separator.
    def once(text: str) -> str:
        return f"regexp_replace({text}, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(?:{_NOISE})($|[^\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g')"

    return f"trim({once(once(column))})"


_TAIL = "', ' || coalesce(CAST(zip_code AS VARCHAR), 'None') || ' ' || coalesce(city, 'None') || ', Switzerland'"

CTES["addressed"] = f"SELECT *, {_street('address')} || {_TAIL} AS full_address FROM properties"

CTES["gaz"] = """
SELECT full_address, arg_min(latitude, rk) AS lat, arg_min(longitude, rk) AS lon
FROM (SELECT *, CASE src WHEN 'primary' THEN 1 ELSE 2 END AS rk FROM gazetteers) GROUP BY full_address"""

CTES["boxes"] = """
SELECT ord AS place_id, trim(ort) AS city, upper(trim(kt)) AS region, lat - 0.05e0 AS south, lat + 0.05e0 AS north,
  lon - 0.05e0 AS west, lon + 0.05e0 AS east FROM postal_ref"""

CTES["wide_boxes"] = """
SELECT *, south - (north - south) * 0.05e0 AS s, north + (north - south) * 0.05e0 AS n,
  west - (east - west) * 0.05e0 AS w, east + (east - west) * 0.05e0 AS e FROM boxes"""

CTES["eda"] = """
SELECT *, CAST(price AS DOUBLE) / nullif(CAST(area_sqm AS DOUBLE), 0) AS price_per_sqm FROM clean_listings
WHERE price BETWEEN 500 AND 10000"""

CTES["eda_long"] = """
SELECT 'price' AS metric, 30 AS bins, CAST(price AS DOUBLE) AS value FROM eda
UNION ALL SELECT 'area_sqm', 30, CAST(area_sqm AS DOUBLE) FROM eda
UNION ALL SELECT 'rooms', 20, rooms FROM eda
UNION ALL SELECT 'price_per_sqm', 40, price_per_sqm FROM eda WHERE price_per_sqm IS NOT NULL"""

CTES["doc_terms"] = f"""
SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents)
WHERE term NOT IN {in_list(vocab.STOP_WORDS)} GROUP BY ALL"""

CTES["weights"] = """
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
  SELECT doc_id, term, tf * (ln((1e0 + (SELECT count(*) FROM documents)) / (1e0 + df)) + 1e0) AS w
  FROM doc_terms JOIN (SELECT term, sum(tf) AS total, count(*) AS df FROM doc_terms GROUP BY term
                       ORDER BY total DESC, term LIMIT 1000) USING (term))"""

CTES["top_terms"] = """
SELECT cluster, CAST(rk AS BIGINT) AS rank, term FROM (
  SELECT cluster, term, row_number() OVER (PARTITION BY cluster ORDER BY round(sum(weight) / any_value(docs), 9) DESC, term) AS rk
  FROM weights JOIN (SELECT doc_id, lang AS cluster, count(*) OVER (PARTITION BY lang) AS docs FROM documents) USING (doc_id)
  GROUP BY cluster, term) WHERE rk <= 10"""

CTES["lone"] = """
SELECT 'missing' AS side, pid, imgid FROM (
  SELECT CAST(property_id AS VARCHAR) AS pid, CAST(id AS VARCHAR) AS imgid FROM images EXCEPT SELECT pid, imgid FROM files)
UNION ALL
SELECT 'extra', pid, imgid FROM (
  SELECT pid, imgid FROM files EXCEPT SELECT CAST(property_id AS VARCHAR), CAST(id AS VARCHAR) FROM images)"""

CTES["copies"] = """
SELECT * FROM clean_listings UNION ALL BY NAME
SELECT * REPLACE (src_id + 1000000000 AS src_id, CASE WHEN src_id % 2 = 0 THEN upper(title) ELSE title END AS title,
  CASE WHEN src_id % 2 = 0 THEN replace(description, ',', ' ; ') ELSE description END AS description) FROM clean_listings"""

CTES["word_sets"] = """
SELECT src_id, list_sort(list_distinct(regexp_extract_all(lower(coalesce(description, '')), '[\\p{L}\\p{N}_]{2,}'))) AS words FROM copies"""

#: All pairs of different word sets, and what can be reached from each.
CTES["alike"] = """
SELECT src_id, class_id FROM word_sets JOIN (
  WITH RECURSIVE sets AS MATERIALIZED (SELECT words, min(src_id) AS rep FROM word_sets GROUP BY words),
  pairs AS MATERIALIZED (
    SELECT a.rep AS a, b.rep AS b, len(list_intersect(a.words, b.words)) AS shared, len(a.words) + len(b.words) AS words_in_all
    FROM sets a JOIN sets b ON a.rep <> b.rep AND len(a.words) > 0 AND len(b.words) > 0),
  links AS MATERIALIZED (SELECT a, b FROM pairs WHERE shared / (words_in_all - shared) >= 0.8),
  reach AS (SELECT rep, rep AS other FROM sets UNION SELECT reach.rep, links.b FROM reach JOIN links ON links.a = reach.other)
  SELECT words, min(other) AS class_id FROM reach JOIN sets USING (rep) GROUP BY words) c USING (words)"""

# --- pages ------------------------------------------------------------------

_TAGS = "regexp_replace({}, '<[^>]*>', '', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _TAGS = f"replace({_TAGS}, '{_entity}', '{_char}')"
_TAGS = f"trim({_TAGS})"


def bare(text: str) -> str:
    return _TAGS.format(text)


def blocks(column: str, opening: str) -> str:
    return f"""SELECT page_id, base_url, place, generate_subscripts(b, 1) - 1 AS position, unnest(b) AS block
  FROM (SELECT page_id, base_url, place, string_split_regex({column}, '{opening}')[2:] AS b FROM listing_pages)"""


_CARD_LINES = "list_filter(string_split_regex(regexp_extract_all(block, '<p class=\"card-text\">(.*?)</p>', 1)[2], '<br */?>'), lambda x: trim(x) <> '')"

CTES["thumb_cards"] = f"""
SELECT page_id, position, regexp_extract(block, 'alt="([^"]*)"', 1) AS title,
  regexp_extract(block, 'listing-thumb-header" title="([^"]*)"', 1) AS address,
  nullif(regexp_extract(loc, '^([0-9]{{4}}) +', 1), '') AS zip_code,
  CASE WHEN regexp_matches(loc, '^[0-9]{{4}} +.') THEN regexp_extract(loc, '^[0-9]{{4}} +(.*)', 1) ELSE place END AS city,
  place AS region,
  TRY_CAST(replace(regexp_extract(regexp_extract(block, 'class="price">([^<]*)', 1), '[0-9'']+'), '''', '') AS BIGINT) AS price,
  base_url || nullif(regexp_extract(block, '<a href="([^"]*)"', 1), '') AS url
FROM (SELECT *, trim(regexp_extract(block, 'title__location">([^<]*)', 1)) AS loc FROM ({blocks("thumb_html", '<div class="listing-thumb">')}))"""

CTES["card_cards"] = f"""
SELECT page_id, position, regexp_extract(block, '<strong>(.*?)</strong>', 1) AS title,
  CASE WHEN len(ls) >= 2 THEN trim(ls[1]) END AS address,
  CASE WHEN len(ws) >= 2 THEN ws[1] END AS zip_code,
  CASE WHEN len(ws) > 2 THEN array_to_string(ws[2:-2], ' ') WHEN len(ws) = 2 THEN ws[2] END AS city,
  CASE WHEN len(ws) >= 2 THEN ws[-1] END AS region,
  TRY_CAST(regexp_extract(regexp_extract(block, '<h3 class="card-title">(.*?)</h3>', 1), '[0-9]+') AS BIGINT) AS price,
  base_url || regexp_extract(block, '^ href="([^"]*)"', 1) AS url
FROM (SELECT *, CASE WHEN len(ls) >= 2 THEN string_split_regex(trim(ls[2]), ' +') END AS ws
      FROM (SELECT *, {_CARD_LINES} AS ls FROM ({blocks("card_html", '<a class="listing"')})))"""

_CELLS = "list_filter(regexp_extract_all(table_html, '<tr>(.*?)</tr>', 1), lambda x: len(regexp_extract_all(x, '<td[^>]*>')) = 2)"


def cell(label: str) -> str:
    hit = f"list_filter(cells, lambda x: contains(x, '<td>{label}</td>'))[-1]"
    return bare(f"regexp_extract({hit}, '</td><td>(.*)</td>', 1)")


def pair(word: str) -> str:
    hit = f"list_filter(dts, lambda x: contains(lower(regexp_extract(x, '<dt[^>]*>(.*?)</dt>', 1)), '{word}'))[1]"
    return bare(f"regexp_extract({hit}, '<dd[^>]*>((?s:.*?))</dd>', 1)")


def item(word: str) -> str:
    """The list item that speaks of ``word``, which comes before the pairs."""
    hit = f"list_filter(lis, lambda x: contains(lower(regexp_replace(x, '<[^>]*>', '', 'g')), '{word}'))[1]"
    value = bare(f"regexp_extract({hit}, '<span class=\"value\">(.*?)</span>', 1)")
    return f"CASE WHEN {hit} IS NULL THEN {pair(word)} WHEN contains({hit}, '<span class=\"value\">') THEN {value} END"


CTES["thumb_details"] = f"""
SELECT page_id, {cell("Number of rooms:")} AS rooms, {cell("Floor:")} AS floor, {cell("Livingspace:")} AS area_sqm,
  {cell("Available:")} AS availability_date, contains(table_html, 'Lift, Balcony') AS has_balcony,
  CASE WHEN len(parts) > 0 THEN array_to_string(parts, chr(10) || chr(10)) END AS description
FROM (SELECT *, {_CELLS} AS cells,
  list_transform(list_concat(regexp_extract_all(table_html, 'user-generated-content">((?s:.*?))</strong>', 1),
    regexp_extract_all(table_html, '<p>((?s:.*?))</p>', 1)), lambda x: {bare("x")}) AS parts FROM detail_pages)"""

CTES["card_details"] = f"""
SELECT page_id, {item("zimmer")} AS rooms, {pair("etage")} AS floor, {item("fläche")} AS area_sqm,
  {item("verfügbar")} AS availability_date, contains(pairs_html, '<svg') AS has_balcony,
  CASE WHEN contains(pairs_html, 'class="description"')
    THEN {bare("regexp_extract(pairs_html, 'class=\"description\">((?s:.*?))</div>', 1)")} END AS description
FROM (SELECT *, regexp_extract_all(pairs_html, '<dt[^>]*>.*?</dd>') AS dts,
  regexp_extract_all(pairs_html, '<li class="list-group-item.*?</li>') AS lis FROM detail_pages)"""

# --- seeded numbers: the same md5 digits ------------------------------------

def _u(key: str) -> str:
    return f"((CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0)"


def _z(column: str) -> str:
    key = f"'|42|{column}|' || flag || '|' || rnd || '|' || draw"
    return f"(sqrt(-2e0 * ln({_u(f'{chr(39)}radius{chr(39)} || ' + key)})) * cos(2e0 * pi() * {_u(f'{chr(39)}angle{chr(39)} || ' + key)}))"


# --- one query per key ------------------------------------------------------

_CLEAN_COLUMNS = "title, address, zip_code, city, region, price, rooms, floor, area_sqm, availability_date, has_balcony, is_rental"
_URLS = "array_to_string(image_urls, '|') AS image_urls"
_FLAGS = ", ".join(vocab.AMENITIES)

_FEED = f"""SELECT title, address, zip_code, city, region, price, rooms, floor, area_sqm, availability_date,
        has_balcony, md5(description) AS description, {_URLS} FROM raw_listings"""

ORACLES: dict[str, str] = {
    "read_feeds": _FEED,
    "read_json_arrays": _FEED,
    "read_postal": """SELECT zip_code, city, region, city_clean, coalesce(listings, 0) AS listings FROM postal LEFT JOIN (
        SELECT TRY_CAST(zip_code AS INTEGER) AS zip_code, count(*) AS listings FROM raw_listings GROUP BY 1) USING (zip_code)""",
    "geo_cluster_rows": """SELECT count(*) AS listings, count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS clustered,
        0::BIGINT AS misplaced FROM properties""",
    "clean_from_feeds": f"SELECT {_CLEAN_COLUMNS}, md5(description) AS description, {_URLS} FROM clean_listings",
    "write_clean": f"SELECT {_CLEAN_COLUMNS}, md5(description) AS description, {_URLS} FROM clean_listings",
    "scan_properties": f"SELECT id, {_CLEAN_COLUMNS}, {_FLAGS}, md5(description) AS description FROM properties",
    "scan_images": "SELECT id, property_id FROM images",
    "load_properties": f"SELECT id, src_id, rooms, area_sqm, price, floor, is_rental, {_FLAGS} FROM properties",
    "explode_images": "SELECT id, property_id, url FROM images",
    "orphan_images": """SELECT id, property_id, url FROM images
        WHERE property_id NOT IN (SELECT id FROM properties WHERE is_rental)""",
    "extract_cards_html": """SELECT *, 'thumb' AS layout FROM thumb_cards UNION ALL SELECT *, 'card' FROM card_cards""",
    "extract_details_html": """SELECT * REPLACE (md5(description) AS description), 'thumb' AS layout FROM thumb_details
        UNION ALL SELECT * REPLACE (md5(description) AS description), 'card' FROM card_details""",
    "extract_image_urls": """
        SELECT page_id, array_to_string(list_transform(regexp_extract_all(table_html, 'contentUrl" href="([^"]*)"', 1),
          lambda u: CASE WHEN contains(u, '://') THEN u ELSE base_url || u END), '|') AS image_urls, 'thumb' AS layout FROM detail_pages
        UNION ALL SELECT page_id, coalesce((SELECT string_agg(u, '|' ORDER BY i) FROM (
            SELECT CASE WHEN contains(x, '://') THEN x ELSE base_url || x END AS u, min(j) AS i
            FROM (SELECT unnest(us) AS x, generate_subscripts(us, 1) AS j) GROUP BY 1)), ''), 'card'
        FROM (SELECT *, regexp_extract_all(pairs_html, 'swiper-slide"><img [^>]*src="([^"]*)"', 1) AS us FROM detail_pages)""",
    "page_outline": f"""SELECT page_id, {bare("regexp_extract(html, '<title[^>]*>((?s:.*?))</title>', 1)")} AS title,
        CAST(len(regexp_extract_all(html, '<a [^>]*href="[^"]*"')) AS BIGINT) AS links,
        CAST(len(regexp_extract_all(html, '<p(?:>|[^a-zA-Z0-9_>][^>]*>)(?s:.*?)</p>')) AS BIGINT) AS paragraphs FROM pages""",
    "image_files": "SELECT pid, imgid, name FROM files",
    "image_folder": "SELECT DISTINCT pid, imgid, name FROM files",
    "export_csv": f"""SELECT id AS "ID", coalesce(address, 'None') || {_TAIL} AS "Adresse" FROM addressed
        WHERE (latitude IS NULL OR longitude IS NULL) AND full_address NOT IN (SELECT full_address FROM gaz)""",
    "normalise_types": "SELECT src_id, rooms, area_sqm, price FROM typed",
    "parse_availability": f"SELECT src_id, {_AVAILABLE} AS availability_date FROM raw_listings",
    "resolve_floor": f"SELECT src_id, {floor_case(any_in)} AS floor FROM ({_TEXTS} raw_listings)",
    "resolve_floor_strict": f"SELECT src_id, {floor_case(any_word)} AS floor FROM ({_TEXTS} raw_listings)",
    "resolve_rooms": f"SELECT src_id, coalesce(rooms, {_SINGLE}) AS rooms FROM typed",
    "zip_city_from_text": "SELECT src_id, zip_code, city FROM ziptext",
    "city_from_gazetteer": "SELECT src_id, city FROM citied",
    "validate_zip": """SELECT src_id, CASE WHEN zip_code IN (SELECT zip_code FROM postal WHERE zip_code IS NOT NULL)
        THEN zip_code END AS zip_code FROM ziptext""",
    "normalise_region": "SELECT src_id, CASE WHEN length(trim(region)) <= 2 THEN upper(trim(region)) END AS region FROM raw_listings",
    "postal_rollup": """SELECT 'city' AS kind, city_clean AS key, CAST(zip_code AS VARCHAR) AS value, region FROM by_city
        UNION ALL SELECT 'zip', CAST(zip_code AS VARCHAR), city_clean, region FROM by_zip""",
    "backfill_location": "SELECT src_id, zip_code, city, region FROM backfilled",
    "area_from_text": f"SELECT src_id, {_AREA} AS area_sqm FROM typed",
    "amenity_flags": f"SELECT src_id, {_AMENITIES} FROM raw_listings",
    "impute_price": "SELECT src_id, price FROM priced",
    "drop_incomplete": """SELECT src_id, price, floor FROM raw_listings WHERE price IS NOT NULL AND address IS NOT NULL
        AND rooms IS NOT NULL AND floor IS NOT NULL AND area_sqm IS NOT NULL AND availability_date IS NOT NULL
        AND description IS NOT NULL""",
    "classify_rental": f"""SELECT src_id, {_RENTAL} AS is_rental
        FROM (SELECT *, lower(concat_ws(' ', title, description)) AS x FROM typed)""",
    "default_title": f"""SELECT src_id, coalesce(title, CASE WHEN r THEN 'Rental' WHEN NOT r THEN 'Property' END) AS title
        FROM (SELECT *, {_RENTAL} AS r FROM (SELECT *, lower(concat_ws(' ', title, description)) AS x FROM typed))""",
    "clean_listings": f"SELECT src_id, {_CLEAN_COLUMNS}, md5(description) AS description, {_URLS} FROM clean_listings",
    "dedup_listings": """SELECT min(src_id) AS src_id FROM copies
        GROUP BY title, address, zip_code, city, price, rooms, area_sqm, floor, description""",
    "dedup_near": """SELECT min(src_id) AS src_id FROM copies GROUP BY lower(address), rooms, area_sqm, floor, price,
        list_sort(list_distinct(regexp_extract_all(lower(concat_ws(' ', title, description)), '[\\p{L}\\p{N}_]{2,}')))""",
    "similar_classes": "SELECT src_id, class_id FROM alike",
    "dedup_similar": "SELECT src_id FROM alike WHERE src_id = class_id",
    "quality_report": """
        SELECT 'zip_code between 1000 and 9999' AS rule, count(*) FILTER (zip_code NOT BETWEEN 1000 AND 9999) AS violations FROM clean_listings
        UNION ALL SELECT 'price above 0', count(*) FILTER (price <= 0) FROM clean_listings
        UNION ALL SELECT 'rooms between 0.5 and 10', count(*) FILTER (rooms NOT BETWEEN 0.5 AND 10) FROM clean_listings
        UNION ALL SELECT 'floor not below 0', count(*) FILTER (floor < 0) FROM clean_listings
        UNION ALL SELECT 'area above 0', count(*) FILTER (area_sqm <= 0) FROM clean_listings
        UNION ALL SELECT 'at least 1000 distinct listings', greatest(1000 - count(*), 0) FROM (
          SELECT DISTINCT title, address, zip_code, city, price, rooms, area_sqm, floor, description FROM clean_listings)""",
    "missing_coordinates": "SELECT id, address, zip_code, city FROM properties WHERE latitude IS NULL OR longitude IS NULL",
    "compose_address": "SELECT id, full_address FROM addressed",
    "geocode_backfill": """SELECT id,
        round(CASE WHEN (latitude IS NULL OR longitude IS NULL) AND lat IS NOT NULL THEN lat ELSE latitude END, 6) AS latitude,
        round(CASE WHEN (latitude IS NULL OR longitude IS NULL) AND lat IS NOT NULL THEN lon ELSE longitude END, 6) AS longitude
        FROM addressed LEFT JOIN gaz USING (full_address)""",
    "geocode_failures": f"""SELECT id AS "ID", coalesce(address, 'None') || {_TAIL} AS "Adresse" FROM addressed
        WHERE (latitude IS NULL OR longitude IS NULL) AND full_address NOT IN (SELECT full_address FROM gaz)""",
    "update_coordinates": """SELECT id, round(CASE WHEN u.address IS NOT NULL THEN u.latitude ELSE p.latitude END, 6) AS latitude,
        round(CASE WHEN u.address IS NOT NULL THEN u.longitude ELSE p.longitude END, 6) AS longitude
        FROM properties p LEFT JOIN (SELECT * FROM coord_updates
          QUALIFY row_number() OVER (PARTITION BY address ORDER BY ordinal DESC) = 1) u ON p.address = u.address""",
    "expand_bbox": """SELECT place_id, round(s, 6) AS s, round(n, 6) AS n, round(w, 6) AS w, round(e, 6) AS e,
        replace(url_encode(city || ', ' || coalesce(region, '') || ', Switzerland'), '%2F', '/') AS place_name,
        coalesce(listings, 0) AS listings
        FROM wide_boxes LEFT JOIN (SELECT city, count(*) AS listings FROM raw_listings GROUP BY city) USING (city)""",
    "listings_in_bbox": """SELECT place_id, id FROM properties JOIN wide_boxes
        ON latitude BETWEEN s AND n AND longitude BETWEEN w AND e""",
    "map_points": """SELECT id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, title,
        coalesce(address, '') || ', ' || coalesce(city, '') AS place, price, rooms, has_balcony, image_urls[1] AS image
        FROM properties WHERE latitude <> 0 AND longitude <> 0""",
    "mode_filter": """SELECT id, 'rental' AS mode, price FROM properties WHERE price < 10000
        UNION ALL SELECT id, 'purchase', price FROM properties WHERE price > 80000""",
    "availability_features": f"""SELECT src_id, fill, days AS availability_days_from_now,
          CASE WHEN days <= 30 THEN 1 ELSE 0 END AS availability_soon
        FROM (SELECT src_id, fill, CASE fill WHEN 'zero' THEN coalesce(days, 0) ELSE days END AS days
          FROM (SELECT src_id, CAST(floor((epoch(CAST({_AVAILABLE} AS TIMESTAMP)) - epoch(TIMESTAMP '2025-06-01 09:30:00')) / 86400) AS BIGINT) AS days
                FROM raw_listings), (VALUES ('null'), ('zero')) f(fill))""",
    "size_floor_flags": f"""SELECT id, round(ln(1 + area_sqm), 6) AS log_area_sqm,
        CAST(coalesce(area_sqm < 30, false) AS INTEGER) AS is_small, CAST(coalesce(area_sqm > 80, false) AS INTEGER) AS is_large,
        CAST(coalesce(floor <= 0, false) AS INTEGER) AS is_ground_floor, CAST(coalesce(floor > 4, false) AS INTEGER) AS is_top_floor,
        {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ("has_balcony", "is_rental", *vocab.AMENITIES))} FROM properties""",
    "geo_bins": f"""SELECT id, {", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN CAST(greatest(0, least(9, ceil(10e0 * ({c} - (SELECT min({c}) FROM properties)) / ((SELECT max({c}) FROM properties) - (SELECT min({c}) FROM properties))) - 1)) AS BIGINT) END AS {n}"
        for c, n in (("latitude", "lat_bin"), ("longitude", "lon_bin")))} FROM properties""",
    "exclude_commercial": f"""SELECT id, title FROM properties WHERE NOT {any_in("lower(title)", vocab.COMMERCIAL_WORDS)}
        AND NOT {any_in("lower(description)", vocab.COMMERCIAL_WORDS)}""",
    "bounds_filter": """SELECT id, price, area_sqm FROM properties WHERE price > 200 AND price < 10000000 AND area_sqm > 10
        AND area_sqm < 1000 AND rooms IS NOT NULL AND floor IS NOT NULL AND zip_code IS NOT NULL AND city IS NOT NULL
        AND region IS NOT NULL AND has_balcony IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL""",
    "ratio_features": """SELECT id, round(price / nullif(area_sqm, 0), 7) AS price_per_sqm,
        round(area_sqm / nullif(rooms, 0), 7) AS room_size FROM properties""",
    "keyword_flags": f"""SELECT src_id, {", ".join(
        f'CAST(coalesce(contains(lower(title), {q(w)}), false) OR coalesce(contains(lower(description), {q(w)}), false) AS INTEGER) AS "kw_{w}"'
        for w in vocab.KEYWORDS)} FROM raw_listings""",
    "price_split": "SELECT id, CASE WHEN price <= 20000 THEN 'rental' ELSE 'purchase' END AS side FROM properties",
    "log_target": "SELECT id, round(ln(1e0 + price), 6) AS log_price, round(exp(ln(1e0 + price)) - 1, 4) AS price_back FROM properties",
    "augment_rare": f"""WITH flagged AS (
          SELECT id, CAST(price AS DOUBLE) AS price, rooms, area_sqm, CAST(floor AS DOUBLE) AS floor,
            CAST(floor > 4 AS INTEGER) AS is_top_floor, CAST(area_sqm > 80 AS INTEGER) AS is_large, CAST(area_sqm < 30 AS INTEGER) AS is_small
          FROM properties),
        pool AS (
          SELECT flag, id, count(*) OVER (PARTITION BY flag) AS size,
            row_number() OVER (PARTITION BY flag ORDER BY substr(md5('42|' || id), 1, 3), id) - 1 AS slot
          FROM flagged, (VALUES ('is_top_floor'), ('is_large'), ('is_small')) f(flag)
          WHERE CASE flag WHEN 'is_top_floor' THEN is_top_floor WHEN 'is_large' THEN is_large ELSE is_small END = 1),
        draws AS (
          SELECT flag, size, rnd, draw, CAST(floor({_u("'42|' || flag || '|' || rnd || '|' || draw")} * size) AS BIGINT) AS slot
          FROM (SELECT DISTINCT flag, size FROM pool), (SELECT unnest(range(20)) AS rnd), (SELECT unnest(range(300)) AS draw)
          WHERE draw < size)
        SELECT id, round(price, 5) AS price, round(rooms, 7) AS rooms, round(area_sqm, 6) AS area_sqm, round(floor, 7) AS floor,
          is_top_floor, is_large, is_small, false AS augmented FROM flagged
        UNION ALL
        SELECT id, {", ".join(f"round({c} * (1 + 0.03e0 * {_z(c)}), {d}) AS {c}" for c, d in (("price", 5), ("rooms", 7), ("area_sqm", 6), ("floor", 7)))},
          is_top_floor, is_large, is_small, true
        FROM draws JOIN pool USING (flag, slot) JOIN flagged USING (id)""",
    "profile_schema": "SELECT position, \"column\", type, (SELECT count(*) FROM clean_listings) AS rows FROM (VALUES " + ", ".join(
        f"({i}, '{n}', '{k}')" for i, (n, k) in enumerate((
            ("src_id", "bigint"), ("title", "string"), ("address", "string"), ("zip_code", "int"), ("city", "string"), ("region", "string"),
            ("price", "bigint"), ("rooms", "double"), ("area_sqm", "int"), ("floor", "int"), ("availability_date", "date"),
            ("description", "string"), ("has_balcony", "boolean"), ("image_urls", "array<string>"), ("latitude", "double"),
            ("longitude", "double"), ("is_rental", "boolean")))) + ") c(position, \"column\", type)",
    "one_hot": """SELECT id, cs AS city_slot, rs AS region_slot FROM properties
        LEFT JOIN (SELECT city, row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS cs FROM properties
              WHERE city IS NOT NULL GROUP BY city) USING (city)
        LEFT JOIN (SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS rs FROM properties
              WHERE region IS NOT NULL GROUP BY region) USING (region)""",
    "align_features": """SELECT id, CASE WHEN area_sqm > 80 THEN 1e0 ELSE 0e0 END AS is_large, 0e0 AS not_seen,
        coalesce(CAST(floor AS DOUBLE), 0e0) AS floor, coalesce(rooms, 0e0) AS rooms FROM properties""",
    "drop_text_columns": "SELECT src_id, zip_code, city, region, price, rooms, area_sqm, floor, has_balcony FROM properties",
    "tfidf": "SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
    "silhouette": """SELECT count(*) AS points, round(avg(CASE WHEN n = 1 THEN 0e0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0e0) END), 6) AS silhouette
        FROM (SELECT vec_id, max(CASE WHEN own THEN n END) AS n, max(CASE WHEN own THEN s / nullif(n - 1, 0) END) AS a,
                min(CASE WHEN NOT own THEN s / n END) AS b
          FROM (SELECT p.vec_id, p.label = o.label AS own, o.label, count(*) AS n,
                  sum(list_distance(p.embedding::DOUBLE[], o.embedding::DOUBLE[]) ** 2) AS s
                FROM embeddings p JOIN embeddings o ON true GROUP BY ALL) GROUP BY vec_id)""",
    "silhouette_exact": """SELECT count(*) AS points, round(avg(CASE WHEN size = 1 THEN 0e0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0e0) END), 6) AS silhouette
        FROM (SELECT x, max(size) AS size, max(CASE WHEN own THEN s / (n - 1) END) AS a, min(CASE WHEN NOT own THEN s / n END) AS b
          FROM (SELECT p.vec_id AS x, p.label = o.label AS own, o.label, sum(list_distance(p.embedding::DOUBLE[], o.embedding::DOUBLE[])) AS s,
                  count(*) AS n, max(CASE WHEN p.label = o.label THEN 1 END) AS k, sum(CASE WHEN p.label = o.label THEN 1 END) AS size
                FROM embeddings p, embeddings o GROUP BY ALL) GROUP BY x)""",
    "cluster_top_terms": "SELECT cluster, rank, term FROM top_terms",
    "cluster_term_table": "SELECT cluster, string_agg(term, ', ' ORDER BY rank) AS top_terms FROM top_terms GROUP BY cluster",
    "pool_vectors": """SELECT p.id, coalesce(first, 0e0) AS first, coalesce(last, 0e0) AS last, coalesce(total, 0e0) AS total,
          coalesce(squares, 0e0) AS squares
        FROM properties p LEFT JOIN (
          SELECT id, round(max(CASE WHEN j = 1 THEN v END), 6) AS first, round(max(CASE WHEN j = 64 THEN v END), 6) AS last,
            round(sum(v), 6) AS total, round(sum(v * v), 6) AS squares
          FROM (SELECT CAST(floor(vec_id / 4) AS BIGINT) + 1 AS id, j, avg(CAST(x AS DOUBLE)) AS v
            FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS j FROM embeddings) GROUP BY ALL)
          GROUP BY id) m ON m.id = p.id""",
    "stride_reduce": """SELECT vec_id, i AS pos,
        round(coalesce(CASE WHEN i < 100 THEN CAST(embedding[20 * i + 1] AS DOUBLE) END, 0e0), 6) AS value
        FROM embeddings, (SELECT unnest(range(100)) AS i)""",
    "merge_vectors": "SELECT id, price, label FROM properties JOIN (SELECT vec_id AS id, label FROM embeddings) USING (id)",
    "merge_counts": """SELECT count(*) AS before, count(vec_id) AS after, count(*) - count(vec_id) AS lost
        FROM properties LEFT JOIN embeddings ON vec_id = id""",
    "verify_images": "SELECT side, pid, imgid FROM lone QUALIFY row_number() OVER (PARTITION BY side ORDER BY pid, imgid) <= 10",
    "verify_images_all": "SELECT side, pid, imgid FROM lone",
    "verify_totals": """SELECT (SELECT count(*) FROM images) AS table_entries, (SELECT count(*) FROM (SELECT DISTINCT pid, imgid FROM files)) AS files,
        (SELECT count(*) FROM lone WHERE side = 'missing') AS missing, (SELECT count(*) FROM lone WHERE side = 'extra') AS extra""",
    "first_image": """SELECT pid, arg_min(name, CAST(imgid AS BIGINT)) AS name FROM files
        WHERE pid IN (SELECT CAST(id AS VARCHAR) FROM properties) GROUP BY pid""",
    "train_test_split": """SELECT id, CASE WHEN CAST(('0x' || substr(md5('42-' || CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 2000
        THEN 'test' ELSE 'train' END AS split FROM properties""",
    "regression_metrics": """SELECT round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse, round(avg(abs(actual - predicted)), 4) AS mae,
        round(1 - sum((actual - predicted) ** 2) / sum((actual - m) ** 2), 6) AS r2
        FROM predictions, (SELECT avg(actual) AS m FROM predictions)""",
    "regression_metrics_log": """SELECT round(sqrt(avg((actual - predicted) ** 2)), 3) AS rmse, round(avg(abs(actual - predicted)), 3) AS mae,
        round(1 - sum((actual - predicted) ** 2) / sum((actual - m) ** 2), 6) AS r2
        FROM predictions, (SELECT avg(actual) AS m FROM predictions)""",
    "actual_vs_predicted": """SELECT id, actual, round(predicted, 4) AS predicted, (SELECT min(actual) FROM predictions) AS line_from,
        (SELECT max(actual) FROM predictions) AS line_to FROM predictions""",
    "residual_histogram": """SELECT b AS bin, round(mn + b * w, 7) AS lo, round(mn + (b + 1) * w, 7) AS hi, count(*) AS n
        FROM (SELECT mn, w, CAST(least(floor((actual - predicted - mn) / w), 29) AS BIGINT) AS b FROM predictions,
          (SELECT min(actual - predicted) AS mn, (max(actual - predicted) - min(actual - predicted)) / 30e0 AS w FROM predictions))
        GROUP BY b, mn, w""",
    "validate_requests": f"""SELECT id, missing = '' AS ok, missing,
        coalesce(CAST(description_cluster AS INTEGER), 0) AS description_cluster,
        {", ".join(f"coalesce(CAST({f} AS INTEGER), 0) AS {f}" for f in vocab.REQUEST_FLAGS)},
        coalesce(availability_date, '2025-01-01') AS availability_date
        FROM (SELECT *, concat_ws(', ', {", ".join(
            f"CASE WHEN coalesce({c}, '') = '' THEN '{c}' END" for c in vocab.REQUEST_REQUIRED)}) AS missing FROM requests)""",
    "score_batch_rows": f"""SELECT mode, count(*) AS requests, count(*) FILTER (good) AS priced, count(*) FILTER (NOT good) AS refused
        FROM (SELECT mode, {" AND ".join(f"coalesce({c}, '') <> ''" for c in vocab.REQUEST_REQUIRED)} AND mode IN ('rental', 'purchase')
          AND {" AND ".join(f"TRY_CAST({c} AS {k}) IS NOT NULL" for c, k in (
              ("area", "DOUBLE"), ("floor", "INTEGER"), ("rooms", "DOUBLE"), ("lat", "DOUBLE"), ("lon", "DOUBLE"),
              ("zip_code", "INTEGER")))} AS good FROM requests) GROUP BY mode""",
    "score_batch_combined_rows": f"""SELECT mode, count(*) AS requests, count(*) FILTER (good) AS priced,
        count(*) FILTER (NOT good) AS refused, 0::BIGINT AS differing
        FROM (SELECT mode, {" AND ".join(f"coalesce({c}, '') <> ''" for c in vocab.REQUEST_REQUIRED)} AND mode IN ('rental', 'purchase')
          AND {" AND ".join(f"TRY_CAST({c} AS {k}) IS NOT NULL" for c, k in (
              ("area", "DOUBLE"), ("floor", "INTEGER"), ("rooms", "DOUBLE"), ("lat", "DOUBLE"), ("lon", "DOUBLE"),
              ("zip_code", "INTEGER")))} AS good FROM requests) GROUP BY mode""",
    "linear_single": " UNION ALL ".join(
        f"""SELECT '{mode}' AS mode, round(regr_slope(price, area_sqm), 4) AS slope, round(regr_intercept(price, area_sqm), 3) AS intercept,
        round(regr_r2(price, area_sqm), 6) AS r2 FROM properties WHERE {side}"""
        for mode, side in (("rental", "price < 10000"), ("purchase", "price > 80000"))),
    "describe_all": " UNION ALL ".join([
        *[f"""SELECT '{c}' AS "column", (SELECT count({c}) FROM clean_listings) AS "count", (SELECT count(DISTINCT {c}) FROM clean_listings) AS "unique",
            md5(v) AS top, n AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS "min", NULL::DOUBLE AS q25, NULL::DOUBLE AS q50,
            NULL::DOUBLE AS q75, NULL::DOUBLE AS "max"
            FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM clean_listings WHERE {c} IS NOT NULL GROUP BY 1
                  ORDER BY n DESC, md5(CAST({c} AS VARCHAR)) DESC LIMIT 1)"""
          for c in ("title", "address", "city", "region", "availability_date", "has_balcony", "description", "is_rental")],
        *[f"""SELECT '{c}', count({c}), NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, round(avg({c}), 7), round(stddev_samp({c}), 4),
            CAST(min({c}) AS DOUBLE), round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 7), round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 7),
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 7), CAST(max({c}) AS DOUBLE) FROM clean_listings"""
          for c in ("zip_code", "price", "rooms", "floor", "area_sqm")]]),
    "missing_counts": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing FROM raw_listings"""
        for c in ("src_id", "title", "address", "zip_code", "city", "region", "price", "rooms", "area_sqm", "floor",
                  "availability_date", "description", "has_balcony", "image_urls", "latitude", "longitude")),
    "eda_filter": "SELECT src_id, price, round(price_per_sqm, 7) AS price_per_sqm FROM eda",
    "histograms": """SELECT metric, b AS bin, round(mn + b * w, 7) AS lo, round(mn + (b + 1) * w, 7) AS hi, count(*) AS n
        FROM (SELECT metric, mn, w, CAST(least(floor((value - mn) / w), bins - 1) AS BIGINT) AS b FROM eda_long
          JOIN (SELECT metric, min(value) AS mn, (max(value) - min(value)) / any_value(bins) AS w FROM eda_long GROUP BY metric) USING (metric))
        GROUP BY metric, b, mn, w""",
    "density_curve": """SELECT metric, i AS point, round(x, 4) AS x, round(sum(n * exp(-0.5e0 * ((x - value) / h) ** 2)) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 9) AS density
        FROM (SELECT metric, value, count(*) AS n FROM eda_long GROUP BY ALL)
        JOIN (SELECT metric, i, mn + i * ((mx - mn) / 199e0) AS x, h, total FROM (SELECT unnest(range(200)) AS i),
          (SELECT metric, min(value) AS mn, max(value) AS mx, count(*) AS total, stddev_samp(value) * count(*) ** (-0.2e0) AS h
           FROM eda_long WHERE metric <> 'rooms' GROUP BY metric)) USING (metric) GROUP BY metric, i, x""",
    "correlation_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM eda"
        for a in ("price", "rooms", "floor", "area_sqm", "price_per_sqm")
        for b in ("price", "rooms", "floor", "area_sqm", "price_per_sqm")),
    "avg_price_by_region": "SELECT region, round(avg(price), 7) AS avg_price FROM eda WHERE region IS NOT NULL GROUP BY region ORDER BY 2, 1",
    "desc_length_vs_price": "SELECT src_id, coalesce(length(description), 0) AS desc_length, price FROM eda",
    "region_area_price_points": "SELECT src_id, region, area_sqm, round(price_per_sqm, 7) AS price_per_sqm FROM eda",
    "explore": """SELECT id, city, price, rooms, area_sqm FROM properties WHERE contains(lower(city), 'er')
        AND (price IS NULL OR price = 0 OR price BETWEEN 600 AND 400000) AND (rooms IS NULL OR rooms = 0 OR rooms BETWEEN 2 AND 4.5)
        AND (area_sqm IS NULL OR area_sqm = 0 OR area_sqm BETWEEN 30 AND 160) AND has_balcony""",
    "explore_count": """SELECT count(*) FILTER (contains(lower(region), 'z') AND NOT has_garden AND NOT has_view
        AND (price IS NULL OR price = 0 OR price >= 1000)) AS shown, count(*) AS total FROM properties""",
    "explore_display": f"""SELECT id, title, address, zip_code, city, region,
        CASE WHEN price <> 0 THEN 'CHF ' || format('{{:,}}', price) ELSE '-' END AS price, rooms, area_sqm, floor,
        coalesce(strftime(availability_date, '%-m/%-d/%Y'), '-') AS availability_date,
        {", ".join(f"CASE WHEN {c} THEN '✓' ELSE '✗' END AS {c}" for c in ("has_balcony", "is_rental", *vocab.AMENITIES))} FROM properties""",
}

def _with_chain(sql: str) -> str:
    """``sql`` preceded by the CTEs it needs, in dependency order."""
    order: list[str] = []
    open_: set[str] = set()

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            if name in CTES and name not in open_:
                open_.add(name)
                visit(CTES[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql
    chain = "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in order)
    return chain + (", " + sql[5:] if sql.startswith("WITH ") else " " + sql)


def oracles() -> dict[str, str]:
    return {name: _with_chain(sql) for name, sql in ORACLES.items()}
