"""Listing tables derived from the given parquet tables.

``POSTAL_REF``, ``RAW_LISTINGS``, ... are SQL texts that Spark and DuckDB both
run, so that queries and their SQL twins start from equal rows.  Each listing
comes from one order (its key is the order key); the gazetteer grows with the
supplier table; whole document texts are appended to descriptions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("orders", "supplier", "documents", "embeddings", "pages")

# A core of well-known places: one with a slash, one with a dot, one with two
# zips, names that are prefixes of others, and a first row without region.
POSTAL_REF = """
SELECT * FROM (VALUES
  (CAST(1 AS BIGINT), '8001', 'Zürich', 'ZH', 47.3717e0, 8.5423e0),
  (CAST(2 AS BIGINT), '8004', 'Zürich', 'zh ', 47.3776e0, 8.5220e0),
  (CAST(3 AS BIGINT), '3011', 'Bern', 'BE', 46.9480e0, 7.4474e0),
  (CAST(4 AS BIGINT), '2502', 'Biel/Bienne', 'BE', 47.1368e0, 7.2468e0),
  (CAST(5 AS BIGINT), '9000', 'St. Gallen', 'SG', 47.4245e0, 9.3767e0),
  (CAST(6 AS BIGINT), '9500', 'Wil', 'SG', 47.4615e0, 9.0455e0),
  (CAST(7 AS BIGINT), '3812', 'Wilderswil', 'BE', 46.6640e0, 7.8610e0),
  (CAST(8 AS BIGINT), '1003', 'Lausanne', 'VD', 46.5197e0, 6.6323e0),
  (CAST(9 AS BIGINT), '1201', 'Genève', 'GE', 46.2044e0, 6.1432e0),
  (CAST(10 AS BIGINT), '4051', 'Basel', 'BS', 47.5596e0, 7.5886e0),
  (CAST(11 AS BIGINT), '8610', 'Uster', NULL, 47.3471e0, 8.7209e0),
  (CAST(12 AS BIGINT), '8610', ' Uster', 'ZH', 47.3471e0, 8.7209e0),
  (CAST(13 AS BIGINT), '6900', 'Lugano', 'TI', 46.0037e0, 8.9511e0),
  (CAST(14 AS BIGINT), '6003', 'Luzern', 'LU', 47.0502e0, 8.3093e0),
  (CAST(15 AS BIGINT), '8400', 'Winterthur', 'ZH', 47.4988e0, 8.7237e0),
  (CAST(16 AS BIGINT), 'n/a', 'Au', 'SG', 47.4330e0, 9.6340e0)
) AS core(ord, plz, ort, kt, lat, lon)
UNION ALL
SELECT s_suppkey + 17 AS ord,
  CASE WHEN s_suppkey % 17 = 5 THEN NULL ELSE CAST(1000 + (s_suppkey * 37) % 9000 AS STRING) END AS plz,
  CASE s_suppkey % 5 WHEN 0 THEN 'Ober' WHEN 1 THEN 'Unter' WHEN 2 THEN 'Hinter' WHEN 3 THEN 'Vorder' ELSE 'Nieder' END
    || CASE s_suppkey % 7 WHEN 0 THEN 'dorf' WHEN 1 THEN 'wil' WHEN 2 THEN 'bach' WHEN 3 THEN 'kon'
         WHEN 4 THEN 'au' WHEN 5 THEN 'berg' ELSE 'tal' END
    || '-' || CAST(s_suppkey AS STRING) AS ort,
  CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE
    CASE s_nationkey % 8 WHEN 0 THEN 'ZH' WHEN 1 THEN 'be' WHEN 2 THEN 'LU' WHEN 3 THEN ' UR' WHEN 4 THEN 'SZ'
      WHEN 5 THEN 'OW' WHEN 6 THEN 'GL' ELSE 'VS' END END AS kt,
  46 + ((s_suppkey * 13) % 150) / 100e0 AS lat,
  6 + ((s_suppkey * 29) % 400) / 100e0 AS lon
FROM supplier
"""

# k = order key, c = customer key.  Every rule cycles with its own period so
# that the combinations mix.
RAW_LISTINGS = """
SELECT k AS src_id,
  CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Villa mit Seeblick' WHEN 2 THEN 'Büro im Zentrum'
    WHEN 3 THEN 'Shop for rent' WHEN 4 THEN 'Einfamilienhaus Nr. ' || CAST(c AS STRING)
    WHEN 5 THEN 'Studio nahe Bahnhof' ELSE 'Wohnung ' || CAST(c AS STRING) END AS title,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 5 = 1 THEN 'Village Rue ' || CAST(c % 200 AS STRING)
    WHEN k % 5 = 2 THEN 'Quartier Dorfstrasse ' || CAST(c % 200 AS STRING) || ' au calme et vert'
    ELSE 'Bahnhofstrasse ' || CAST(c % 200 AS STRING) END AS address,
  CASE WHEN k % 10 IN (0, 4) THEN NULL WHEN k % 10 = 1 THEN '9999' ELSE plz END AS zip_code,
  CASE WHEN k % 7 IN (0, 3) THEN NULL ELSE trim(ort) END AS city,
  CASE k % 4 WHEN 0 THEN trim(ort) || ' Land' WHEN 1 THEN ' ' || lower(kt) WHEN 2 THEN NULL ELSE kt END AS region,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 5 THEN 'auf Anfrage'
    WHEN k % 5 = 0 THEN CAST(100000 + 5000 * (20 + k % 180) + CAST(floor(o_totalprice / 2) AS BIGINT) AS STRING)
    ELSE CAST(300 + 15 * (20 + k % 180) + (7 * c) % 900 AS STRING) END AS price,
  CASE k % 6 WHEN 0 THEN '3 ½' WHEN 1 THEN '4' WHEN 2 THEN '2.5' WHEN 3 THEN NULL WHEN 4 THEN 'n/a'
    ELSE CASE WHEN k % 4 = 1 THEN '½' ELSE '1 ½' END END AS rooms,
  CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN '1''200 m²' WHEN 2 THEN '8 m²'
    ELSE CAST(20 + k % 180 AS STRING) || ' m²' END AS area_sqm,
  CASE k % 10 WHEN 0 THEN 'EG' WHEN 1 THEN '2. OG' WHEN 2 THEN 'UG' WHEN 3 THEN 'Ground floor' WHEN 4 THEN '-1'
    WHEN 5 THEN '7' WHEN 6 THEN '3. Stock' WHEN 7 THEN ' Erdgeschoss ' ELSE NULL END AS floor,
  CASE k % 11 WHEN 0 THEN 'sofort' WHEN 1 THEN 'immediately' WHEN 2 THEN 'nach Vereinbarung'
    WHEN 3 THEN 'by arrangement' WHEN 4 THEN 'by agreement' WHEN 5 THEN '2025-07-01' WHEN 6 THEN '15.08.2025'
    WHEN 7 THEN 'Sofort' WHEN 8 THEN NULL WHEN 9 THEN '2025-06-01' ELSE '01.05.2025' END AS availability_date,
  CASE k % 8
    WHEN 0 THEN 'Moderne Wohnung mit Garten und Balkon, ' || coalesce(plz, '') || ' ' || trim(ort) || ', 85 m², 2. OG, Miete monatlich'
    WHEN 1 THEN 'Bel appartement neuf avec vue et jardin, parking, ' || CAST(30 + k % 150 AS STRING) || ' m2'
    WHEN 2 THEN 'Renovated flat in ' || trim(ort) || ' liegt zentral, ' || CAST(20 + k % 90 AS STRING) || ' sqm, third. floor'
    WHEN 3 THEN 'Appartamento nuovo con vista e giardino, box, climatizzazione'
    WHEN 4 THEN 'Haus zum Kauf, ruhig und hell, Garage, nähe ' || lower(trim(ort)) || ', Baujahr 1990'
    WHEN 5 THEN NULL
    WHEN 6 THEN 'Studio zu vermieten in ' || trim(ort) || ', Parkett, Aussicht, 4. Etage, 120 Quadratmeter'
    ELSE 'Attika, 5. OG, Lift, Minergie, Terrasse, nah bei ' || upper(trim(ort)) END
    || coalesce(chr(10) || text, '') AS description,
  k % 3 = 0 AS has_balcony,
  CASE k % 4 WHEN 0 THEN NULL
    WHEN 1 THEN split('https://img.example.org/' || CAST(k AS STRING) || '/a.jpg', ' ')
    WHEN 2 THEN split('https://img.example.org/' || CAST(k AS STRING) || '/a.jpg https://img.example.org/'
                      || CAST(k AS STRING) || '/b.jpg', ' ')
    ELSE split('https://img.example.org/' || CAST(k AS STRING) || '/a.jpg https://img.example.org/'
               || CAST(k AS STRING) || '/b.jpg https://img.example.org/' || CAST(k AS STRING) || '/a.jpg', ' ')
    END AS image_urls,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN 0e0 ELSE lat + (k % 100 - 50) / 1000e0 END AS latitude,
  CASE WHEN k % 19 = 0 OR k % 29 = 0 THEN NULL ELSE lon + (c % 100 - 50) / 1000e0 END AS longitude
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice FROM orders) o
CROSS JOIN (SELECT count(*) AS ords FROM postal_ref) n
JOIN postal_ref p ON p.ord = o.k % n.ords + 1
LEFT JOIN documents d ON d.doc_id = o.k
"""

# Stored result pages: three cards of one layout each, rendered from listings.
LISTING_PAGES = """
SELECT CAST(floor(src_id / 3) AS BIGINT) AS page_id,
  'https://homes.example.org/search/' || CAST(CAST(floor(src_id / 3) AS BIGINT) AS STRING) AS url,
  'https://homes.example.org' AS base_url, max(CASE WHEN src_id % 3 = 0 THEN place END) AS place,
  '<html><body><div class="listing-list">'
    || coalesce(max(CASE WHEN src_id % 3 = 0 THEN thumb END), '')
    || coalesce(max(CASE WHEN src_id % 3 = 1 THEN thumb END), '')
    || coalesce(max(CASE WHEN src_id % 3 = 2 THEN thumb END), '')
    || '</div></body></html>' AS thumb_html,
  '<html><body>'
    || coalesce(max(CASE WHEN src_id % 3 = 0 THEN card END), '')
    || coalesce(max(CASE WHEN src_id % 3 = 1 THEN card END), '')
    || coalesce(max(CASE WHEN src_id % 3 = 2 THEN card END), '')
    || '</body></html>' AS card_html
FROM (
  SELECT src_id, trim(region) AS place,
    '<div class="listing-thumb"><header class="listing-thumb-header" title="' || coalesce(address, '') || '">'
      || CASE WHEN src_id % 14 = 3 THEN '' ELSE '<a href="/en/flat/' || CAST(src_id AS STRING) || '/" class="listing-thumb__image">' END
      || '<div class="listing-image"><img src="/t.jpg" alt="' || coalesce(title, '') || '"></div></a></header>'
      || '<span class="price">CHF ' || coalesce(CASE WHEN length(price) > 3 AND price <> 'auf Anfrage'
           THEN substring(price, 1, length(price) - 3) || '''' || substring(price, length(price) - 2, 3) || '.–' ELSE price END, 'on request')
      || '</span><h2 class="listing-thumb-title"><span class="listing-thumb-title__location"> '
      || coalesce(zip_code || ' ', '') || coalesce(city, '') || '</span></h2></div>' AS thumb,
    '<a class="listing" href="/objekt/' || CAST(src_id AS STRING) || '"><h3 class="card-title">'
      || coalesce('Fr. ' || price, '') || '</h3><p class="card-text"><strong>' || coalesce(title, '') || '</strong></p>'
      || CASE WHEN src_id % 15 = 4 THEN '' ELSE '<p class="card-text">' || coalesce(address, 'Weg 1') || '<br/>'
         || coalesce(zip_code, '1000') || ' ' || coalesce(city, 'Ort') || coalesce(' ' || trim(region), '') || '</p>' END
      || '</a>' AS card
  FROM raw_listings
) cards
GROUP BY floor(src_id / 3)
"""

# Stored detail pages, one per listing: two-cell rows and dt/dd pairs.
DETAIL_PAGES = """
SELECT src_id AS page_id, 'https://homes.example.org' AS base_url,
  '<html><body><table><tbody>'
    || coalesce('<tr><td>Number of rooms:</td><td> ' || rooms || ' </td></tr>', '')
    || coalesce('<tr><td>Floor:</td><td>' || floor || '</td></tr>', '')
    || '<tr><td colspan="2">Details</td></tr>'
    || coalesce('<tr><td>Livingspace:</td><td><b>' || area_sqm || '</b></td></tr>', '')
    || coalesce('<tr><td>Available:</td><td>' || availability_date || '</td></tr>', '')
    || CASE WHEN has_balcony THEN '<tr><td>Facilities:</td><td>Lift, Balcony</td></tr>' ELSE '' END
    || '</tbody></table>'
    || coalesce('<strong class="user-generated-content">' || title || '</strong>', '')
    || coalesce('<div class="markdown"><p>' || replace(description, chr(10), '</p><p>') || '</p></div>', '')
    || coalesce('<figure itemtype="http://schema.org/ImageObject"><a itemprop="contentUrl" href="/img/' || CAST(src_id AS STRING) || '/1.jpg">x</a></figure>', '')
    || CASE WHEN src_id % 4 = 2 THEN '<figure itemtype="http://schema.org/ImageObject"><a itemprop="contentUrl" href="https://cdn.example.org/2.jpg">x</a></figure>' ELSE '' END
    || '</body></html>' AS table_html,
  '<html><body>'
    || CASE WHEN src_id % 6 = 1 THEN '<ul><li class="list-group-item d-flex">Anzahl Zimmer: <span class="value"> <b>' || CAST(src_id % 7 AS STRING) || '</b></span></li>'
         || '<li class="list-group-item">Etage <span class="value">99</span></li></ul>'
       WHEN src_id % 6 = 2 THEN '<li class="list-group-item">Wohnfläche auf Anfrage</li><li>Zimmer <span class="value">1</span></li>'
       ELSE '' END
    || '<dl>' || coalesce('<dt class="fst-normal">Zimmer</dt><dd class="col">' || rooms || '</dd>', '')
    || coalesce('<dt class="fst-normal">Etage</dt><dd class="col">' || floor || '</dd>', '')
    || coalesce('<dt>Wohnfläche</dt><dd>' || area_sqm || '</dd>', '')
    || coalesce('<dt>verfügbar ab</dt><dd>' || availability_date || '</dd>', '')
    || '<dt class="fst-normal">Balkon/Terrasse</dt><dd class="col">' || CASE WHEN has_balcony THEN '<svg></svg>' ELSE '-' END || '</dd>'
    || '</dl>' || coalesce('<div class="description"> ' || description || ' </div>', '')
    || CASE WHEN src_id % 4 = 0 THEN '' ELSE '<div class="swiper-slide"><img src="/p/' || CAST(src_id AS STRING) || '.jpg"></div>' END
    || CASE WHEN src_id % 4 = 3 THEN '<div class="swiper-slide"><img src="/p/' || CAST(src_id AS STRING) || '.jpg"></div>' ELSE '' END
    || CASE WHEN src_id % 4 = 1 THEN '<div class="swiper-slide"><img alt="" src="https://cdn.example.org/x.jpg"></div>' ELSE '' END
    || '</body></html>' AS pairs_html
FROM raw_listings
"""

IMAGE_FILES = """
SELECT CAST(property_id AS STRING) || '-' || CAST(id AS STRING) || CASE WHEN id % 4 = 0 THEN '.JPG' ELSE '.jpg' END AS name
FROM images WHERE id % 10 <> 3
UNION ALL
SELECT CAST(property_id AS STRING) || '-' || CAST(id + 100000000 AS STRING) || '.jpg' FROM images WHERE id % 97 = 5
UNION ALL
SELECT 'cover' || CAST(id AS STRING) || '.png' FROM images WHERE id % 89 = 1
"""

# Listings by composed address: a third in each gazetteer, a third in none.
GAZETTEERS = """
SELECT src, full_address, min(lat) AS latitude, max(lon) AS longitude FROM (
  SELECT CASE WHEN id % 3 = 0 THEN 'primary' ELSE 'fallback' END AS src,
    full_address, 46 + (id % 100) / 50e0 AS lat, 6 + (id % 300) / 100e0 AS lon
  FROM addressed WHERE id % 3 <> 2
) g GROUP BY src, full_address
"""

COORD_UPDATES = """
SELECT id AS ordinal, address,
  CASE WHEN id % 31 = 0 THEN NULL ELSE 46 + (id % 97) / 60e0 END AS latitude,
  CASE WHEN id % 31 = 0 THEN NULL ELSE 6 + (id % 89) / 30e0 END AS longitude
FROM properties WHERE id % 4 = 0
"""

REQUESTS = """
SELECT id,
  CASE WHEN id % 12 = 0 THEN NULL WHEN is_rental THEN 'rental' ELSE 'purchase' END AS mode,
  CASE WHEN id % 12 = 1 THEN '' ELSE CAST(CAST(area_sqm AS BIGINT) AS STRING) END AS area,
  CASE WHEN id % 12 = 2 THEN NULL ELSE CAST(floor AS STRING) END AS floor,
  CASE WHEN id % 12 = 3 THEN '' ELSE CAST(CAST(rooms AS BIGINT) AS STRING) || '.5' END AS rooms,
  CASE WHEN id % 12 = 4 THEN NULL ELSE '47.' || CAST(id % 90 AS STRING) END AS lat,
  CASE WHEN id % 12 IN (4, 5) THEN '' ELSE '8.' || CAST(id % 90 AS STRING) END AS lon,
  CASE WHEN id % 12 = 6 THEN NULL ELSE CAST(zip_code AS STRING) END AS zip_code,
  CASE WHEN id % 12 = 7 THEN '' ELSE city END AS city,
  CASE WHEN id % 12 = 8 THEN NULL ELSE region END AS region,
  CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 10 AS STRING) END AS description_cluster,
  CASE WHEN id % 4 = 0 THEN NULL WHEN has_balcony THEN '1' ELSE '0' END AS has_balcony,
  CASE WHEN has_view THEN '1' ELSE '0' END AS has_view,
  CASE WHEN has_garden THEN '1' END AS has_garden,
  CASE WHEN has_parking THEN '1' END AS has_parking,
  CASE WHEN has_air_conditioning THEN '1' END AS has_air_conditioning,
  CASE WHEN is_new THEN '1' END AS is_new,
  CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(availability_date AS STRING) END AS availability_date
FROM properties
"""

PREDICTIONS = """
SELECT src_id AS id, CAST(price AS DOUBLE) AS actual, price * (90 + src_id % 21) / 100e0 AS predicted
FROM clean_listings
"""

# SQL-derived tables and the tables each one reads.
DERIVED = {
    "postal_ref": (POSTAL_REF, ("supplier",)),
    "raw_listings": (RAW_LISTINGS, ("orders", "documents", "postal_ref")),
    "listing_pages": (LISTING_PAGES, ("raw_listings",)),
    "detail_pages": (DETAIL_PAGES, ("raw_listings",)),
    "image_files": (IMAGE_FILES, ("images",)),
    "gazetteers": (GAZETTEERS, ("addressed",)),
    "coord_updates": (COORD_UPDATES, ("properties",)),
    "requests": (REQUESTS, ("properties",)),
    "predictions": (PREDICTIONS, ("clean_listings",)),
}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, name: str, **inputs: DataFrame) -> DataFrame:
    """Run a derivation text over the given DataFrames."""
    sql, needs = DERIVED[name]
    views = {}
    for table in needs:
        view = f"lm_{name}_{table}"
        inputs[table].createOrReplaceTempView(view)
        views[table] = view
    ctes = ", ".join(f"{t} AS (SELECT * FROM {v})" for t, v in views.items())
    return spark.sql(f"WITH {ctes} {sql}")
