"""Stored listing pages to columns.  Regular expressions over the whole page,
no parser: selectors become patterns for a tag with a given class, attributes
are read from the matched tag in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmill.functions import text as tx

# Classes and labels of the two page layouts.
LAYOUTS = ("thumb", "card")
THUMB_CARD, THUMB_LINK, THUMB_IMAGE = "listing-thumb", "listing-thumb__image", "listing-image"
THUMB_HEADER, THUMB_PRICE, THUMB_PLACE = "listing-thumb-header", "price", "listing-thumb-title__location"
THUMB_HEADING, THUMB_BODY = "user-generated-content", "markdown"
THUMB_LABELS = {
    "rooms": "Number of rooms:", "floor": "Floor:", "area_sqm": "Livingspace:",
    "availability_date": "Available:", "facilities": "Facilities:",
}
THUMB_BALCONY = "Balcony"
CARD, CARD_PRICE, CARD_TEXT = "listing", "card-title", "card-text"
CARD_BODY, CARD_SLIDE = "description", "swiper-slide"
CARD_LABELS = {"rooms": "zimmer", "floor": "etage", "area_sqm": "fläche", "availability_date": "verfügbar"}
CARD_BALCONY = "balkon"
CARD_ITEM, CARD_ITEM_VALUE, CARD_ITEM_FIELDS = "list-group-item", "value", ("rooms", "area_sqm", "availability_date")

# With the (?s) flag a dot scans several times faster than a class of everything.
_ANY = "."


def _tag(name: str, css_class: str) -> str:
    """Pattern of an opening tag that carries a class among its classes."""
    return rf'<{name}\b[^>]*\bclass="(?:[^"]*[ ])?{css_class}(?:[ ][^"]*)?"[^>]*>'


def _attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf'[ ]{name}="([^"]*)"', 1)


def _none_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def _absolute(href: Column, base: Column) -> Column:
    """``href`` seen from the page ``base``: whole, without scheme, from the site's root, or from the page's folder."""
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(path == site, F.concat(site, F.lit("/"))).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    return (F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, href))
            .when(href.startswith("/"), F.concat(site, href))
            .otherwise(F.concat(folder, href)))


def _blocks(html: Column, opening: str) -> Column:
    """Page split at every opening tag: one text per block, each starting with its tag."""
    return F.filter(F.split(html, f"(?={opening})"), lambda block: block.rlike("^" + opening))


def _price(text: Column) -> Column:
    digits = F.regexp_extract(text, r"([0-9'’]+)", 1)
    return F.regexp_replace(digits, "['’]", "").try_cast("bigint")


def extract_cards_html(pages: DataFrame, html: str, layout: str, place: str | None = None) -> DataFrame:
    """One row per listing card of a result page: page, position, title,
    address, zip, city, region, price and link.

    ``thumb`` cards give zip and city in one text and no region: the place the
    page was searched for, column ``place`` of ``pages``, is the region, and
    the city of a card that names none; without that column both are null.
    ``card`` cards list street and place, which ends in the region when it has
    more than two words.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    opening = _tag("div", THUMB_CARD) if layout == "thumb" else _tag("a", CARD)
    searched = (F.col(place) if place else F.lit(None)).cast("string").alias("_searched")
    cards = pages.select("page_id", "base_url", searched, F.posexplode(_blocks(F.col(html), opening)).alias("position", "block"))
    block = F.col("block")
    if layout == "thumb":
        link = _attribute(F.regexp_extract(block, _tag("a", THUMB_LINK), 0), "href")
        title = _attribute(F.regexp_extract(
            block, rf"(?s){_tag('[a-z]+', THUMB_IMAGE)}{_ANY}*?(<img[^>]*>)", 1), "alt")
        address = _attribute(F.regexp_extract(block, _tag("header", THUMB_HEADER), 0), "title")
        price_text = F.regexp_extract(block, rf"{_tag('span', THUMB_PRICE)}([^<]*)", 1)
        named = tx.trim_ws(F.regexp_extract(block, rf"{_tag('[a-z0-9]+', THUMB_PLACE)}([^<]*)", 1))
        found = cards.withColumns({"_place": named, "_price": price_text, "_link": link}).withColumns({
            "zip_code": _none_if_empty(F.regexp_extract("_place", r"^([0-9]{4})\s+(.*)", 1)),
            "city": F.coalesce(_none_if_empty(F.regexp_extract("_place", r"^([0-9]{4})\s+(.*)", 2)), F.col("_searched")),
            "region": F.col("_searched"),
        })
    else:
        link = _attribute(F.regexp_extract(block, opening, 0), "href")
        title = tx.strip_tags(F.regexp_extract(
            block, rf"(?s){_tag('p', CARD_TEXT)}{_ANY}*?<strong[^>]*>({_ANY}*?)</strong>", 1))
        price_text = tx.strip_tags(F.regexp_extract(block, rf"(?s){_tag('h3', CARD_PRICE)}({_ANY}*?)</h3>", 1))
        texts = F.regexp_extract_all(block, F.lit(rf"(?s){_tag('p', CARD_TEXT)}({_ANY}*?)</p>"), F.lit(1))
        lines = F.split(F.get(texts, F.lit(1)), r"<br\s*/?>")
        lines = F.filter(lines, lambda x: ~x.rlike(r"^\s*$"))
        found = (
            cards.withColumns({"_lines": lines, "_price": price_text, "_link": link})
            .withColumns({
                "_street": F.when(F.size("_lines") >= 2, tx.strip_tags(F.get("_lines", F.lit(0)))),
                "_words": F.split(tx.strip_tags(F.get("_lines", F.lit(1))), r"\s+"),
            })
            .withColumn("_n", F.coalesce(F.when(F.size("_lines") >= 2, F.size("_words")), F.lit(0)))
            .withColumns({
                "zip_code": F.when(F.col("_n") >= 2, F.get("_words", F.lit(0))),
                "region": F.when(F.col("_n") >= 2, F.element_at("_words", -1)),
                "city": F.when(F.col("_n") > 2, F.array_join(F.slice("_words", F.lit(2), F.greatest(F.col("_n") - 2, F.lit(0))), " "))
                        .when(F.col("_n") == 2, F.get("_words", F.lit(1))),
            })
        )
        address = F.col("_street")
    return found.select(
        "page_id", "position", title.alias("title"), address.alias("address"), "zip_code", "city", "region",
        _price(F.col("_price")).alias("price"),
        F.when(F.col("_link") != "", _absolute(F.col("_link"), F.col("base_url"))).alias("url"))


def _pairs(items: Column, key: str, value: str) -> Column:
    """Fragments to (label, value) structs of their bare texts."""
    return F.transform(items, lambda x: F.struct(
        tx.strip_tags(F.regexp_extract(x, key, 1)).alias("label"),
        tx.strip_tags(F.regexp_extract(x, value, 1)).alias("value"),
        F.regexp_extract(x, value, 1).alias("markup")))


def extract_details_html(pages: DataFrame, html: str, layout: str) -> DataFrame:
    """Rooms, floor, area, availability, balcony and description of a detail page.

    ``thumb`` pages hold table rows of two cells (a label that repeats counts
    last) and the description as a heading with paragraphs; ``card`` pages hold
    dt/dd pairs (the first label that contains the word counts).  For rooms,
    area and availability the first list item that contains the word comes
    before all pairs, even if it has no value.
    """
    page = F.col(html)
    if layout == "thumb":
        rows = F.filter(
            F.regexp_extract_all(page, F.lit(rf"(?s)<tr\b[^>]*>({_ANY}*?)</tr>"), F.lit(1)),
            lambda r: F.size(F.regexp_extract_all(r, F.lit(r"<td\b[^>]*>"), F.lit(0))) == 2)
        cell = rf"(?s)<td\b[^>]*>({_ANY}*?)</td>"
        pairs = _pairs(rows, rf"(?s)^{_ANY}*?{cell}", rf"(?s)</td>{_ANY}*?{cell}")

        def look(label: str) -> Column:
            hits = F.filter("_pairs", lambda p: p["label"] == label)
            return F.get(F.transform(hits, lambda p: p["value"]), F.size(hits) - 1)

        heading = F.regexp_extract_all(
            page, F.lit(rf"(?s){_tag('strong', THUMB_HEADING)}({_ANY}*?)</strong>"), F.lit(1))
        body = F.regexp_extract(page, rf"(?s){_tag('div', THUMB_BODY)}({_ANY}*?)</div>", 1)
        paragraphs = F.regexp_extract_all(body, F.lit(rf"(?s)<p\b[^>]*>({_ANY}*?)</p>"), F.lit(1))
        parts = F.transform(F.concat(F.slice(heading, 1, 1), paragraphs), tx.strip_tags)
        return (
            pages.withColumns({"_pairs": pairs, "_parts": parts})
            .select(
                "page_id",
                *[look(THUMB_LABELS[c]).alias(c) for c in ("rooms", "floor", "area_sqm", "availability_date")],
                F.coalesce(look(THUMB_LABELS["facilities"]).contains(THUMB_BALCONY), F.lit(False)).alias("has_balcony"),
                F.when(F.size("_parts") > 0, F.array_join("_parts", "\n\n")).alias("description"))
        )
    if layout != "card":
        raise ValueError(f"layout must be one of {LAYOUTS}")
    items = F.regexp_extract_all(page, F.lit(rf"(?s)(<dt\b[^>]*>{_ANY}*?</dt>\s*<dd\b[^>]*>{_ANY}*?</dd>)"), F.lit(1))
    pairs = _pairs(items, rf"(?s)<dt\b[^>]*>({_ANY}*?)</dt>", rf"(?s)<dd\b[^>]*>({_ANY}*?)</dd>")

    entries = F.regexp_extract_all(page, F.lit(rf"(?s)({_tag('li', CARD_ITEM)}{_ANY}*?</li>)"), F.lit(1))
    value = rf"(?s){_tag('span', CARD_ITEM_VALUE)}({_ANY}*?)</span>"
    entries = F.transform(entries, lambda x: F.struct(
        tx.strip_tags(x).alias("label"),
        F.when(x.rlike(value), tx.strip_tags(F.regexp_extract(x, value, 1))).alias("value")))

    def first(pairs: str, word: str) -> Column:
        return F.get(F.filter(pairs, lambda p: F.lower(p["label"]).contains(word)), F.lit(0))

    def look(field: str, word: str) -> Column:
        pair = first("_pairs", word)
        if field not in CARD_ITEM_FIELDS:
            return pair["value"]
        item = first("_items", word)
        return F.when(item.isNotNull(), item["value"]).otherwise(pair["value"])

    balcony = F.exists(
        "_pairs", lambda p: F.lower(p["label"]).contains(CARD_BALCONY) & p["markup"].contains("<svg"))
    description = F.regexp_extract_all(page, F.lit(rf"(?s){_tag('div', CARD_BODY)}({_ANY}*?)</div>"), F.lit(1))
    return (
        pages.withColumns({"_pairs": pairs, "_items": entries, "_text": F.get(description, F.lit(0))})
        .select(
            "page_id", *[look(c, word).alias(c) for c, word in CARD_LABELS.items()], balcony.alias("has_balcony"),
            tx.strip_tags(F.col("_text")).alias("description"))
    )


def extract_image_urls(pages: DataFrame, html: str, layout: str) -> DataFrame:
    """(page_id, image_urls): absolute URLs in page order; ``card`` pages
    drop repeats, ``thumb`` pages keep them."""
    page = F.col(html)
    if layout == "thumb":
        tags = F.regexp_extract_all(page, F.lit(
            rf'(?s)<figure\b[^>]*ImageObject"[^>]*>{_ANY}*?(<a\b[^>]*itemprop="contentUrl"[^>]*>)'), F.lit(1))
        links = F.transform(tags, lambda t: _attribute(t, "href"))
    elif layout == "card":
        tags = F.regexp_extract_all(page, F.lit(rf"(?s){_tag('div', CARD_SLIDE)}{_ANY}*?(<img\b[^>]*>)"), F.lit(1))
        links = F.transform(tags, lambda t: _attribute(t, "src"))
    else:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    links = F.filter(links, lambda u: u != "")
    return (
        pages.withColumn("_links", links)
        .withColumn("_urls", F.transform("_links", lambda u: _absolute(u, F.col("base_url"))))
        .select("page_id", (F.array_distinct("_urls") if layout == "card" else F.col("_urls")).alias("image_urls"))
    )


def page_outline(pages: DataFrame) -> DataFrame:
    """Title, number of links and paragraphs of any stored page."""
    page = F.col("html")
    return pages.select(
        "page_id", tx.strip_tags(F.regexp_extract(page, rf"(?s)<title[^>]*>({_ANY}*?)</title>", 1)).alias("title"),
        F.size(F.regexp_extract_all(page, F.lit(r'<a\b[^>]*[ ]href="([^"]*)"'), F.lit(1))).cast("bigint").alias("links"),
        F.size(F.regexp_extract_all(page, F.lit(rf"(?s)<p\b[^>]*>({_ANY}*?)</p>"), F.lit(1))).cast("bigint").alias("paragraphs"))
