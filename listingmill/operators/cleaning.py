"""Cleaning rules: each takes a listing DataFrame and returns one.

Everything is a column expression, except for the gazetteer look-ups (equi
joins on zip or city, and one automaton of all place names that reads texts)
and the price bands (an aggregate per region and area).  A join that only concerns rows with a gap
gets a null key for all other rows, or only sees the rows with a gap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmill import vocab
from listingmill.functions import text as tx
from listingmill.functions.relational import scattered
from listingmill.sources.workspace import stage

REQUIRED = ("price", "address", "rooms", "floor", "area_sqm", "availability_date", "description")


# --- types and dates --------------------------------------------------------

def normalise_types(df: DataFrame) -> DataFrame:
    """Text rooms, area and price to numbers; what cannot be read becomes null.

    ``3 ½`` is 3.5; the area is the first run of two to five digits.
    """
    return df.withColumns({
        "rooms": tx.number(F.replace("rooms", F.lit(" ½"), F.lit(".5"))),
        "area_sqm": F.regexp_substr("area_sqm", F.lit("[0-9]{2,5}")).try_cast("int"),
        "price": tx.whole_number(F.col("price")),
    })


def parse_availability(df: DataFrame, run_date: str) -> DataFrame:
    """Availability words relative to ``run_date``, else an ISO or dd.MM.yyyy date."""
    raw, today = F.col("availability_date"), F.lit(run_date).cast("date")
    return df.withColumn(
        "availability_date",
        F.when(raw.isin(*vocab.AVAILABLE_NOW), today)
        .when(raw.isin(*vocab.AVAILABLE_ON_AGREEMENT), F.date_add(today, vocab.AGREEMENT_DELAY_DAYS))
        .otherwise(F.coalesce(
            F.try_to_date(raw, "yyyy-MM-dd"),
            F.try_to_date(F.when(raw.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T"), F.substring(raw, 1, 10)), "yyyy-MM-dd"),
            F.try_to_date(raw, "dd.MM.yyyy"),
        )),
    )


# --- floor and rooms --------------------------------------------------------

def resolve_floor(df: DataFrame, strict: bool = False) -> DataFrame:
    """Floor from its text, then title, then description, each only for the gaps.

    Word tests are substring tests (``eg`` fires inside ``gelegen``);
    ``strict`` asks for whole words.
    """
    def has(text: Column, words: Sequence[str]) -> Column:
        return tx.contains_any(text, words, whole_words=strict)

    given, title, desc = F.col("_given"), F.col("_title"), F.col("_desc")
    level = tx.extract(
        desc,
        rf"([0-9](?<!{tx.WORD}[0-9])[0-9]?)\." + tx.SPACE + "*(?:" + "|".join(vocab.LEVEL_WORDS) + ")",
    ).try_cast("int")
    from_text = (
        F.when(has(given, vocab.FLOOR_BASEMENT), -1)
        .when(has(given, vocab.FLOOR_GROUND), 0)
        .otherwise(F.regexp_substr(given, F.lit("-?[0-9]+")).try_cast("int"))
    )
    from_description = (
        F.when(has(desc, vocab.DESC_GROUND), 0)
        .when(has(desc, vocab.DESC_BASEMENT), -1)
        .when(has(desc, ("studio",)), 1)
        .otherwise(level)
    )
    return (
        df.withColumns({
            "_given": F.lower(tx.trim_ws(F.col("floor"))),
            "_title": F.lower("title"),
            "_desc": F.lower("description"),
        })
        .withColumn("floor", F.coalesce(
            from_text,
            F.when(has(title, vocab.TITLE_HOUSE), 0),
            from_description,
            F.when(has(title, vocab.TITLE_SHOP), 0),
        ))
        .drop("_given", "_title", "_desc")
    )


def resolve_rooms(df: DataFrame) -> DataFrame:
    """One room where none is given and the listing is a studio or business space."""
    single = (
        tx.contains_any(F.col("_title"), vocab.SINGLE_ROOM_TITLE)
        | tx.contains_any(F.lower("description"), ("studio",))
    )
    return (
        df.withColumn("_title", F.lower("title"))
        .withColumn("rooms", F.coalesce("rooms", F.when(single, 1.0)))
        .drop("_title")
    )


# --- location ---------------------------------------------------------------

def zip_city_from_text(df: DataFrame) -> DataFrame:
    """Missing zip and city from the description: the first stand-alone
    four-digit number, and up to three capitalised words after ``in``."""
    desc = F.col("description")
    # A digit first, the look-behind second: most positions fail at once.
    zip_text = F.regexp_substr(
        desc, F.lit(rf"[0-9](?<!{tx.WORD}[0-9])[0-9]{{3}}" + tx.NOT_BEFORE_WORD))
    after_in = tx.extract(
        F.when(F.col("city").isNull(), desc),
        r"in[\s\p{Z}]+((?:[A-ZÄÖÜ][\p{L}\p{N}_\-.]+(?:[\s\p{Z}]+|$)){1,3})")
    verbs = "|".join(vocab.CITY_TRAILING_VERBS)
    city = tx.trim_ws(F.regexp_replace(
        tx.trim_ws(after_in), rf"(?i)[\s\p{{Z}}]+(?:{verbs}){tx.NOT_BEFORE_WORD}[^\n]*", ""))
    return (
        df.withColumn("_city", city)
        .withColumns({
            "zip_code": tx.whole_number(F.coalesce("zip_code", zip_text)).try_cast("int"),
            "city": F.coalesce("city", F.nullif("_city", F.lit(""))),
        })
        .drop("_city")
    )


#: A gazetteer of this many bytes of names is broadcast as one automaton; a larger one is joined.
AUTOMATON_BYTES = 16 << 20


def _names(postal: DataFrame) -> DataFrame:
    """(place, name): the distinct places and their lower-case names."""
    places = postal.where(F.col("city").isNotNull() & (F.col("city") != "")).select(F.col("city").alias("place")).distinct()
    return places.withColumn("name", F.lower("place"))


def places_in_text(texts: DataFrame, postal: DataFrame, key: str, text: str, most_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Longest gazetteer name found anywhere in a text: (key, place).

    All names are one automaton that reads each text once, whatever their
    number.  Each worker builds it once from the names, which are broadcast
    after their bytes are counted; more than ``most_bytes`` of names meet the
    texts in a join instead.  Equal lengths are settled by name.
    """
    names = _names(postal)
    if names.agg(F.coalesce(F.sum(F.octet_length("place")), F.lit(0))).first()[0] > most_bytes:
        found = _places_by_join(texts, names, key, text)
    else:
        rows = texts.where(F.col(text).isNotNull()).select(key, F.lower(text).alias("_text"))
        found = rows.mapInArrow(_searcher(names, key), f"`{key}` {dict(rows.dtypes)[key]}, place string")
    return found.groupBy(key).agg(F.max_by("place", F.struct(F.length("place"), F.col("place"))).alias("place"))


def _searcher(names: DataFrame, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps of each text the longest place whose name is in it."""
    shared = names.sparkSession.sparkContext.broadcast({"names": [(r["name"], r["place"]) for r in names.collect()]})  # size checked

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "automaton" not in held:  # a worker keeps the value for its later tasks: names and tasks both grow with the listings
            import ahocorasick
            automaton = ahocorasick.Automaton()
            for name, place in sorted(held["names"], key=lambda x: (len(x[1]), x[1])):  # of one name the longest place stays
                automaton.add_word(name, (len(place), place))
            automaton.make_automaton()
            held["automaton"] = automaton
        automaton = held["automaton"]
        if not len(automaton):
            return
        for batch in batches:
            best = [max((hit for _, hit in automaton.iter(x.as_py())), default=None) for x in batch.column("_text")]
            found = pa.array([x is not None for x in best])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).filter(found), pa.array([x[1] for x in best if x], pa.string())], names=[key, "place"])

    return search


def _places_by_join(texts: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    """All names found in the texts: (key, place), some more than once.

    A text is cut into its overlapping windows, one per position and as long as
    the longest name.  A window whose first letters begin some name is cut to
    the lengths such names have, and these cuts meet the names whole (equi
    joins both; the first table has one row for each beginning, so a frequent
    one meets no list of names).
    """
    names = names.withColumn("head", F.substring("name", 1, 4))
    longest = names.agg(F.coalesce(F.max(F.length("name")), F.lit(1)).cast("string")).scalar()
    head_lengths = names.agg(F.collect_set(F.length("head"))).scalar()  # at most 1, 2, 3, 4
    windows = F.array_distinct(F.regexp_extract_all(
        F.lower(text), F.concat(F.lit("(?s)(?=(.{1,"), longest, F.lit("}))")), F.lit(1)))
    probes = (
        texts.where(F.col(text).isNotNull())
        .select(key, F.explode(windows).alias("window"))
        .withColumn("n", head_lengths)
        .select(key, "window", F.explode("n").alias("n"))
        .withColumn("head", F.col("window").substr(F.lit(1), F.col("n")))
    )
    heads = names.groupBy("head").agg(F.collect_set(F.length("name")).alias("lengths"))
    cuts = (
        probes.join(heads, "head").select(key, "window", F.explode("lengths").alias("size"))
        .where(F.length("window") >= F.col("size"))
        .select(key, F.col("window").substr(F.lit(1), F.col("size")).alias("name"))
    )
    return cuts.join(names.select("name", "place"), "name").select(key, "place")


def city_from_gazetteer(df: DataFrame, postal: DataFrame, key: str = "src_id",
                        found: DataFrame | None = None) -> DataFrame:
    """Missing city from the longest known place name inside the description.

    Only listings with a gap are searched and joined; ``found`` may hand in a
    stored result of :func:`places_in_text`.
    """
    gap = F.col("city").isNull() & F.col("description").isNotNull()
    open_rows = df.where(gap)
    if found is None:
        found = places_in_text(open_rows, postal, key, "description")
    filled = open_rows.join(found, key, "left").withColumn("city", F.col("place")).drop("place")
    return df.where(~gap).unionByName(filled.select(df.columns))


def validate_zip(df: DataFrame, postal: DataFrame) -> DataFrame:
    """Zips that are not in the gazetteer become null.

    The distinct zips are stored: they are few however large the gazetteer is, which the planner only sees from their files."""
    known = stage(
        postal.where(F.col("zip_code").isNotNull())
        .select(F.col("zip_code").alias("_zip")).distinct(), "known-zips")
    given = F.col("zip_code")
    return (
        df.join(known, _spread(df, given, negative=True) == F.col("_zip"), "left")
        .withColumn("zip_code", F.when(given.isNotNull(), F.col("_zip"))).drop("_zip")
    )


def normalise_region(df: DataFrame) -> DataFrame:
    """Upper-case canton code; anything longer than two characters becomes null."""
    code = tx.trim_ws(F.col("region"))
    return df.withColumn("region", F.when(F.length(code) <= 2, F.upper(code)))


def postal_rollup(postal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First zip and region per city, first city and region per zip, in file order."""
    def first(column: str) -> Column:
        order = F.when(F.col(column).isNotNull(), F.col("ord"))
        return F.min_by(column, order).alias(column)

    by_city = (
        postal.where(F.col("city_clean").isNotNull())
        .groupBy("city_clean").agg(first("zip_code"), first("region"))
    )
    by_zip = (
        postal.where(F.col("zip_code").isNotNull())
        .groupBy("zip_code").agg(first("city_clean"), first("region"))
    )
    return by_city, by_zip


def _spread(df: DataFrame, wanted: Column, negative: bool = False) -> Column:
    """A join key for a look-up: rows that look nothing up get keys that no table has, all over the partitions, as equal
    or null keys would meet in one."""
    draw = F.pmod(scattered(df), F.lit(1_000_000)).cast("int")
    return F.coalesce(wanted, -1 - draw if negative else F.concat(F.lit("\u0000"), draw.cast("string")))


def backfill_location(df: DataFrame, postal: DataFrame) -> DataFrame:
    """Fill zip and region from the city, then city and region from the zip.

    Both look-up tables are stored, so that the planner knows their size when it picks the joins."""
    by_city, by_zip = (stage(x, "postal-rollup") for x in postal_rollup(postal))
    by_city = by_city.select(
        F.col("city_clean").alias("_city"), F.col("zip_code").alias("_zip"), F.col("region").alias("_region"))
    by_zip = by_zip.select(
        F.col("zip_code").alias("_zip"), F.col("city_clean").alias("_city"), F.col("region").alias("_region"))
    gap = F.col("zip_code").isNull() | F.col("region").isNull()
    city_key = _spread(df, F.when(gap, F.lower(tx.trim_ws(F.col("city")))))
    from_city = (
        df.join(by_city, city_key == F.col("_city"), "left")
        .withColumns({
            "zip_code": F.coalesce("zip_code", "_zip"),
            "region": F.coalesce("region", "_region"),
        }).drop("_city", "_zip", "_region")
    )
    gap = F.col("city").isNull() | F.col("region").isNull()
    return (
        from_city.join(by_zip, _spread(from_city, F.when(gap, F.col("zip_code")), negative=True) == F.col("_zip"), "left")
        .withColumns({
            "city": F.coalesce("city", tx.title_case(F.col("_city"))),
            "region": F.coalesce("region", "_region"),
        }).drop("_city", "_zip", "_region")
    )


# --- area and price ---------------------------------------------------------

def area_from_text(df: DataFrame) -> DataFrame:
    """Missing area from two to four digits in front of a square-metre unit."""
    found = tx.extract(
        F.lower("description"), "([0-9]{2,4})" + tx.SPACE + "*(?:" + "|".join(vocab.AREA_UNITS) + ")")
    return df.withColumn("area_sqm", F.coalesce("area_sqm", found.try_cast("int")))


def price_bands(df: DataFrame, band: int = 10) -> DataFrame:
    """Estimated price per (region, area): truncated mean of the listings of
    the region whose area is within ``band``.

    Prices are summed per region and area first; only these sums are spread
    over the neighbouring areas.  No task ever holds a region's listings.
    """
    sums = (
        df.where(F.col("price").isNotNull() & F.col("area_sqm").isNotNull() & F.col("region").isNotNull())
        .groupBy("region", "area_sqm")
        .agg(F.sum(F.col("price").cast("decimal(19,0)")).alias("total"), F.count(F.lit(1)).alias("n"))
    )
    area = F.col("area_sqm")
    return (
        sums.withColumn("near", F.explode(F.sequence(area - band, area + band)))
        .groupBy("region", F.col("near").alias("area_sqm"))
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select("region", "area_sqm",
                (F.col("total").cast("double") / F.col("n")).cast("bigint").alias("estimate"))
    )


def impute_price(df: DataFrame, band: int = 10, bands: DataFrame | None = None) -> DataFrame:
    """Missing price from the band of its region and area; no band leaves it null.

    Bands come from the listings before imputation; ``bands`` may hand in a
    stored result of :func:`price_bands`.
    """
    if bands is None:
        bands = price_bands(df, band)
    bands = bands.select(F.col("region").alias("_region"), F.col("area_sqm").alias("_area"), "estimate")
    gap = F.col("price").isNull()
    return (
        df.join(bands, (_spread(df, F.when(gap, F.col("region"))) == F.col("_region"))
                & (F.when(gap, F.col("area_sqm")) == F.col("_area")), "left")
        .withColumn("price", F.coalesce("price", "estimate"))
        .drop("_region", "_area", "estimate")
    )


# --- final filters and labels -----------------------------------------------

def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep listings that have all the fields a price model cannot do without."""
    return df.dropna(subset=list(REQUIRED))


def classify_rental(df: DataFrame) -> DataFrame:
    """Rental words first, then sale words, else the price decides."""
    text = F.col("_text")
    return (
        df.withColumn("_text", F.lower(F.concat_ws(" ", "title", "description")))
        .withColumn(
            "is_rental",
            F.when(tx.contains_any(text, vocab.RENTAL_WORDS), True)
            .when(tx.contains_any(text, vocab.SALE_WORDS), False)
            .otherwise(F.col("price") < vocab.RENTAL_PRICE_LIMIT))
        .drop("_text")
    )


def default_title(df: DataFrame) -> DataFrame:
    """A missing title becomes ``Rental`` or ``Property``."""
    return df.withColumn("title", F.coalesce(
        "title", F.when(F.col("is_rental"), "Rental").when(~F.col("is_rental"), "Property")))


def amenity_flags(df: DataFrame) -> DataFrame:
    """Five booleans: does a white-space token of the description equal a synonym.

    Synonyms with a blank can never equal a token, and punctuation sticks to
    its token; both are part of the rule.
    """
    found = F.col("_tokens")
    known = F.array_distinct(F.array(*[F.lit(s) for synonyms in vocab.AMENITIES.values() for s in synonyms]))
    return (
        # one pass over a text's tokens; the flags then look at the few synonyms among them
        df.withColumn("_tokens", F.array_intersect(tx.tokens(F.col("description")), known))
        .withColumns({
            flag: F.coalesce(F.arrays_overlap(found, F.array(*map(F.lit, synonyms))), F.lit(False))
            for flag, synonyms in vocab.AMENITIES.items()
        })
        .drop("_tokens")
    )


# --- duplicates and quality -------------------------------------------------

EXACT_KEY = ("title", "address", "zip_code", "city", "price", "rooms", "area_sqm", "floor", "description")


def _digest(near: bool) -> Column:
    if near:
        words = F.array_sort(F.array_distinct(tx.words(F.concat_ws(" ", "title", "description"))))
        parts = F.struct(F.lower("address").alias("address"), "rooms", "area_sqm", "floor", "price", words.alias("words"))
    else:
        parts = F.struct(*EXACT_KEY)
    return F.sha2(F.to_json(parts), 256)


def duplicates(df: DataFrame, key: str = "src_id", near: bool = False) -> DataFrame:
    """Keys of all listings but the first (lowest key) of every group of equal ones.

    Listings are equal when all of ``EXACT_KEY`` agree.  With ``near``, when
    they advertise the same object (address, rooms, area, floor, price) with
    the same set of words, whatever their order, case or punctuation.
    Only digests and keys are shuffled, the first key of a digest found before
    the shuffle; the others are the keys that are no first one, so no join has
    a digest as its key and a group of copies may be of any size.
    """
    firsts = df.select(key, _digest(near).alias("_digest")).groupBy("_digest").agg(F.min(key).alias(key))
    return df.select(key).join(firsts.select(key), key, "left_anti")


def dedup_listings(df: DataFrame, key: str = "src_id", near: bool = False,
                   dropped: DataFrame | None = None) -> DataFrame:
    """Listings without their :func:`duplicates`; ``dropped`` may hand in a
    stored result, whose size then decides how it is joined."""
    if dropped is None:
        dropped = duplicates(df, key, near)
    return df.join(dropped, key, "left_anti")


def quality_report(df: DataFrame, minimum: int = 1000) -> DataFrame:
    """Violations of the documented value ranges, one row per rule.

    The last rule counts the listings that are missing to the wanted minimum.
    """
    rules = {
        "zip_code between 1000 and 9999": ~F.col("zip_code").between(1000, 9999),
        "price above 0": F.col("price") <= 0,
        "rooms between 0.5 and 10": ~F.col("rooms").between(0.5, 10.0),
        "floor not below 0": F.col("floor") < 0,
        "area above 0": F.col("area_sqm") <= 0,
    }
    names = [*rules, f"at least {minimum} distinct listings"]
    digest = F.xxhash64(*EXACT_KEY)
    counts = [F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())]
    missing = F.greatest(F.lit(minimum) - F.count_distinct(digest), F.lit(0)).alias(f"r{len(rules)}")
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(names))
    return df.agg(*counts, missing).select(F.expr(f"stack({len(names)}, {pairs}) as (rule, violations)"))
