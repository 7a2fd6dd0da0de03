"""Coordinates and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmill import vocab
from listingmill.functions import text as tx

BOX_CELL = 0.1  # degrees


def missing_coordinates(properties: DataFrame) -> DataFrame:
    """Listings without latitude or longitude."""
    return (
        properties.where(F.col("latitude").isNull() | F.col("longitude").isNull())
        .select("id", "address", "zip_code", "city")
    )


def _full_address(street: Column) -> Column:
    return F.concat(
        street, F.lit(", "), F.coalesce(F.col("zip_code").cast("string"), F.lit("None")), F.lit(" "),
        F.coalesce("city", F.lit("None")), F.lit(f", {vocab.COUNTRY}"))


def compose_address(df: DataFrame) -> DataFrame:
    """``full_address`` for a gazetteer: noise words leave the street, zip,
    town and country follow."""
    noise = "(?iu)" + tx.NOT_AFTER_WORD + "(?:" + "|".join(vocab.ADDRESS_NOISE) + ")" + tx.NOT_BEFORE_WORD
    return df.withColumn("full_address", _full_address(tx.trim_ws(F.regexp_replace("address", noise, ""))))


def _gazetteer(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """One row per address: the primary entry if there is one with both coordinates, else the fallback; of several
    entries in one table the southernmost."""
    entries = primary.select("full_address", "latitude", "longitude", F.lit(1).alias("rank")).unionByName(
        fallback.select("full_address", "latitude", "longitude", F.lit(2).alias("rank")))
    return (
        entries.dropna(subset=["full_address", "latitude", "longitude"])
        .groupBy("full_address")
        .agg(F.min(F.struct("rank", "latitude", "longitude")).alias("hit"))
        .select("full_address", F.col("hit.latitude").alias("_lat"), F.col("hit.longitude").alias("_lon"))
    )


def geocode_backfill(properties: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Coordinates of listings that lack them, from two address tables.

    Listings with coordinates pass by the join.
    """
    gap = F.col("latitude").isNull() | F.col("longitude").isNull()
    found = (
        compose_address(properties.where(gap))
        .join(_gazetteer(primary, fallback), "full_address", "left")
        .withColumns({
            "latitude": F.when(F.col("_lat").isNotNull(), F.col("_lat")).otherwise(F.col("latitude")),
            "longitude": F.when(F.col("_lat").isNotNull(), F.col("_lon")).otherwise(F.col("longitude")),
        })
    )
    return properties.where(~gap).unionByName(found.select(properties.columns))


def geocode_failures(properties: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Listings neither table resolves: id and the address as it was given."""
    known = _gazetteer(primary, fallback).select("full_address")
    return (
        compose_address(missing_coordinates(properties))
        .join(known, "full_address", "left_anti")
        .select(F.col("id").alias("ID"), _full_address(F.coalesce("address", F.lit("None"))).alias("Adresse"))
    )


def update_coordinates(properties: DataFrame, updates: DataFrame) -> DataFrame:
    """Overwrite coordinates by equal address.

    All listings of an address change; of several updates the last one (by
    ``ordinal``) wins, also when it holds nulls.
    """
    last = (
        updates.where(F.col("address").isNotNull())
        .groupBy(F.col("address").alias("_address"))
        .agg(F.max_by(F.struct("latitude", "longitude"), "ordinal").alias("_new"))
    )
    hit = F.col("_address").isNotNull()
    return (
        properties.join(last, F.col("address") == F.col("_address"), "left")
        .withColumns({
            "latitude": F.when(hit, F.col("_new.latitude")).otherwise(F.col("latitude")),
            "longitude": F.when(hit, F.col("_new.longitude")).otherwise(F.col("longitude")),
        })
        .drop("_address", "_new")
    )


def expand_bbox(places: DataFrame, margin: float = 0.05) -> DataFrame:
    """Bounding boxes grown by a share of their span on each side, with the
    encoded search text of the place."""
    lat, lon = F.col("north") - F.col("south"), F.col("east") - F.col("west")
    label = F.concat(F.col("city"), F.lit(", "), F.coalesce("region", F.lit("")), F.lit(f", {vocab.COUNTRY}"))
    # url_encode is for forms: blanks become "+", and a slash is not kept.
    encoded = F.replace(F.replace(F.replace(
        F.url_encode(label), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~"))
    return places.withColumns({
        "s": F.col("south") - lat * margin, "n": F.col("north") + lat * margin,
        "w": F.col("west") - lon * margin, "e": F.col("east") + lon * margin,
        "place_name": F.replace(encoded, F.lit("*"), F.lit("%2A")),
    })


def listings_in_bbox(properties: DataFrame, boxes: DataFrame, cell: float = BOX_CELL) -> DataFrame:
    """Listings inside each expanded box: (place_id, id).

    Boxes are laid out on a grid of ``cell`` degrees and meet only the
    listings of their cells; the four bounds are tested after that equi join.
    """
    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))

    cells = boxes.select("place_id", "s", "n", "w", "e", span("s", "n").alias("cy"))
    cells = cells.select("*", span("w", "e").alias("cx"))
    points = (
        properties.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select("id", "latitude", "longitude", F.floor(F.col("latitude") / cell).alias("cy"),
                F.floor(F.col("longitude") / cell).alias("cx"))
    )
    inside = F.col("latitude").between(F.col("s"), F.col("n")) & F.col("longitude").between(F.col("w"), F.col("e"))
    return points.join(cells, ["cy", "cx"]).where(inside).select("place_id", "id")


def map_points(properties: DataFrame) -> DataFrame:
    """Map markers: listings with real coordinates and what their pop-up shows."""
    return (
        properties.where((F.col("latitude") != 0) & (F.col("longitude") != 0))
        .select(
            "id", "latitude", "longitude", "title",
            F.concat(F.coalesce("address", F.lit("")), F.lit(", "), F.coalesce("city", F.lit(""))).alias("place"),
            F.round(F.col("price").cast("double"), 0).cast("bigint").alias("price"), "rooms", "has_balcony",
            F.get("image_urls", F.lit(0)).alias("image"))
    )
