"""The multi-filter listing explorer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_FILTERS = ("city", "region")
RANGE_FILTERS = ("price", "rooms", "area_sqm")
FLAG_FILTERS = ("is_rental", "has_balcony", "has_parking", "has_garden", "has_view", "has_air_conditioning")

MARK, CROSS = "✓", "✗"


def predicate(**filters) -> Column:
    """All given filters joined by AND.

    ``city`` and ``region`` are case-insensitive substrings (null rows fail);
    ``min_<column>`` / ``max_<column>`` of price, rooms and area_sqm are
    inclusive, and rows with null or 0 pass; flags are True or False (null
    rows fail).  ``None``, an empty text and a bound of 0 mean no filter.
    """
    known = {*TEXT_FILTERS, *FLAG_FILTERS, *(f"{side}_{c}" for c in RANGE_FILTERS for side in ("min", "max"))}
    if unknown := set(filters) - known:
        raise TypeError(f"unknown filters: {sorted(unknown)}")
    tests = []
    for name in TEXT_FILTERS:
        if filters.get(name):
            tests.append(F.lower(name).contains(filters[name].lower()))
    for name in RANGE_FILTERS:
        col, unset = F.col(name), F.col(name).isNull() | (F.col(name) == 0)
        if filters.get(f"min_{name}"):
            tests.append(unset | (col >= filters[f"min_{name}"]))
        if filters.get(f"max_{name}"):
            tests.append(unset | (col <= filters[f"max_{name}"]))
    for name in FLAG_FILTERS:
        if filters.get(name) is not None:
            tests.append(F.col(name) == F.lit(bool(filters[name])))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def explore(properties: DataFrame, **filters) -> DataFrame:
    """Listings that pass the filters."""
    return properties.where(predicate(**filters))


def explore_count(properties: DataFrame, **filters) -> DataFrame:
    """How many listings are shown, out of how many."""
    return properties.agg(
        F.count_if(predicate(**filters)).alias("shown"), F.count(F.lit(1)).alias("total"))


def explore_display(properties: DataFrame) -> DataFrame:
    """The 18 columns of the result table as they are shown."""
    def mark(flag: str) -> Column:
        return F.when(F.col(flag), MARK).otherwise(CROSS).alias(flag)

    price = F.when(
        F.col("price") != 0, F.concat(F.lit("CHF "), F.format_number("price", 0))).otherwise("-")
    available = F.coalesce(F.date_format("availability_date", "M/d/yyyy"), F.lit("-"))
    return properties.select(
        "id", "title", "address", "zip_code", "city", "region", price.alias("price"), "rooms",
        "area_sqm", "floor", available.alias("availability_date"),
        *[mark(f) for f in ("has_balcony", "is_rental", "is_new", "has_view", "has_garden",
                            "has_parking", "has_air_conditioning")],
    )
