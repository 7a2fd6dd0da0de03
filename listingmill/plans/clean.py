"""The whole cleaning job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmill.operators import cleaning as cl
from listingmill.sources.workspace import stage


def clean_listings(raw: DataFrame, postal: DataFrame, run_date: str, key: str = "src_id") -> DataFrame:
    """Raw listings to clean records, rule by rule in the documented order.

    Two small results are stored on the way (places found in descriptions,
    price bands): they depend on a scan of their own, and once stored the
    planner knows their size when it picks the join.  The rows are stored
    before the bands, which would otherwise run all text rules a second time.
    """
    located = cl.zip_city_from_text(cl.resolve_rooms(cl.resolve_floor(
        cl.parse_availability(cl.normalise_types(raw), run_date))))
    # The search only needs the city rule, so it reads three columns.
    gaps = cl.zip_city_from_text(raw.select(key, "zip_code", "city", "description")).where(F.col("city").isNull())
    found = stage(cl.places_in_text(gaps, postal, key, "description"), "places")
    located = cl.city_from_gazetteer(located, postal, key, found)
    located = cl.backfill_location(cl.normalise_region(cl.validate_zip(located, postal)), postal)
    sized = stage(cl.area_from_text(located), "sized")
    bands = stage(cl.price_bands(sized), "price-bands")
    priced = cl.impute_price(sized, bands=bands)
    return cl.default_title(cl.classify_rental(cl.drop_incomplete(priced)))
