"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

_text = T.StringType()

# Everything a feed sends as text stays text until the cleaning step casts it.
RAW_LISTING = T.StructType(
    [T.StructField(n, _text) for n in (
        "title", "address", "zip_code", "city", "region", "price", "rooms",
        "floor", "area_sqm", "availability_date", "description")]
    + [T.StructField("has_balcony", T.BooleanType()),
       T.StructField("image_urls", T.ArrayType(_text))]
)

CLEAN_LISTING = T.StructType([
    T.StructField("title", _text),
    T.StructField("address", _text),
    T.StructField("zip_code", T.IntegerType()),
    T.StructField("city", _text),
    T.StructField("region", _text),
    T.StructField("price", T.LongType()),
    T.StructField("rooms", T.DoubleType()),
    T.StructField("floor", T.IntegerType()),
    T.StructField("area_sqm", T.IntegerType()),
    T.StructField("availability_date", T.DateType()),
    T.StructField("has_balcony", T.BooleanType()),
    T.StructField("description", _text),
    T.StructField("image_urls", T.ArrayType(_text)),
    T.StructField("is_rental", T.BooleanType()),
])

POSTAL = T.StructType([
    T.StructField("ord", T.LongType()),
    T.StructField("zip_code", T.IntegerType()),
    T.StructField("city", _text),
    T.StructField("region", _text),
    T.StructField("city_clean", _text),
])

PROPERTY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", _text),
    T.StructField("address", _text),
    T.StructField("zip_code", T.IntegerType()),
    T.StructField("city", _text),
    T.StructField("region", _text),
    T.StructField("price", T.LongType()),
    T.StructField("rooms", T.DoubleType()),
    T.StructField("area_sqm", T.DoubleType()),
    T.StructField("floor", T.IntegerType()),
    T.StructField("availability_date", T.DateType()),
    T.StructField("has_balcony", T.BooleanType()),
    T.StructField("description", _text),
    T.StructField("is_rental", T.BooleanType()),
    T.StructField("is_new", T.BooleanType()),
    T.StructField("has_view", T.BooleanType()),
    T.StructField("has_garden", T.BooleanType()),
    T.StructField("has_parking", T.BooleanType()),
    T.StructField("has_air_conditioning", T.BooleanType()),
    # filled in after loading
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
LOADED_COLUMNS = tuple(f.name for f in PROPERTY if f.name not in ("latitude", "longitude"))
