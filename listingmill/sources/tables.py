"""The property and image tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmill.functions.relational import dense_ids
from listingmill.operators.cleaning import amenity_flags
from listingmill.schemas import LOADED_COLUMNS, PROPERTY
from listingmill.sources.workspace import stage


def load_properties(clean: DataFrame, key: str = "src_id") -> DataFrame:
    """Cleaned listings as rows of the property table.

    Area and rooms become doubles with 0 as null, the amenity flags are added,
    and ids count 1..n in ``key`` order (a unique running number), whatever the
    layout of the data.
    """
    def positive(column: str):
        return F.nullif(F.col(column).cast("double"), F.lit(0.0))

    rows = amenity_flags(clean.withColumns({"area_sqm": positive("area_sqm"), "rooms": positive("rooms")}))
    # stored first: the ranges are sampled and then dealt, and either would split all descriptions into tokens again
    numbered = dense_ids(stage(rows, "flagged"), [key])
    extra = [c for c in ("image_urls", "latitude", "longitude", key) if c in clean.columns]
    return numbered.select(*LOADED_COLUMNS, *extra)


def explode_images(properties: DataFrame) -> DataFrame:
    """One row per image URL with the id of its property; ids count 1..n in
    property and list order."""
    urls = properties.select(
        F.col("id").alias("property_id"), F.posexplode("image_urls").alias("pos", "url"))
    numbered = dense_ids(urls, ["property_id", "pos"])
    return numbered.select("id", "property_id", "url")


def orphan_images(images: DataFrame, properties: DataFrame) -> DataFrame:
    """Images whose property does not exist."""
    return images.join(properties.select(F.col("id").alias("property_id")), "property_id", "left_anti")


def save_table(df: DataFrame, path: str) -> None:
    """Parquet split by kind of listing, so that a rental query skips the sales."""
    df.write.mode("overwrite").partitionBy("is_rental").parquet(path)


def scan_properties(spark: SparkSession, path: str | None = None, table: str | None = None,
                    jdbc: dict[str, str] | None = None) -> DataFrame:
    """All rows and columns of the stored properties: Parquet files, a catalog
    table or a database.  Later filters and projections reach the source; a
    database is read in parallel when ``jdbc`` names ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions``."""
    if jdbc is not None:
        return spark.read.format("jdbc").options(**{"dbtable": "properties", **jdbc}).load()
    if table is not None:
        return spark.table(table)
    return spark.read.schema(PROPERTY).parquet(path)


def scan_images(images: DataFrame) -> DataFrame:
    """The two key columns of the image table."""
    return images.select("id", "property_id")
