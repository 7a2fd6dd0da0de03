"""Listing feeds, the postal gazetteer and the cleaned-records file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingmill.functions import text as tx
from listingmill.schemas import CLEAN_LISTING, RAW_LISTING
from listingmill.sources.workspace import stage


def read_feeds(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Every JSON feed under ``path`` as one table; absent columns are null.

    ``multiline`` reads files that hold one JSON array.  Such a file is one
    task; feeds of JSON lines (``multiline=False``) are split.  Large arrays are
    split by ``arrays.read_json_arrays``.
    """
    return (
        spark.read.schema(RAW_LISTING)
        .option("multiLine", multiline).option("recursiveFileLookup", True)
        .json(path)
    )


def number_rows(feeds: DataFrame, key: str = "src_id") -> DataFrame:
    """The rows with a unique running number 1..n.

    Rows are stored with their place inside their partition; the partitions'
    sizes - one row for each input split - give what comes before.
    """
    spark_bits = 33  # where the place ends and the partition begins
    stored = stage(feeds.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", spark_bits)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        stored.join(F.broadcast(starts), part == F.col("_part"))
        .withColumn(key, F.col("_start") + F.col("_at").bitwiseAND((1 << spark_bits) - 1) + 1)
        .drop("_at", "_part", "_start")
    )


def shape_postal(raw: DataFrame, zip_code: str, city: str, region: str, order: Column) -> DataFrame:
    """Postal columns with the types and spellings the look-ups need."""
    return raw.select(
        order.cast("bigint").alias("ord"),
        tx.whole_number(F.col(f"`{zip_code}`")).try_cast("int").alias("zip_code"),
        F.col(f"`{city}`").alias("city"),
        F.upper(tx.trim_ws(F.col(f"`{region}`"))).alias("region"),
        F.lower(tx.trim_ws(F.col(f"`{city}`"))).alias("city_clean"),
    )


def read_postal(spark: SparkSession, path: str) -> DataFrame:
    """The ``;``-separated gazetteer: header cleaned of BOM and blanks, zips as
    numbers, file order kept in ``ord``."""
    raw = spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*[c.replace("﻿", "").strip() for c in raw.columns])
    return shape_postal(raw, "PLZ", "Ortschaftsname", "Kantonskürzel", F.monotonically_increasing_id())


def write_clean(df: DataFrame, path: str, compression: str = "none") -> None:
    """Cleaned listings as JSON records with ISO dates."""
    (df.select([f.name for f in CLEAN_LISTING])
       .write.mode("overwrite").option("compression", compression).option("ignoreNullFields", False).option("dateFormat", "yyyy-MM-dd").json(path))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLEAN_LISTING).option("dateFormat", "yyyy-MM-dd").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
