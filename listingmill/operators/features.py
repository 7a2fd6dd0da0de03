"""Model features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, time

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingmill import vocab
from listingmill.functions import relational as rel
from listingmill.functions import text as tx
from listingmill.sources.workspace import stage

MODES = ("rental", "purchase")
TEXT_COLUMNS = ("title", "address", "availability_date", "description", "image_urls", "id")
COMPLETE_FOR_BOOSTING = (
    "rooms", "area_sqm", "floor", "zip_code", "city", "region", "has_balcony", "longitude", "latitude")


def _flag(test: Column) -> Column:
    """1 where the test holds, 0 where it fails or is null."""
    return F.coalesce(test, F.lit(False)).cast("int")


# --- row selection ----------------------------------------------------------

def mode_filter(df: DataFrame, mode: str) -> DataFrame:
    """Rental: price below 10,000; purchase: price above 80,000.  By price alone."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return df.where(F.col("price") < 10_000 if mode == "rental" else F.col("price") > 80_000)


def exclude_commercial(df: DataFrame) -> DataFrame:
    """Drop listings with a business word in title or description; null text stays."""
    return (
        df.withColumns({"_title": F.lower("title"), "_desc": F.lower("description")})
        .where(~tx.contains_any(F.col("_title"), vocab.COMMERCIAL_WORDS)
               & ~tx.contains_any(F.col("_desc"), vocab.COMMERCIAL_WORDS))
        .drop("_title", "_desc")
    )


def bounds_filter(df: DataFrame) -> DataFrame:
    """Plausible price and area, and none of the model's inputs missing."""
    price, area = F.col("price"), F.col("area_sqm")
    return (
        df.where((price > 200) & (price < 10_000_000) & (area > 10) & (area < 1000))
        .dropna(subset=list(COMPLETE_FOR_BOOSTING))
    )


def price_split(df: DataFrame, limit: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """Rental side (price up to the limit) and purchase side (above)."""
    return df.where(F.col("price") <= limit), df.where(F.col("price") > limit)


# --- columns ----------------------------------------------------------------

def availability_features(df: DataFrame, run_ts: str, fill: int | None = None) -> DataFrame:
    """Whole days until available, counted down from ``run_ts`` (a date equal
    to today is day -1 for any time of day after midnight), and a flag for
    within 30 days.  Without a date the days are null and the flag 0; ``fill``
    puts a number of days in place first."""
    now = datetime.fromisoformat(run_ts)
    # Calendar days, so that neither time zone nor daylight saving counts; any
    # time after midnight has used up part of the first day.
    started = int(now.time() != time.min)
    days = (F.datediff("availability_date", F.lit(now.date())) - started).cast("bigint")
    if fill is not None:
        days = F.coalesce(days, F.lit(fill))
    return (
        df.withColumn("availability_days_from_now", days)
        .withColumn("availability_soon", _flag(F.col("availability_days_from_now") <= 30))
    )


def size_floor_flags(df: DataFrame) -> DataFrame:
    """Log area, size and floor flags, booleans as 0/1.  A boolean column that
    is absent counts as false (``is_rental`` as true)."""
    area, floor = F.col("area_sqm"), F.col("floor")

    def as_int(name: str, default: bool) -> Column:
        return _flag(F.col(name)) if name in df.columns else F.lit(int(default))

    flags = {name: as_int(name, name == "is_rental") for name in
             ("has_balcony", "is_rental", "is_new", "has_view", "has_garden", "has_parking",
              "has_air_conditioning")}
    return df.withColumns({
        "log_area_sqm": F.log1p(area.cast("double")),
        "is_small": _flag(area < 30),
        "is_large": _flag(area > 80),
        "is_ground_floor": _flag(floor <= 0),
        "is_top_floor": _flag(floor > 4),
        **flags,
    })


def bin_edges(df: DataFrame, columns: Sequence[str] = ("latitude", "longitude")) -> dict[str, tuple[float, float]]:
    """Lowest and highest value per column: what serving needs to bin like training."""
    row = df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"{c}_lo"], row[f"{c}_hi"]) for c in columns}


def geo_bins(df: DataFrame, edges: Mapping[str, tuple[float, float]] | None = None, bins: int = 10) -> DataFrame:
    """``lat_bin`` and ``lon_bin``: equal-width bins 0-9, closed on the right.

    Without ``edges`` the range of ``df`` itself is used (a scalar subquery,
    not a join); stored edges bin new rows like the training rows, and values
    outside fall into the first or last bin.
    """
    out = {}
    for column, name in (("latitude", "lat_bin"), ("longitude", "lon_bin")):
        value = F.col(column)
        if edges is None:
            lo = df.agg(F.min(column)).scalar()
            hi = df.agg(F.max(column)).scalar()
        else:
            lo, hi = (F.lit(float(e)) for e in edges[column])
        position = F.ceil(F.try_divide(F.lit(float(bins)) * (value - lo), hi - lo)) - 1
        # One single value: the middle bin.
        position = F.when(hi == lo, (bins - 1) // 2).otherwise(position)
        out[name] = F.when(
            value.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(bins - 1), position))).cast("bigint")
    return df.withColumns(out)


def ratio_features(df: DataFrame) -> DataFrame:
    """Price per square metre and square metres per room; a zero divisor gives null."""
    def ratio(a: str, b: str) -> Column:
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))

    return df.withColumns({"price_per_sqm": ratio("price", "area_sqm"), "room_size": ratio("area_sqm", "rooms")})


def keyword_name(word: str) -> str:
    return f"kw_{word}"


def keyword_flags(df: DataFrame, fields: Sequence[str] = ("description",)) -> DataFrame:
    """One 0/1 column per keyword: contained in any of ``fields``, any case."""
    names = {f: f"_lower_{f}" for f in fields}
    lowered = df.withColumns({n: F.lower(f) for f, n in names.items()})
    flags = {}
    for word in vocab.KEYWORDS:
        hit = F.lit(False)
        for name in names.values():
            hit = hit | F.coalesce(F.col(name).contains(word), F.lit(False))
        flags[keyword_name(word)] = hit.cast("int")
    return lowered.withColumns(flags).drop(*names.values())


def log_target(df: DataFrame, target: str = "price") -> DataFrame:
    """``log_price`` to train on."""
    return df.withColumn("log_price", F.log1p(F.col(target).cast("double")))


def from_log(prediction: Column) -> Column:
    """A prediction of ``log_price`` as a price."""
    return F.expm1(prediction)


def drop_text_columns(df: DataFrame) -> DataFrame:
    return df.drop(*TEXT_COLUMNS)


def align_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly ``names`` in that order: absent columns and nulls 0, others dropped."""
    return df.select(*[
        F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)).alias(n) if n in df.columns
        else F.lit(0.0).alias(n) for n in names
    ])


# --- encoders and clusters --------------------------------------------------

def one_hot_stages(columns: Sequence[str]) -> list:
    """Indexer and encoder; a category unseen in training encodes as all zeros."""
    index = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_ix" for c in columns],
        handleInvalid="keep", stringOrderType="frequencyDesc")
    # "keep" puts unseen values last and dropLast leaves exactly those empty.
    encode = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in columns], outputCols=[f"{c}_vec" for c in columns], dropLast=True)
    return [index, encode]


def one_hot(df: DataFrame, columns: Sequence[str] = ("city", "region")) -> DataFrame:
    """``<column>_vec`` indicator vectors, categories by falling frequency; a null category is all zeros.

    The dictionary is a table, numbered and joined as one: no category goes to
    the driver, and the vectors are sparse.
    """
    slots = stage(rel.category_slots(df, columns), "slots")
    for c in columns:
        # "keep" sends unknown slots to an extra last place, which dropLast leaves out; the width is the largest slot
        encode = OneHotEncoder(inputCol=f"{c}_ix", outputCol=f"{c}_vec", dropLast=True, handleInvalid="keep")
        known = slots.where(F.col("field") == c).select(F.col("slot").cast("double").alias(f"{c}_ix"))
        if known.isEmpty():
            df = df.withColumn(f"{c}_vec", F.lit(None).cast(VectorUDT()))
            continue
        width = slots.where(F.col("field") == c).agg(F.count(F.lit(1)).cast("double")).scalar()
        df = rel.with_slot(df, slots, c, "_slot").withColumn(f"{c}_ix", F.coalesce(F.col("_slot").cast("double"), width)).drop("_slot")
        df = encode.fit(known).transform(df)
    return df


def geo_cluster(df: DataFrame, k: int = 10, seed: int = 42,
                model: KMeansModel | None = None) -> tuple[DataFrame, KMeansModel]:
    """``geo_cluster`` from k-means on (longitude, latitude); a given model assigns only.

    Listings without coordinates stay, without a cluster.
    """
    known = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    assembled = VectorAssembler(
        inputCols=["longitude", "latitude"], outputCol="_coords").transform(df.where(known))
    if model is None:
        model = KMeans(k=k, seed=seed, featuresCol="_coords", predictionCol="geo_cluster").fit(assembled)
    placed = model.transform(assembled).drop("_coords")
    return placed.unionByName(df.where(~known).withColumn("geo_cluster", F.lit(None).cast("int"))), model


# --- augmentation -----------------------------------------------------------

RARE_FLAGS = ("is_top_floor", "is_large", "is_small")


def augment_rare(df: DataFrame, numeric: Sequence[str], flags: Sequence[str] = RARE_FLAGS, key: str = "id",
                 rounds: int = 20, n: int = 300, sigma: float = 0.03, seed: int = 42) -> DataFrame:
    """Append noisy copies of rare rows: per round and flag ``min(n, pool)``
    draws with replacement, every ``numeric`` column times 1 + N(0, sigma).

    All draws (at most rounds x flags x n) are laid out at once and meet the
    numbered pool in one join.  Draws and noise are hashes of the seed, so a
    recomputed task repeats them.  Keys, flags and texts stay as they are;
    ``augmented`` tells the copies.
    """
    hit = F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in flags]))
    pool = df.select(key, F.explode(hit).alias("flag"))
    # Rank inside 4096 hash buckets per flag plus the rows of earlier buckets:
    # a dense number without sorting a flag's pool in one task.
    bucket = rel.hash_int(seed, F.col(key), digits=3)
    pool = pool.withColumn("bucket", bucket)
    sizes = pool.groupBy("flag", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("flag").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        "flag", "bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"), "rows",
        F.sum("rows").over(W.partitionBy("flag")).alias("pool_size"))
    draws = (
        sizes.select("flag", "pool_size").distinct()
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .withColumn("draw", F.explode(F.sequence(F.lit(0), F.least(F.lit(n), F.col("pool_size")).cast("int") - 1)))
        .withColumn("pick", F.floor(rel.uniform(seed, F.col("flag"), F.col("round"), F.col("draw")) * F.col("pool_size")))
    )
    # Bucket of every pick: sorted together, a pick belongs to the last bucket
    # start before it (at most 4096 starts and rounds x n picks per flag).
    starts = sizes.select(
        "flag", F.col("offset").alias("pos"), F.lit(0).alias("is_pick"), "bucket", "offset",
        F.lit(None).cast("int").alias("round"), F.lit(None).cast("int").alias("draw"))
    picks = draws.select(
        "flag", F.col("pick").alias("pos"), F.lit(1).alias("is_pick"), F.lit(None).cast("bigint").alias("bucket"),
        F.lit(None).cast("bigint").alias("offset"), "round", "draw")
    before = W.partitionBy("flag").orderBy("pos", "is_pick").rowsBetween(W.unboundedPreceding, 0)
    located = (
        starts.unionByName(picks)
        .withColumns({c: F.last(c, ignorenulls=True).over(before) for c in ("bucket", "offset")})
        .where(F.col("is_pick") == 1)
        .select("flag", "bucket", (F.col("pos") - F.col("offset") + 1).alias("rank"), "round", "draw")
    )
    ranked = pool.withColumn(
        "rank", F.row_number().over(W.partitionBy("flag", "bucket").orderBy(key)).cast("bigint"))
    picked = ranked.join(F.broadcast(located), ["flag", "bucket", "rank"]).select(key, "flag", "round", "draw")
    copies = df.join(F.broadcast(picked), key)  # at most rounds x flags x n rows
    for name in numeric:
        noise = rel.gaussian(seed, F.lit(name), F.col("flag"), F.col("round"), F.col("draw"))
        copies = copies.withColumn(name, F.col(name).cast("double") * (1 + sigma * noise))
    original = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    return original.withColumn("augmented", F.lit(False)).unionByName(
        copies.select(*df.columns).withColumn("augmented", F.lit(True)))


def train_test_split(df: DataFrame, key: str = "id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``split`` = train or test by a hash of the key: the same row always falls
    on the same side, whatever the layout of the data."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000
    return df.withColumn("split", F.when(bucket < int(test_share * 10_000), "test").otherwise("train"))
