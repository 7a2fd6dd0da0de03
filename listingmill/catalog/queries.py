"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmill.catalog.tables import RUN_DATE, RUN_TS, Tables, tables
from listingmill.operators import cleaning as cl
from listingmill.operators import eda
from listingmill.operators import evaluation as ev
from listingmill.operators import explorer as ex
from listingmill.operators import features as ft
from listingmill.operators import location as loc
from listingmill.operators import similarity as sim
from listingmill.operators import text as txt
from listingmill.operators import vectors as vec
from listingmill.plans import clean as clean_plan
from listingmill.plans import pricing
from listingmill.schemas import RAW_LISTING
from listingmill.sources import arrays, feeds, files, html, models
from listingmill.sources import tables as store
from listingmill.sources.workspace import fresh_path, stage

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        return lambda spark, sf_dir: fn(tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def r(column: str | Column, digits: int, alias: str | None = None) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.round(col, digits).alias(alias or column)


def listed(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def long(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


def digest(column: str) -> Column:
    return F.md5(column).alias(column)


# --- sources and sinks ------------------------------------------------------

def _feed_files(t: Tables, compression: str = "none") -> str:
    # Feed files hold one JSON array each; a shard is 200 listings at most.
    path = fresh_path(t.spark, "feeds")
    record = F.struct(*[c for c in t.raw.columns if c not in ("latitude", "longitude")])
    (t.raw.groupBy(F.floor(F.col("src_id") / 200).alias("shard"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(record)), ",\n"), F.lit("]")).alias("value"))
        .write.partitionBy("shard").option("lineSep", "\n").option("compression", compression).text(path))
    return path


def _feed(t: Tables) -> DataFrame:
    # such a file is one task anyway, so it may be compressed
    return feeds.read_feeds(t.spark, _feed_files(t, "gzip"))


def _feed_columns(feed: DataFrame) -> DataFrame:
    return feed.select(
        "title", "address", "zip_code", "city", "region", "price", "rooms", "floor", "area_sqm", "availability_date",
        "has_balcony", digest("description"), listed("image_urls"))


@query
def read_feeds(t: Tables) -> DataFrame:
    return _feed_columns(_feed(t))


@query
def read_json_arrays(t: Tables) -> DataFrame:
    return _feed_columns(arrays.read_json_arrays(t.spark, _feed_files(t), RAW_LISTING))


@query
def read_postal(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "postal")
    (t.postal_ref.select(F.col("plz").alias("PLZ "), F.col("ort").alias("Ortschaftsname"), F.col("kt").alias(" Kantonskürzel"))
        .write.option("header", True).option("sep", ";").option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    postal = feeds.read_postal(t.spark, path)
    listings = t.raw.groupBy(F.col("zip_code").try_cast("int").alias("zip_code")).agg(F.count(F.lit(1)).alias("listings"))
    return postal.join(listings, "zip_code", "left").select(
        "zip_code", "city", "region", "city_clean", F.coalesce("listings", F.lit(0)).alias("listings"))


@query
def write_clean(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "clean-json")
    feeds.write_clean(t.clean, path)
    back = feeds.read_clean(t.spark, path)
    return back.select(*[c for c in back.columns if c not in ("description", "image_urls")],
                       digest("description"), listed("image_urls"))


@query
def scan_properties(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "properties-table")
    store.save_table(t.properties, path)
    back = store.scan_properties(t.spark, path)
    return back.select(*[c for c in store.LOADED_COLUMNS if c != "description"], digest("description"))


@query
def scan_images(t: Tables) -> DataFrame:
    return store.scan_images(t.images)


@query
def load_properties(t: Tables) -> DataFrame:
    return store.load_properties(t.clean).select(
        "id", "src_id", "rooms", "area_sqm", "price", "floor", "is_rental", "is_new", "has_view", "has_garden",
        "has_parking", "has_air_conditioning")


@query
def explode_images(t: Tables) -> DataFrame:
    return store.explode_images(t.properties)


@query
def orphan_images(t: Tables) -> DataFrame:
    # A store that lost its sales: their images are orphans.
    return store.orphan_images(t.images, t.properties.where("is_rental")).select("id", "property_id", "url")


@query
def extract_cards_html(t: Tables) -> DataFrame:
    parts = [
        html.extract_cards_html(t.listing_pages, f"{layout}_html", layout, "place").withColumn("layout", F.lit(layout))
        for layout in html.LAYOUTS]
    return parts[0].unionByName(parts[1]).withColumn("position", long("position"))


@query
def extract_details_html(t: Tables) -> DataFrame:
    parts = [
        html.extract_details_html(t.detail_pages, f"{column}_html", layout).withColumn("layout", F.lit(layout))
        for layout, column in (("thumb", "table"), ("card", "pairs"))]
    return parts[0].unionByName(parts[1]).withColumn("description", F.md5("description"))


@query
def extract_image_urls(t: Tables) -> DataFrame:
    parts = [
        html.extract_image_urls(t.detail_pages, f"{column}_html", layout).withColumn("layout", F.lit(layout))
        for layout, column in (("thumb", "table"), ("card", "pairs"))]
    return parts[0].unionByName(parts[1]).withColumn("image_urls", listed("image_urls"))


@query
def page_outline(t: Tables) -> DataFrame:
    return html.page_outline(t.base("pages"))


@query
def image_files(t: Tables) -> DataFrame:
    return t.files


@query
def image_folder(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "image-folder")
    names = t.image_names
    files.touch(names, path, files.folders_for(names.count()))
    return files.image_files(t.spark, path).select("pid", "imgid", "name")


@query
def export_csv(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "export")
    feeds.export_csv(loc.geocode_failures(t.properties, *t.gazetteers), path)
    return t.spark.read.option("header", True).option("escape", '"').schema("ID bigint, Adresse string").csv(path)


# --- cleaning ---------------------------------------------------------------

@query
def normalise_types(t: Tables) -> DataFrame:
    return cl.normalise_types(t.raw).select("src_id", "rooms", "area_sqm", "price")


@query
def parse_availability(t: Tables) -> DataFrame:
    return cl.parse_availability(t.raw, RUN_DATE).select("src_id", "availability_date")


@query
def resolve_floor(t: Tables) -> DataFrame:
    return cl.resolve_floor(t.raw).select("src_id", "floor")


@query
def resolve_floor_strict(t: Tables) -> DataFrame:
    return cl.resolve_floor(t.raw, strict=True).select("src_id", "floor")


@query
def resolve_rooms(t: Tables) -> DataFrame:
    return cl.resolve_rooms(cl.normalise_types(t.raw)).select("src_id", "rooms")


@query
def zip_city_from_text(t: Tables) -> DataFrame:
    return cl.zip_city_from_text(t.raw).select("src_id", "zip_code", "city")


@query
def city_from_gazetteer(t: Tables) -> DataFrame:
    return cl.city_from_gazetteer(cl.zip_city_from_text(t.raw), t.postal).select("src_id", "city")


@query
def validate_zip(t: Tables) -> DataFrame:
    return cl.validate_zip(cl.zip_city_from_text(t.raw), t.postal).select("src_id", "zip_code")


@query
def normalise_region(t: Tables) -> DataFrame:
    return cl.normalise_region(t.raw).select("src_id", "region")


@query
def postal_rollup(t: Tables) -> DataFrame:
    by_city, by_zip = cl.postal_rollup(t.postal)
    return by_city.select(
        F.lit("city").alias("kind"), F.col("city_clean").alias("key"), F.col("zip_code").cast("string").alias("value"), "region",
    ).unionByName(by_zip.select(
        F.lit("zip").alias("kind"), F.col("zip_code").cast("string").alias("key"), F.col("city_clean").alias("value"), "region"))


@query
def backfill_location(t: Tables) -> DataFrame:
    df = cl.city_from_gazetteer(cl.zip_city_from_text(t.raw), t.postal)
    df = cl.normalise_region(cl.validate_zip(df, t.postal))
    return cl.backfill_location(df, t.postal).select("src_id", "zip_code", "city", "region")


@query
def area_from_text(t: Tables) -> DataFrame:
    return cl.area_from_text(cl.normalise_types(t.raw)).select("src_id", "area_sqm")


@query
def amenity_flags(t: Tables) -> DataFrame:
    return cl.amenity_flags(t.raw).select("src_id", *cl.vocab.AMENITIES)


@query
def impute_price(t: Tables) -> DataFrame:
    return cl.impute_price(t.located).select("src_id", "price")


@query
def drop_incomplete(t: Tables) -> DataFrame:
    return cl.drop_incomplete(t.raw).select("src_id", "price", "floor")


@query
def classify_rental(t: Tables) -> DataFrame:
    return cl.classify_rental(cl.normalise_types(t.raw)).select("src_id", "is_rental")


@query
def default_title(t: Tables) -> DataFrame:
    return cl.default_title(cl.classify_rental(cl.normalise_types(t.raw))).select("src_id", "title")


@query
def clean_listings(t: Tables) -> DataFrame:
    df = clean_plan.clean_listings(t.raw, t.postal, RUN_DATE)
    return df.select(*[c for c in df.columns if c not in ("description", "image_urls", "latitude", "longitude")],
                     digest("description"), listed("image_urls"))


@query
def clean_from_feeds(t: Tables) -> DataFrame:
    """Feed files to stored clean records: read, number, clean, write, read back."""
    path = fresh_path(t.spark, "clean-records")
    feeds.write_clean(clean_plan.clean_listings(feeds.number_rows(_feed(t)), t.postal, RUN_DATE), path, "gzip")
    df = feeds.read_clean(t.spark, path)
    return df.select(*[c for c in df.columns if c not in ("description", "image_urls")], digest("description"), listed("image_urls"))


def _with_copies(t: Tables) -> DataFrame:
    """Cleaned listings scraped twice: the second run shouts its titles and
    lists the description's punctuation differently for every other listing."""
    again = t.clean.withColumns({
        "src_id": F.col("src_id") + 1_000_000_000,
        "title": F.when(F.col("src_id") % 2 == 0, F.upper("title")).otherwise(F.col("title")),
        "description": F.when(F.col("src_id") % 2 == 0, F.replace("description", F.lit(","), F.lit(" ; ")))
                        .otherwise(F.col("description")),
    })
    return t.clean.unionByName(again)


@query
def dedup_listings(t: Tables) -> DataFrame:
    df = _with_copies(t)
    return cl.dedup_listings(df, dropped=stage(cl.duplicates(df), "duplicates")).select("src_id")


@query
def dedup_near(t: Tables) -> DataFrame:
    df = _with_copies(t)
    return cl.dedup_listings(df, dropped=stage(cl.duplicates(df, near=True), "duplicates")).select("src_id")


@query
def similar_classes(t: Tables) -> DataFrame:
    return sim.similar_classes(_with_copies(t))


@query
def dedup_similar(t: Tables) -> DataFrame:
    df = _with_copies(t)
    return sim.dedup_similar(df, classes=stage(sim.similar_classes(df), "similar")).select("src_id")


@query
def quality_report(t: Tables) -> DataFrame:
    return cl.quality_report(t.clean)


# --- location ---------------------------------------------------------------

@query
def missing_coordinates(t: Tables) -> DataFrame:
    return loc.missing_coordinates(t.properties)


@query
def compose_address(t: Tables) -> DataFrame:
    return loc.compose_address(t.properties).select("id", "full_address")


@query
def geocode_backfill(t: Tables) -> DataFrame:
    return loc.geocode_backfill(t.properties, *t.gazetteers).select(
        "id", r("latitude", 6), r("longitude", 6))


@query
def geocode_failures(t: Tables) -> DataFrame:
    return loc.geocode_failures(t.properties, *t.gazetteers)


@query
def update_coordinates(t: Tables) -> DataFrame:
    return loc.update_coordinates(t.properties, t.coord_updates).select("id", r("latitude", 6), r("longitude", 6))


@query
def expand_bbox(t: Tables) -> DataFrame:
    # Every box with the number of raw listings that name its place.
    named = t.raw.groupBy("city").agg(F.count(F.lit(1)).alias("listings"))
    return loc.expand_bbox(t.boxes).join(named, "city", "left").select(
        "place_id", r("s", 6), r("n", 6), r("w", 6), r("e", 6), "place_name",
        F.coalesce("listings", F.lit(0)).alias("listings"))


@query
def listings_in_bbox(t: Tables) -> DataFrame:
    return loc.listings_in_bbox(t.properties, loc.expand_bbox(t.boxes))


@query
def map_points(t: Tables) -> DataFrame:
    return loc.map_points(t.properties).select("*").withColumns({
        "latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)})


# --- features ---------------------------------------------------------------

@query
def mode_filter(t: Tables) -> DataFrame:
    sides = [ft.mode_filter(t.properties, m).select("id", F.lit(m).alias("mode"), "price") for m in ft.MODES]
    return sides[0].unionByName(sides[1])


@query
def availability_features(t: Tables) -> DataFrame:
    raw = cl.parse_availability(t.raw, RUN_DATE)
    plain = ft.availability_features(raw, RUN_TS).select(
        "src_id", F.lit("null").alias("fill"), "availability_days_from_now", "availability_soon")
    filled = ft.availability_features(raw, RUN_TS, fill=0).select(
        "src_id", F.lit("zero").alias("fill"), "availability_days_from_now", "availability_soon")
    return plain.unionByName(filled)


@query
def size_floor_flags(t: Tables) -> DataFrame:
    flags = ("is_small", "is_large", "is_ground_floor", "is_top_floor", "has_balcony", "is_rental", "is_new", "has_view",
             "has_garden", "has_parking", "has_air_conditioning")
    return ft.size_floor_flags(t.properties).select("id", r("log_area_sqm", 6), *flags)


@query
def geo_bins(t: Tables) -> DataFrame:
    return ft.geo_bins(t.properties).select("id", "lat_bin", "lon_bin")


@query
def exclude_commercial(t: Tables) -> DataFrame:
    return ft.exclude_commercial(t.properties).select("id", "title")


@query
def bounds_filter(t: Tables) -> DataFrame:
    return ft.bounds_filter(t.properties).select("id", "price", "area_sqm")


@query
def ratio_features(t: Tables) -> DataFrame:
    return ft.ratio_features(t.properties).select("id", r("price_per_sqm", 7), r("room_size", 7))


@query
def keyword_flags(t: Tables) -> DataFrame:
    names = [ft.keyword_name(w) for w in ft.vocab.KEYWORDS]
    return ft.keyword_flags(t.raw, ("title", "description")).select("src_id", *names)


@query
def price_split(t: Tables) -> DataFrame:
    low, high = ft.price_split(t.properties)
    return low.select("id", F.lit("rental").alias("side")).unionByName(high.select("id", F.lit("purchase").alias("side")))


@query
def log_target(t: Tables) -> DataFrame:
    return ft.log_target(t.properties).select(
        "id", r("log_price", 6), r(ft.from_log(F.col("log_price")), 4, "price_back"))


@query
def augment_rare(t: Tables) -> DataFrame:
    flagged = ft.size_floor_flags(t.properties).select(
        "id", "price", "rooms", "area_sqm", "floor", *ft.RARE_FLAGS)
    rows = ft.augment_rare(flagged, ("price", "rooms", "area_sqm", "floor"))
    return rows.select("id", r("price", 5), r("rooms", 7), r("area_sqm", 6), r("floor", 7), *ft.RARE_FLAGS, "augmented")


@query
def one_hot(t: Tables) -> DataFrame:
    coded = ft.one_hot(t.properties)

    def position(column: str) -> Column:
        # the index of the indicator as the sparse vector holds it: an array of all slots would cost rows times categories
        return F.get(F.unwrap_udt(column)["indices"], F.lit(0)).cast("bigint").alias(column.replace("_vec", "_slot"))

    return coded.select("id", position("city_vec"), position("region_vec"))


@query
def align_features(t: Tables) -> DataFrame:
    wide = ft.size_floor_flags(t.properties)
    return ft.align_features(wide, ("id", "is_large", "not_seen", "floor", "rooms")).select(
        long("id"), "is_large", "not_seen", "floor", "rooms")


@query
def drop_text_columns(t: Tables) -> DataFrame:
    return ft.drop_text_columns(t.properties).select(
        "src_id", "zip_code", "city", "region", "price", "rooms", "area_sqm", "floor", "has_balcony")


@query
def geo_cluster(t: Tables) -> DataFrame:
    return ft.geo_cluster(t.properties)[0].select("id", "geo_cluster")


@query
def geo_cluster_rows(t: Tables) -> DataFrame:
    """Listings, those with a cluster, and clustered ones that are nearer to another cluster's centre."""
    placed, model = ft.geo_cluster(t.properties)
    away = [F.pow(F.col("longitude") - float(x), F.lit(2)) + F.pow(F.col("latitude") - float(y), F.lit(2))
            for x, y in model.clusterCenters()]
    own = F.get(F.array(*away), F.col("geo_cluster"))
    return placed.agg(F.count(F.lit(1)).alias("listings"), F.count("geo_cluster").alias("clustered"),
                      F.count_if(own > F.array_min(F.array(*away)) + 1e-9).alias("misplaced"))


# --- text and vectors -------------------------------------------------------

@query
def tfidf(t: Tables) -> DataFrame:
    return txt.tfidf(t.base("documents")).select("doc_id", "term", r("weight", 6))


@query
def kmeans_vectors(t: Tables) -> DataFrame:
    return vec.kmeans_vectors(t.base("embeddings")).select("vec_id", "description_cluster")


@query
def kmeans_texts(t: Tables) -> DataFrame:
    return txt.cluster_texts(t.base("documents"), text="text")[0].select("doc_id", "description_cluster")


@query
def k_sweep(t: Tables) -> DataFrame:
    return vec.k_sweep(t.base("embeddings"))


@query
def silhouette(t: Tables) -> DataFrame:
    return vec.silhouette(t.base("embeddings")).select("points", r("silhouette", 6))


@query
def silhouette_exact(t: Tables) -> DataFrame:
    return vec.silhouette_exact(t.base("embeddings")).select("points", r("silhouette", 6))


def _top_terms(t: Tables) -> DataFrame:
    docs = t.base("documents")
    return txt.cluster_top_terms(txt.tfidf(docs), docs.select("doc_id", F.col("lang").alias("cluster")))


@query
def cluster_top_terms(t: Tables) -> DataFrame:
    return _top_terms(t)


@query
def cluster_term_table(t: Tables) -> DataFrame:
    return txt.joined_terms(_top_terms(t))


@query
def pca_project(t: Tables) -> DataFrame:
    return vec.pca_project(t.base("embeddings"))


@query
def pca_reduce(t: Tables) -> DataFrame:
    return vec.pca_reduce(t.base("embeddings"))


def _listing_vectors(t: Tables) -> DataFrame:
    """Up to four vectors per listing, none for the listings past the table's end."""
    return t.base("embeddings").withColumn("id", F.floor(F.col("vec_id") / 4) + 1)


@query
def pool_vectors(t: Tables) -> DataFrame:
    pooled = vec.pool_vectors(_listing_vectors(t), t.properties.select("id"))
    total = F.aggregate("pooled", F.lit(0.0), lambda acc, x: acc + x)
    squares = F.aggregate("pooled", F.lit(0.0), lambda acc, x: acc + x * x)
    return pooled.select(
        "id", r(F.get("pooled", F.lit(0)), 6, "first"), r(F.get("pooled", F.lit(63)), 6, "last"),
        r(total, 6, "total"), r(squares, 6, "squares"))


@query
def stride_reduce(t: Tables) -> DataFrame:
    reduced = vec.stride_reduce(t.base("embeddings"))
    return reduced.select("vec_id", F.posexplode("reduced").alias("pos", "value")).select("vec_id", long("pos"), r("value", 6))


@query
def merge_vectors(t: Tables) -> DataFrame:
    vectors = t.base("embeddings").select(F.col("vec_id").alias("id"), "label")
    return vec.merge_vectors(t.properties.select("id", "price"), vectors)


@query
def merge_counts(t: Tables) -> DataFrame:
    return vec.merge_counts(t.properties, t.base("embeddings").select(F.col("vec_id").alias("id")))


@query
def verify_images(t: Tables) -> DataFrame:
    return vec.verify_images(t.images, t.files)


@query
def verify_images_all(t: Tables) -> DataFrame:
    return vec.verify_images(t.images, t.files, show=None)


@query
def verify_totals(t: Tables) -> DataFrame:
    return vec.verify_totals(t.images, t.files)


@query
def first_image(t: Tables) -> DataFrame:
    return vec.first_image(t.properties, t.files)


# --- evaluation and requests ------------------------------------------------

@query
def train_test_split(t: Tables) -> DataFrame:
    return ft.train_test_split(t.properties).select("id", "split")


@query
def regression_metrics(t: Tables) -> DataFrame:
    return ev.regression_metrics(t.predictions).select(r("rmse", 4), r("mae", 4), r("r2", 6))


@query
def regression_metrics_log(t: Tables) -> DataFrame:
    logged = t.predictions.select(F.log1p("actual").alias("actual"), F.log1p("predicted").alias("predicted"))
    return ev.regression_metrics(logged, log_scale=True).select(r("rmse", 3), r("mae", 3), r("r2", 6))


@query
def actual_vs_predicted(t: Tables) -> DataFrame:
    return ev.actual_vs_predicted(t.predictions).withColumn("predicted", F.round("predicted", 4))


@query
def residual_histogram(t: Tables) -> DataFrame:
    return ev.residual_histogram(t.predictions).select("bin", r("lo", 7), r("hi", 7), "n")


@query
def validate_requests(t: Tables) -> DataFrame:
    return ev.validate_requests(t.requests).select(
        "id", "ok", "missing", "description_cluster", *ev.vocab.REQUEST_FLAGS, "availability_date")


# --- models -----------------------------------------------------------------

def _per_mode(parts: dict[str, DataFrame]) -> DataFrame:
    tagged = [df.select(F.lit(mode).alias("mode"), "*") for mode, df in parts.items()]
    return tagged[0].unionByName(tagged[1])


@query
def linear_model(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.holdout_metrics(model, t.linear_sides(m)[1]) for m, model in t.linear.items()})


@query
def linear_single(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.single_feature_line(ft.mode_filter(t.properties, m)).select(
        r("slope", 4), r("intercept", 3), r("r2", 6)) for m in ft.MODES})


@query
def forest_model(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.holdout_metrics(model, t.sides(m)[1]) for m, (model, _) in t.forest.items()})


@query
def boosted_model(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.holdout_metrics(model, test, log_scale=True) for m, (model, _, test) in t.boosted.items()})


@query
def combined_model(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.holdout_metrics(model, test) for m, (model, _, test) in t.combined.items()})


@query
def grid_search(t: Tables) -> DataFrame:
    return _per_mode({m: report for m, (_, report) in t.forest.items()})


@query
def top_importances(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.top_importances(model, t.sides(m)[1]) for m, (model, _) in t.forest.items()})


@query
def top_coefficients(t: Tables) -> DataFrame:
    return _per_mode({m: pricing.top_coefficients(model, t.linear_sides(m)[1]) for m, model in t.linear.items()})


@query
def score_batch_rows(t: Tables) -> DataFrame:
    """Requests, and how many got a price or a reason for none, by mode."""
    scored = pricing.score_batch(t.requests, {m: model for m, (model, _) in t.forest.items()}, RUN_TS)
    return scored.groupBy("mode").agg(
        F.count(F.lit(1)).alias("requests"), F.count("prediction").alias("priced"), F.count("error").alias("refused"))


@query
def score_batch(t: Tables) -> DataFrame:
    return pricing.score_batch(t.requests, {m: model for m, (model, _) in t.forest.items()}, RUN_TS)


@query
def score_batch_boosted(t: Tables) -> DataFrame:
    return pricing.score_batch(t.requests, {m: parts[0] for m, parts in t.boosted.items()}, RUN_TS, log_scale=True)


def _combined_requests(t: Tables) -> DataFrame:
    """Requests with the text of their listing; every fifth has none."""
    texts = t.properties.select("id", F.when(F.col("id") % 5 != 3, F.col("description")).alias("description"))
    return t.requests.join(texts, "id")


@query
def score_batch_combined(t: Tables) -> DataFrame:
    """By the stored models: a price or a reason for every request."""
    folder = fresh_path(t.spark, "models")
    stored = {m: models.fit_or_load(t.spark, models.model_path(folder, "combined", m), lambda: parts[0])
              for m, parts in t.combined.items()}
    return pricing.score_batch_combined(_combined_requests(t), t.listing_vectors, stored, RUN_TS)


@query
def score_batch_combined_rows(t: Tables) -> DataFrame:
    """Requests, and how many got a price or a reason for none, by mode; and how many the stored models price otherwise
    than the fitted."""
    folder = fresh_path(t.spark, "models")
    requests, vectors, both = _combined_requests(t), t.listing_vectors, []
    fitted = {m: parts[0] for m, parts in t.combined.items()}
    for m, model in fitted.items():
        models.save_model(model, models.model_path(folder, "combined", m))
    stored = {m: models.fit_or_load(t.spark, models.model_path(folder, "combined", m), lambda: model) for m, model in fitted.items()}
    for name, some in (("fitted", fitted), ("stored", stored)):
        both.append(pricing.score_batch_combined(requests, vectors, some, RUN_TS).select(
            "id", "mode", "error", F.col("prediction").alias(name)))
    met = both[0].join(both[1].select("id", "stored"), "id")
    return met.groupBy("mode").agg(
        F.count(F.lit(1)).alias("requests"), F.count("fitted").alias("priced"), F.count("error").alias("refused"),
        F.count_if(~F.col("fitted").eqNullSafe(F.col("stored"))).alias("differing"))


@query
def save_load_model(t: Tables) -> DataFrame:
    path = models.model_path(fresh_path(t.spark, "models"), "linear", "rental")
    models.fit_or_load(t.spark, path, lambda: t.linear["rental"])
    again = models.fit_or_load(t.spark, path, lambda: t.linear["purchase"])  # stored: not fitted again
    return pricing.predict(again, t.linear_sides("rental")[1]).select("id", "actual", r("predicted", 2))


# --- exploratory statistics -------------------------------------------------

NUMERIC = ("zip_code", "price", "rooms", "floor", "area_sqm")
TEXT = ("title", "address", "city", "region", "availability_date", "has_balcony", "description", "is_rental")


def _eda(t: Tables) -> DataFrame:
    return eda.eda_filter(t.clean)


@query
def profile_schema(t: Tables) -> DataFrame:
    return eda.profile_schema(t.clean)


@query
def describe_all(t: Tables) -> DataFrame:
    return eda.describe_all(t.clean, TEXT, NUMERIC).select(
        "column", "count", "unique", F.md5("top").alias("top"), "freq", r("mean", 7), r("std", 4), "min", r("q25", 7), r("q50", 7),
        r("q75", 7), "max")


@query
def missing_counts(t: Tables) -> DataFrame:
    return eda.missing_counts(t.raw)


@query
def eda_filter(t: Tables) -> DataFrame:
    return _eda(t).select("src_id", "price", r("price_per_sqm", 7))


@query
def histograms(t: Tables) -> DataFrame:
    return eda.histograms(_eda(t)).select("metric", "bin", r("lo", 7), r("hi", 7), "n")


@query
def density_curve(t: Tables) -> DataFrame:
    return eda.density_curve(_eda(t)).select("metric", "point", r("x", 4), r("density", 9))


@query
def correlation_matrix(t: Tables) -> DataFrame:
    return eda.correlation_matrix(_eda(t)).select("a", "b", r("r", 6))


@query
def avg_price_by_region(t: Tables) -> DataFrame:
    return eda.avg_price_by_region(_eda(t)).select("region", r("avg_price", 7))


@query
def desc_length_vs_price(t: Tables) -> DataFrame:
    return eda.desc_length_vs_price(_eda(t)).select("src_id", long("desc_length"), "price")


@query
def region_area_price_points(t: Tables) -> DataFrame:
    return eda.region_area_price_points(_eda(t)).select("src_id", "region", "area_sqm", r("price_per_sqm", 7))


# --- explorer ---------------------------------------------------------------

SAMPLE_FILTERS = dict(
    city="ER", region="", min_price=600, max_price=400_000, min_rooms=2, max_rooms=4.5, min_area_sqm=30,
    max_area_sqm=160, is_rental=None, has_balcony=True)


@query
def explore(t: Tables) -> DataFrame:
    return ex.explore(t.properties, **SAMPLE_FILTERS).select("id", "city", "price", "rooms", "area_sqm")


@query
def explore_count(t: Tables) -> DataFrame:
    return ex.explore_count(t.properties, region="z", has_garden=False, has_view=False, min_price=1000)


@query
def explore_display(t: Tables) -> DataFrame:
    return ex.explore_display(t.properties)
