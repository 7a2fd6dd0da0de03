"""The derived tables the registered queries run on, one instance per session
and data folder.  Expensive ones are written once to the shared workspace and
read back, like the stages of a nightly job."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmill.catalog import fixtures as fx
from listingmill.functions.relational import evenly
from listingmill.operators import cleaning as cl
from listingmill.operators import location as loc
from listingmill.operators.features import MODES
from listingmill.operators import text as txt
from listingmill.plans import pricing
from listingmill.plans.clean import clean_listings
from listingmill.sources.feeds import shape_postal
from listingmill.sources.files import split_names
from listingmill.sources.tables import explode_images, load_properties
from listingmill.sources.workspace import stage

RUN_DATE = "2025-06-01"
RUN_TS = RUN_DATE + " 09:30:00"

_known: dict[tuple[str, str], "Tables"] = {}


def tables(spark: SparkSession, sf_dir: str) -> "Tables":
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _known:
        _known[key] = Tables(spark, sf_dir)
    return _known[key]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def base(self, name: str) -> DataFrame:
        return fx.base(self.spark, self.sf_dir, name)

    def _derive(self, name: str, **inputs: DataFrame) -> DataFrame:
        return fx.derive(self.spark, name, **inputs)

    @cached_property
    def postal_ref(self) -> DataFrame:
        return stage(self._derive("postal_ref", supplier=self.base("supplier")), "postal-ref")

    @cached_property
    def postal(self) -> DataFrame:
        return shape_postal(self.postal_ref, "plz", "ort", "kt", F.col("ord"))

    @cached_property
    def raw(self) -> DataFrame:
        return stage(self._derive(
            "raw_listings", orders=evenly(self.base("orders").select("o_orderkey", "o_custkey", "o_totalprice")),
            documents=self.base("documents"), postal_ref=self.postal_ref), "raw-listings")

    @cached_property
    def located(self) -> DataFrame:
        """Raw listings up to the location back-fill and area rule."""
        df = cl.zip_city_from_text(cl.normalise_types(self.raw))
        df = cl.city_from_gazetteer(df, self.postal)
        df = cl.normalise_region(cl.validate_zip(df, self.postal))
        return stage(cl.area_from_text(cl.backfill_location(df, self.postal)), "located")

    @cached_property
    def clean(self) -> DataFrame:
        return stage(clean_listings(self.raw, self.postal, RUN_DATE), "clean")

    @cached_property
    def properties(self) -> DataFrame:
        # numbered in ranges of the key, so the listings with long texts, whose keys are close, would share a few tasks
        return stage(evenly(load_properties(self.clean)), "properties")

    @cached_property
    def images(self) -> DataFrame:
        return stage(explode_images(self.properties), "images")

    @cached_property
    def image_names(self) -> DataFrame:
        return self._derive("image_files", images=self.images)

    @cached_property
    def files(self) -> DataFrame:
        return split_names(self.image_names)

    @cached_property
    def addressed(self) -> DataFrame:
        return loc.compose_address(self.properties).where(F.col("full_address").isNotNull())

    @cached_property
    def gazetteers(self) -> tuple[DataFrame, DataFrame]:
        both = stage(self._derive("gazetteers", addressed=self.addressed), "gazetteers")
        return both.where(F.col("src") == "primary"), both.where(F.col("src") == "fallback")

    @cached_property
    def coord_updates(self) -> DataFrame:
        return self._derive("coord_updates", properties=self.properties)

    @cached_property
    def boxes(self) -> DataFrame:
        return self.postal_ref.select(
            F.col("ord").alias("place_id"), F.trim("ort").alias("city"), F.upper(F.trim("kt")).alias("region"),
            (F.col("lat") - 0.05).alias("south"), (F.col("lat") + 0.05).alias("north"),
            (F.col("lon") - 0.05).alias("west"), (F.col("lon") + 0.05).alias("east"))

    @cached_property
    def requests(self) -> DataFrame:
        return self._derive("requests", properties=self.properties)

    @cached_property
    def predictions(self) -> DataFrame:
        return self._derive("predictions", clean_listings=self.clean)

    @cached_property
    def listing_pages(self) -> DataFrame:
        return stage(self._derive("listing_pages", raw_listings=self.raw), "listing-pages")

    @cached_property
    def detail_pages(self) -> DataFrame:
        return stage(self._derive("detail_pages", raw_listings=self.raw), "detail-pages")

    # --- models, fitted once per session ---

    def sides(self, mode: str) -> tuple[DataFrame, DataFrame]:
        """Training rows (stored: every fit reads them again) and test rows."""
        return self._sides[mode]

    @cached_property
    def _sides(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        out = {}
        for mode in MODES:
            train, test = pricing.training_sides(self.properties, mode, RUN_TS)
            out[mode] = stage(train, f"train-{mode}"), stage(test, f"test-{mode}")
        return out

    def _both(self, fit: Callable[[str], object]) -> dict:
        """Both modes at once: their small jobs fill the cores together."""
        with ThreadPoolExecutor(2) as pool:
            return dict(zip(MODES, pool.map(fit, MODES)))

    def linear_sides(self, mode: str) -> tuple[DataFrame, DataFrame]:
        return self._linear_sides[mode]

    @cached_property
    def _linear_sides(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        sides = {m: pricing.linear_sides(self.properties, m, RUN_TS) for m in MODES}
        return {m: (stage(train, f"linear-train-{m}"), stage(test, f"linear-test-{m}")) for m, (train, test) in sides.items()}

    @cached_property
    def linear(self) -> dict:
        self._linear_sides  # before the threads start
        return self._both(lambda m: pricing.linear_model(self.linear_sides(m)[0]))

    @cached_property
    def forest(self) -> dict:
        """Per mode: pipeline and grid report."""
        self._sides  # before the threads start
        return self._both(lambda m: pricing.forest_model(self.sides(m)[0]))

    @cached_property
    def boosted(self) -> dict:
        """Per mode: pipeline, grid report, test rows."""
        properties = self.properties
        return self._both(lambda m: pricing.boosted_model(properties, m))

    @cached_property
    def combined(self):
        """Per mode: pipeline, grid report, test rows. One after the other: the driver's singular value decomposition of
        the projection keeps state between calls and does not converge when two threads are in it."""
        properties, vectors = self.properties, self.listing_vectors
        return {m: pricing.combined_model(properties, vectors, m, RUN_TS) for m in MODES}

    @cached_property
    def listing_vectors(self) -> DataFrame:
        """Up to four vectors a listing; listings beyond the vectors have none."""
        return self.base("embeddings").withColumn("id", F.floor(F.col("vec_id") / 4) + 1)
