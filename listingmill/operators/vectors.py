"""Embedding vectors: clusters, projections, pooling and checks of image files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingmill.sources.workspace import stage


def _features(vecs: DataFrame, vector: str) -> DataFrame:
    return vecs.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))


# --- clusters ---------------------------------------------------------------

def kmeans_vectors(vecs: DataFrame, k: int = 5, seed: int = 42, vector: str = "embedding",
                   out: str = "description_cluster") -> DataFrame:
    """k-means cluster of every vector."""
    features = _features(vecs, vector)
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol=out).fit(features)
    return model.transform(features).drop("_features")


def k_sweep(vecs: DataFrame, ks: Sequence[int] = range(2, 30), seed: int = 42, vector: str = "embedding",
            parallelism: int = 8) -> DataFrame:
    """Inertia and silhouette (squared Euclidean) for every k.

    The input is cached once; several fits share the cluster, as in
    cross-validation.
    """
    features = _features(vecs, vector).select("_features").persist()
    judge = ClusteringEvaluator(featuresCol="_features", predictionCol="cluster")

    def fit(k: int) -> tuple[int, float, float]:
        model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(features)
        return k, float(model.summary.trainingCost), float(judge.evaluate(model.transform(features)))

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            rows = list(pool.map(fit, ks))
    finally:
        features.unpersist()
    return vecs.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def silhouette(vecs: DataFrame, label: str = "label", vector: str = "embedding", most: int = 4_000_000) -> DataFrame:
    """Mean silhouette with squared Euclidean distances: (points, silhouette), in two passes and linear work.

    A cluster's moments - count, mean vector, mean squared length - give the
    mean squared distance of any point to it: |x|^2 - 2 x.m + q.  The moments
    are one row; it may not hold more than ``most`` numbers.
    """
    points = vecs.select(F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    points = points.withColumn("q", length)
    moments = points.groupBy("label").agg(
        F.count(F.lit(1)).cast("double").alias("n"), vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("m"), F.avg("q").alias("q"))
    moments = stage(moments, "moments")
    size = moments.agg(F.coalesce(F.sum(F.size("m")), F.lit(0))).first()[0]
    if size > most:
        raise ValueError(f"{size} numbers describe the clusters; {most} are allowed")
    held = moments.agg(F.collect_list(F.struct("label", "n", "m", "q")).alias("c"))
    met = points.withColumn("c", held.scalar())

    def mean_distance(c: Column) -> Column:
        dot = F.aggregate(F.zip_with("v", c["m"], lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.col("q") - 2 * dot + c["q"], F.lit(0.0))

    far = F.transform("c", lambda c: F.struct(c["label"].eqNullSafe(F.col("label")).alias("own"), c["n"].alias("n"), mean_distance(c).alias("d")))
    met = met.select(far.alias("far"))
    own = F.get(F.filter("far", lambda f: f["own"]), F.lit(0))
    parts = met.select(
        own["n"].alias("n"), F.try_divide(own["d"] * own["n"], own["n"] - 1).alias("a"),
        F.array_min(F.transform(F.filter("far", lambda f: ~f["own"]), lambda f: f["d"])).alias("b"))
    score = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return parts.agg(F.count(F.lit(1)).alias("points"), F.avg(score).alias("silhouette"))


def _kernels() -> tuple[Callable, Callable]:
    """(labels, distances) for tasks; made here so that they travel with the task, whose worker may not have this package."""
    def labels(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """The distinct labels, and one row per point that marks its own."""
        found, codes = np.unique(column.to_numpy(), return_inverse=True)
        return found, np.eye(len(found))[codes]

    def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """All distances by one matrix product; those so small that the product has lost their digits by the differences."""
        scale = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
        square = scale - 2.0 * (x @ y.T)
        i, j = np.nonzero(~(square > 1e-5 * scale))
        for at in range(0, len(i), 1 << 16):
            diff = x[i[at:at + (1 << 16)]] - y[j[at:at + (1 << 16)]]
            square[i[at:at + (1 << 16)], j[at:at + (1 << 16)]] = (diff * diff).sum(axis=1)
        return np.sqrt(square)

    return labels, distances


def silhouette_exact(vecs: DataFrame, label: str = "label", key: str = "vec_id", vector: str = "embedding",
                     block_rows: int = 2048) -> DataFrame:
    """Mean silhouette with Euclidean distances: (points, silhouette).

    The definition needs every distance.  Points are hashed into blocks, of about ``block_rows`` up to eight blocks and of
    at most eight times as many beyond; every pair of blocks is one group, looked at once for both sides, whose distances
    are summed per label at once.  So no pair of points is ever a row, no group grows with the data or with a label, and a
    vector is sent once per block.
    """
    n = F.count(F.lit(1))
    blocks = vecs.agg(F.greatest(F.lit(1), F.least(F.ceil(n / block_rows), F.lit(8)), F.ceil(n / (8 * block_rows))).cast("int")).scalar()
    points = (
        vecs.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("v"))
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    )
    left = points.select("key", "label", "v", "block", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("other"))
    right = points.select("key", "label", "v", F.col("block").alias("other"), F.explode(F.sequence(F.lit(0), "block")).alias("block"))

    labels, distances = _kernels()

    def sums(at: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"key": [], "label": [], "near": [], "total": [], "n": []})
        x, y = (np.stack(side["v"]).astype(np.float64) for side in (a, b))
        names, marks = zip(*(labels(side["label"]) for side in (a, b)))
        for_x, for_y = np.empty((len(x), len(names[1]))), np.zeros((len(y), len(names[0])))
        step = max(1, 4_000_000 // max(1, len(y)))  # rows whose distances fit a small buffer
        for i in range(0, len(x), step):
            far = distances(x[i:i + step], y)
            for_x[i:i + step] = far @ marks[1]
            for_y += far.T @ marks[0][i:i + step]
        sides = [(a, names[1], marks[1], for_x)]
        if at[0] != at[1]:
            sides.append((b, names[0], marks[0], for_y))
        return pd.concat([pd.DataFrame({
            "key": np.repeat(side["key"].to_numpy(), len(found)),
            "label": np.repeat(side["label"].to_numpy(), len(found)),
            "near": np.tile(found, len(side)),
            "total": total.ravel(),
            "n": np.tile(mark.sum(axis=0).astype("int64"), len(side)),
        }) for side, found, mark, total in sides], ignore_index=True)

    partial = (
        left.groupBy("block", "other").cogroup(right.groupBy("block", "other"))
        .applyInPandas(sums, "key bigint, label bigint, near bigint, total double, n bigint")
    )
    per_label = partial.groupBy("key", "label", "near").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.col("near") == F.col("label")
    scores = per_label.groupBy("key", "label").agg(
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    # A cluster of one point scores 0, and so does a point that equals all others.
    score = F.when(F.col("size") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return scores.agg(F.count(F.lit(1)).alias("points"), F.avg(score).alias("silhouette"))


# --- projections ------------------------------------------------------------

def _centred_pca(vecs: DataFrame, n: int, vector: str, out: str) -> DataFrame:
    features = _features(vecs, vector)
    centre = StandardScaler(inputCol="_features", outputCol="_centred", withMean=True, withStd=False).fit(features)
    centred = centre.transform(features)
    model: PCAModel = PCA(k=n, inputCol="_centred", outputCol=out).fit(centred)
    return model.transform(centred).drop("_features", "_centred")


def pca_project(vecs: DataFrame, n: int = 2, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """First components for display: key, ``x`` and ``y``."""
    parts = vector_to_array("_pca")
    names = ["x", "y"] + [f"c{i}" for i in range(2, n)]
    return _centred_pca(vecs, n, vector, "_pca").select(key, *[parts[i].alias(names[i]) for i in range(n)])


def width_of(vecs: DataFrame, vector: str = "embedding") -> int:
    """Length of the longest vector, 0 without any."""
    return vecs.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]


def pca_reduce(vecs: DataFrame, n: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Key and ``img_pca_0`` ... ; no more components than the vectors are wide."""
    n = min(n, width_of(vecs, vector))
    parts = vector_to_array("_pca")
    return _centred_pca(vecs, n, vector, "_pca").select(
        key, *[parts[i].alias(f"img_pca_{i}") for i in range(n)])


def pool_vectors(vecs: DataFrame, keys: DataFrame, key: str = "id", vector: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each key; a key without any gets as many zeros as the vectors are wide.

    Vectors are summed where they lie; one partial vector per key and task is
    shuffled.
    """
    means = _features(vecs, vector).groupBy(key).agg(vector_to_array(Summarizer.mean(F.col("_features"))).alias("pooled"))
    zeros = F.array_repeat(F.lit(0.0), width_of(vecs, vector))
    return keys.select(key).join(means, key, "left").select(key, F.coalesce("pooled", zeros).alias("pooled"))


def stride_reduce(vecs: DataFrame, step: int = 20, width: int = 100, key: str = "vec_id",
                  vector: str = "embedding") -> DataFrame:
    """Every ``step``-th element, at most ``width`` of them, filled up with zeros."""
    values = F.col(vector).cast("array<double>")
    kept = F.slice(F.filter(values, lambda x, i: i % step == 0), 1, width)
    padded = F.concat(kept, F.array_repeat(F.lit(0.0), width))
    return vecs.select(key, F.slice(padded, 1, width).alias("reduced"))


def merge_vectors(features: DataFrame, vecs: DataFrame, key: str = "id") -> DataFrame:
    """Listings with their vectors; listings without one are lost."""
    return features.join(vecs, key)


def merge_counts(features: DataFrame, vecs: DataFrame, key: str = "id") -> DataFrame:
    """Listings before the merge, rows after it and the difference."""
    per_key = vecs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (
        features.select(key).join(per_key, key, "left")
        .agg(F.count(F.lit(1)).alias("before"), F.coalesce(F.sum("_n"), F.lit(0)).alias("after"))
        .withColumn("lost", F.col("before") - F.col("after"))
    )


# --- image files ------------------------------------------------------------

def verify_images(images: DataFrame, files: DataFrame, show: int | None = 10) -> DataFrame:
    """(side, pid, imgid) of images that are only in the table (``missing``) or
    only among the files (``extra``), in sorted order; with ``show``, the first
    few of each side."""
    both = (
        images.select(F.col("property_id").cast("string").alias("pid"), F.col("id").cast("string").alias("imgid"),
                      F.lit(1).alias("in_table"), F.lit(0).alias("in_files"))
        .unionByName(files.select("pid", "imgid", F.lit(0).alias("in_table"), F.lit(1).alias("in_files")))
        .groupBy("pid", "imgid").agg(F.max("in_table").alias("t"), F.max("in_files").alias("f"))
    )
    side = F.when(F.col("f") == 0, "missing").when(F.col("t") == 0, "extra")
    lone = both.withColumn("side", side).where(F.col("side").isNotNull()).select("side", "pid", "imgid")
    if show is None:
        return lone
    order = W.partitionBy("side").orderBy("pid", "imgid")
    return lone.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= show).drop("_rank")


def verify_totals(images: DataFrame, files: DataFrame) -> DataFrame:
    """Entries in the table, files, missing and extra ones in one row."""
    lone = verify_images(images, files, show=None)
    rows = (
        images.select(F.concat_ws("-", "property_id", "id").alias("name"), F.lit("table_entries").alias("what"))
        .unionByName(files.select(F.concat_ws("-", "pid", "imgid").alias("name"), F.lit("files").alias("what")))
        .distinct()
        .unionByName(lone.select(F.concat_ws("-", "pid", "imgid").alias("name"), F.col("side").alias("what")))
    )
    return rows.agg(*[
        F.count_if(F.col("what") == w).alias(w) for w in ("table_entries", "files", "missing", "extra")])


def first_image(listings: DataFrame, files: DataFrame) -> DataFrame:
    """One image file per listing, the one with the smallest image id.

    Listing ids are rounded to whole numbers and compared as text.
    """
    pid = F.round(F.col("id").cast("double")).cast("bigint").cast("string")
    first = files.groupBy("pid").agg(F.min_by("name", F.struct(F.col("imgid").try_cast("bigint"), F.col("imgid"))).alias("name"))
    return listings.select(pid.alias("pid")).distinct().join(first, "pid")
