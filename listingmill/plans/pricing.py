"""Price models: linear, forest, boosted trees, and a forest with text and image
features.  Training always splits first and augments the training side only;
everything serving needs (bin edges, encoders, clusters, projections) is a
stage of the stored pipeline."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, Imputer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmill.operators import evaluation as ev
from listingmill.operators import features as ft
from listingmill.operators.text import INTERNAL, text_vectoriser
from listingmill.operators.vectors import pool_vectors, width_of
from listingmill.plans.stages import DropColumns, PoolVectors
from listingmill.sources.workspace import stage

NUMERIC = (
    "zip_code", "rooms", "area_sqm", "floor", "latitude", "longitude", "has_balcony", "is_rental", "is_new",
    "has_view", "has_garden", "has_parking", "has_air_conditioning", "availability_days_from_now",
    "availability_soon", "log_area_sqm", "is_small", "is_large", "is_ground_floor", "is_top_floor",
)
CATEGORICAL = ("city", "region")
NOISED = ("price", "rooms", "area_sqm", "floor", "latitude", "longitude", "log_area_sqm")

BOOSTED_NUMERIC = ("rooms", "area_sqm", "floor", "has_balcony", "longitude", "latitude", "room_size")
BOOSTED_NOISED = ("price", "rooms", "area_sqm", "floor", "latitude", "longitude")
BOOSTED_CATEGORICAL = ("zip_code", "city", "region", "geo_cluster")

# Column lists above and search grids below.
FOREST_GRID = {"numTrees": (100, 200), "maxDepth": (10, 20), "minInstancesPerNode": (1, 2)}
BOOSTED_GRID = {
    "maxIter": (100, 200), "maxDepth": (4, 6, 8), "stepSize": (0.01, 0.05, 0.1),
    "subsamplingRate": (0.8, 1.0), "featureSubsetStrategy": ("0.8", "1.0"),
}
COMBINED_GRID = {"numTrees": (100,), "maxDepth": (10,), "minInstancesPerNode": (1, 2)}
#: Fits of a search that run side by side; each is many small jobs, which leave cores idle.
PARALLEL_FITS = 8
#: Rows of a partition in these fits, at least.
ROWS_A_TASK = 20_000


# --- features ---------------------------------------------------------------

def structured_features(df: DataFrame, run_ts: str, fill: int | None = None) -> DataFrame:
    """The shared feature columns of training and serving; ``fill`` stands for unknown days."""
    return ft.size_floor_flags(ft.availability_features(df, run_ts, fill))


def training_sides(df: DataFrame, mode: str, run_ts: str, augment: bool = True,
                   seed: int = 42, fill: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) of one mode, with augmented rare rows on the training side."""
    rows = ft.train_test_split(structured_features(ft.mode_filter(df, mode), run_ts, fill), seed=seed)
    train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    if augment:
        train = ft.augment_rare(train, NOISED, seed=seed)
    return train, test


def _bin_stage(train: DataFrame) -> SQLTransformer:
    """Coordinate bins with the training edges written into the stage."""
    columns = []
    for column, (lo, hi) in ft.bin_edges(train).items():
        width = (hi - lo) if hi is not None and hi > lo else 1.0
        columns.append(
            f"CAST(greatest(0, least(9, ceil(10 * ({column} - {lo or 0.0!r}D) / {width!r}D) - 1)) AS DOUBLE) "
            f"AS {'lat' if column == 'latitude' else 'lon'}_bin")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _cast_stage(names: Sequence[str]) -> SQLTransformer:
    return SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CAST(`{n}` AS DOUBLE) AS `{n}_num`" for n in names) + " FROM __THIS__")


def _text_stage(names: Sequence[str]) -> SQLTransformer:
    return SQLTransformer(statement="SELECT *, " + ", ".join(
        f"coalesce(CAST(`{n}` AS STRING), '(none)') AS `{n}_cat`" for n in names) + " FROM __THIS__")


#: Beyond this many categories trees get a column as the binary digits of the category's number, not as indicators.
MOST_INDICATORS = 128


def _wide(train: DataFrame, categorical: Sequence[str]) -> dict[str, int]:
    """Binary digits of the columns with more than ``MOST_INDICATORS`` categories in ``train``; unseen counts as one more."""
    given = [c for c in categorical if c in train.columns]
    counts = train.agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("(none)"))).alias(c) for c in given]).first()
    return {c: counts[c].bit_length() for c in given if counts[c] > MOST_INDICATORS}


def _digit_stage(wide: Mapping[str, int]) -> SQLTransformer:
    return SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CAST(shiftright(CAST(`{c}_cat_ix` AS INT), {i}) & 1 AS DOUBLE) AS `{c}_cat_digit{i}`"
        for c, digits in wide.items() for i in range(digits)) + " FROM __THIS__")


def _assemble(numeric: Sequence[str], categorical: Sequence[str], vectors: Sequence[str] = (),
              wide: Mapping[str, int] | None = None) -> list:
    """Stages from named columns to ``features``: medians for gaps, indicators
    for categories (unseen: all zeros), further vectors as they are.

    ``wide`` columns become that many binary digits of their category's number.  Trees keep every feature of every row as
    a number, so indicators would cost rows times categories, which both grow; with digits no category is left out.
    """
    wide = wide or {}
    cats = [f"{c}_cat" for c in categorical]
    index, encode = ft.one_hot_stages(cats)
    narrow = [f"{c}_cat" for c in categorical if c not in wide]
    encoded = [encode.copy().setInputCols([f"{c}_ix" for c in narrow]).setOutputCols([f"{c}_vec" for c in narrow])] if narrow else []
    return [
        _cast_stage(numeric),
        Imputer(inputCols=[f"{n}_num" for n in numeric], outputCols=[f"{n}_full" for n in numeric], strategy="median"),
        _text_stage(categorical),
        index, *encoded, *([_digit_stage(wide)] if wide else []),
        VectorAssembler(
            inputCols=[*(f"{n}_full" for n in numeric), *(f"{c}_vec" for c in narrow),
                       *(f"{c}_cat_digit{i}" for c, digits in wide.items() for i in range(digits)), *vectors],
            outputCol="features", handleInvalid="keep"),
    ]


# --- training ---------------------------------------------------------------

def _points(regressor: Estimator, grid: Mapping[str, Sequence]) -> list[dict[Param, object]]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(regressor.getParam(name), list(values))
    return builder.build()


def _folded(ready: DataFrame, folds: int, seed: int) -> DataFrame:
    """``fold`` from a hash of the listing id, so copies of a listing stay in one fold and a recomputed task repeats them."""
    return ready.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(folds)).cast("int"))


def search(regressor: Estimator, ready: DataFrame, grid: Mapping[str, Sequence], label: str, folds: int = 3,
           parallelism: int = PARALLEL_FITS, seed: int = 42) -> CrossValidatorModel:
    """Cross-validated grid search by mean absolute error."""
    return CrossValidator(
        estimator=regressor, estimatorParamMaps=_points(regressor, grid), numFolds=folds, foldCol="fold",
        evaluator=RegressionEvaluator(labelCol=label, metricName="mae"), parallelism=parallelism, seed=seed,
    ).fit(_folded(ready, folds, seed))


def boosted_search(regressor: GBTRegressor, ready: DataFrame, grid: Mapping[str, Sequence], label: str, folds: int = 3,
                   parallelism: int = PARALLEL_FITS, seed: int = 42) -> tuple[GBTRegressionModel, list[tuple[dict, float]]]:
    """The same search for boosted trees: the best model on all rows, and (grid point, mean absolute error).

    The first trees of a longer run are the trees of a shorter one, so grid points that differ in ``maxIter`` alone share a
    fit by fold; its error is taken after each of their numbers of trees.
    """
    folded, points = _folded(ready, folds, seed), _points(regressor, grid)
    runs: dict[tuple, list[int]] = {}
    for k, point in enumerate(points):
        runs.setdefault(tuple(v for p, v in point.items() if p.name != "maxIter"), []).append(k)

    def trees(point: dict) -> int:
        return point.get(regressor.maxIter, regressor.getMaxIter())

    def errors(job: tuple[list[int], int]) -> dict[int, float]:
        members, fold = job
        longest = max((points[k] for k in members), key=trees)
        model = regressor.fit(folded.where(F.col("fold") != fold), longest)
        after = model.evaluateEachIteration(folded.where(F.col("fold") == fold), "absolute")
        return {k: after[trees(points[k]) - 1] for k in members}

    jobs = [(members, fold) for members in runs.values() for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(inheritable_thread_target(ready.sparkSession)(errors), jobs))
    means = [sum(x[k] for x in found if k in x) / folds for k in range(len(points))]
    best = min(range(len(points)), key=means.__getitem__)
    return regressor.fit(ready, points[best]), list(zip(points, means))


def grid_report(tried: Iterable[tuple[Mapping[Param, object], float]], ready: DataFrame) -> DataFrame:
    """Mean error of every grid point: (params, mae)."""
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name)), float(mae)) for point, mae in tried]
    return ready.sparkSession.createDataFrame(rows, "params string, mae double")


def _fit(train: DataFrame, stages: Callable[[DataFrame], list], regressor: Estimator,
         grid: Mapping[str, Sequence] | None, label: str, folds: int) -> tuple[PipelineModel, DataFrame | None]:
    """Fit feature stages once, store their output for all grid points, search,
    and join both into one pipeline.  Every feature stage passes over the
    training rows, so ``train`` should be a stored table."""
    prepared = Pipeline(stages=stages(train)).fit(train)
    ready = prepared.transform(train).select("id", "features", F.col(label).cast("double").alias(label))
    ready = stage(ready, "features")
    if grid is not None:
        # a level of a tree is one small job; where a partition had few rows, the fits would wait for their tasks to start
        ready = ready.coalesce(max(1, ready.count() // ROWS_A_TASK))
    if grid is None:
        return PipelineModel(stages=[*prepared.stages, regressor.fit(ready)]), None
    if isinstance(regressor, GBTRegressor):
        best, tried = boosted_search(regressor, ready, grid, label, folds)
    else:
        found = search(regressor, ready, grid, label, folds)
        best, tried = found.bestModel, zip(found.getEstimatorParamMaps(), found.avgMetrics)
    return PipelineModel(stages=[*prepared.stages, best]), grid_report(tried, ready)


def _listing_stages(train: DataFrame) -> list:
    """For least squares, which works on sparse indicators however many there are."""
    return [_bin_stage(train), *_assemble((*NUMERIC, "lat_bin", "lon_bin"), CATEGORICAL)]


def _forest_stages(train: DataFrame) -> list:
    return [_bin_stage(train), *_assemble((*NUMERIC, "lat_bin", "lon_bin"), CATEGORICAL, wide=_wide(train, CATEGORICAL))]


def linear_model(train: DataFrame, max_iter: int = 500) -> PipelineModel:
    """Least squares on all features, by the same solver however many categories there are.

    Raises if the solver has not converged.
    """
    solver = LinearRegression(labelCol="price", solver="l-bfgs", maxIter=max_iter, tol=1e-7, regParam=1e-4)
    model = _fit(train, _listing_stages, solver, None, "price", 0)[0]
    if model.stages[-1].summary.totalIterations >= max_iter:
        raise ArithmeticError(f"least squares has not converged in {max_iter} steps")
    return model


def linear_sides(df: DataFrame, mode: str, run_ts: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the linear model: nothing augmented, gaps in numbers and days are 0."""
    sides = training_sides(df, mode, run_ts, augment=False, seed=seed, fill=0)
    return tuple(side.fillna(0, subset=[c for c in NUMERIC if c in side.columns]) for side in sides)


def single_feature_line(df: DataFrame, feature: str = "area_sqm", target: str = "price") -> DataFrame:
    """Least squares on one feature: (slope, intercept, r2)."""
    rows = VectorAssembler(inputCols=[feature], outputCol="features", handleInvalid="skip").transform(
        df.select(F.col(feature).cast("double").alias(feature), F.col(target).cast("double").alias(target)))
    model = LinearRegression(labelCol=target, solver="normal").fit(rows)
    values = [(float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))]
    return df.sparkSession.createDataFrame(values, "slope double, intercept double, r2 double")


def forest_model(train: DataFrame, grid: Mapping[str, Sequence] = FOREST_GRID, folds: int = 3,
                 seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Random forest with a searched grid: the pipeline and the grid report."""
    return _fit(train, _forest_stages, RandomForestRegressor(labelCol="price", seed=seed), grid, "price", folds)


def boosted_features(df: DataFrame, fields: Sequence[str] = ("description",)) -> DataFrame:
    """Ratios, keyword flags and the log target where there is a price."""
    rows = df if "price" in df.columns else df.withColumn("price", F.lit(0).cast("bigint"))
    return ft.log_target(ft.keyword_flags(ft.ratio_features(rows), fields))


def boosted_model(df: DataFrame, mode: str, grid: Mapping[str, Sequence] = BOOSTED_GRID, folds: int = 3,
                  leak_price_per_sqm: bool = False, clusters: int = 10,
                  seed: int = 42) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Boosted trees on the log price of one side: pipeline, grid report, test rows.

    Rare training rows are augmented before the ratios and the log price are
    taken.  ``price_per_sqm`` gives the price away and is left out unless asked for.
    """
    rows = ft.size_floor_flags(ft.bounds_filter(ft.exclude_commercial(df)))
    side = ft.price_split(rows)[0 if mode == "rental" else 1]
    split = stage(ft.train_test_split(side, seed=seed), "boosted-split")
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    train = ft.augment_rare(train, BOOSTED_NOISED, seed=seed)
    train, test = (stage(boosted_features(x), "boosted-side") for x in (train, test))
    numeric = (*BOOSTED_NUMERIC, *(("price_per_sqm",) if leak_price_per_sqm else ()),
               *(ft.keyword_name(w) for w in ft.vocab.KEYWORDS))

    def stages(rows: DataFrame) -> list:
        return [
            VectorAssembler(inputCols=["longitude", "latitude"], outputCol="coords", handleInvalid="keep"),
            KMeans(k=clusters, seed=seed, featuresCol="coords", predictionCol="geo_cluster"),
            *_assemble(numeric, BOOSTED_CATEGORICAL, wide=_wide(rows, BOOSTED_CATEGORICAL)),
        ]

    model, report = _fit(train, stages, GBTRegressor(labelCol="log_price", seed=seed), grid, "log_price", folds)
    return model, report, test


def combined_rows(listings: DataFrame, vectors: DataFrame) -> DataFrame:
    """Listings with ``images`` (their vectors' mean as the only vector, or none) and no cluster of their own."""
    vectors = vectors.where(F.col("embedding").isNotNull())
    means = pool_vectors(vectors, vectors.select("id").distinct()).select(F.col("id").alias("_id"), F.array("pooled").alias("images"))
    found = listings.join(means, F.col("id") == F.col("_id"), "left").drop("_id")
    return found if "description_cluster" in listings.columns else found.withColumn("description_cluster", F.lit(None).cast("int"))


def _combined_stages(rows: DataFrame, width: int, components: int, clusters: int, seed: int) -> list:
    """From raw columns to features: everything that a request needs is fitted on the training rows and stored."""
    texts = text_vectoriser(rows.where(~F.col("augmented")))
    return [
        SQLTransformer(statement="SELECT *, coalesce(description, '') AS _text FROM __THIS__"),
        *texts.stages,
        KMeans(k=clusters, seed=seed, featuresCol="text_vec", predictionCol="text_cluster"),
        # a request without a text may name its cluster
        SQLTransformer(statement="SELECT *, CASE WHEN description IS NULL THEN coalesce(description_cluster, text_cluster) "
                                 "ELSE text_cluster END AS cluster FROM __THIS__"),
        PoolVectors(inputCol="images", outputCol="image", width=width),
        _bin_stage(rows),
        StandardScaler(inputCol="image", outputCol="image_centred", withMean=True, withStd=False),
        PCA(k=min(components, width), inputCol="image_centred", outputCol="img_pca"),
        *_assemble((*NUMERIC, "lat_bin", "lon_bin"), (*CATEGORICAL, "cluster"), ("img_pca",), _wide(rows, CATEGORICAL)),
        DropColumns(columns=[*INTERNAL, "text_vec", "images", "image", "image_centred"]),
    ]


def combined_model(listings: DataFrame, vectors: DataFrame, mode: str, run_ts: str,
                   grid: Mapping[str, Sequence] = COMBINED_GRID, components: int = 100,
                   folds: int = 3, clusters: int = 10, seed: int = 42) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Forest over structured features, the text cluster and image components.

    ``vectors`` are (id, embedding), any number per listing: their mean, or
    zeros, stands for the listing's images.  Vocabulary, text clusters, pooling
    and projection are fitted on the training rows of this mode and are stages
    of the pipeline, which alone turns a request into a price.  Returns
    pipeline, report, test rows.
    """
    width = max(width_of(vectors), 1)
    sides = training_sides(combined_rows(listings, vectors), mode, run_ts, seed=seed)
    train, test = (stage(side, f"combined-{mode}") for side in sides)

    def stages(rows: DataFrame) -> list:
        return _combined_stages(rows, width, components, clusters, seed)

    model, report = _fit(train, stages, RandomForestRegressor(labelCol="price", seed=seed), grid, "price", folds)
    return model, report, test


# --- use --------------------------------------------------------------------

def predict(model: PipelineModel, rows: DataFrame, log_scale: bool = False) -> DataFrame:
    """(id, actual, predicted) in francs."""
    scored = model.transform(rows)
    predicted = ft.from_log(F.col("prediction")) if log_scale else F.col("prediction")
    return scored.select("id", F.col("price").cast("double").alias("actual"), predicted.alias("predicted"))


def holdout_metrics(model: PipelineModel, test: DataFrame, log_scale: bool = False) -> DataFrame:
    """Metrics on held-out rows next to those of always predicting their mean."""
    preds = predict(model, test, log_scale)
    preds = stage(preds, "predictions")  # scored once, read twice
    mean = preds.agg(F.avg("actual")).scalar()
    both = preds.withColumn("off", F.abs(F.col("actual") - mean))
    error, actual = F.col("actual") - F.col("predicted"), F.col("actual")
    return both.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(actual) * F.count(actual))).alias("r2"),
        F.avg("off").alias("mean_predictor_mae"))


def feature_names(model: PipelineModel, rows: DataFrame) -> list[str]:
    """Name of every slot of ``features``, from the column's attributes."""
    meta = model.transform(rows.limit(0)).schema["features"].metadata["ml_attr"]
    slots = sorted((a["idx"], a.get("name", f"feature_{a['idx']}")) for group in meta["attrs"].values() for a in group)
    named = dict(slots)
    return [named.get(i, f"feature_{i}") for i in range(meta["num_attrs"])]


def _top(model: PipelineModel, rows: DataFrame, values: Sequence[float], column: str, n: int) -> DataFrame:
    pairs = [(name, float(v)) for name, v in zip(feature_names(model, rows), values)]
    table = rows.sparkSession.createDataFrame(pairs, f"feature string, {column} double")
    return table.orderBy(F.desc(F.abs(column)), "feature").limit(n)


def top_importances(model: PipelineModel, rows: DataFrame, n: int = 15) -> DataFrame:
    """The most important features of a tree model."""
    return _top(model, rows, model.stages[-1].featureImportances.toArray(), "importance", n)


def top_coefficients(model: PipelineModel, rows: DataFrame, n: int = 15) -> DataFrame:
    """The largest coefficients of a linear model by absolute value."""
    return _top(model, rows, model.stages[-1].coefficients.toArray(), "coefficient", n)


def _typed(requests: DataFrame, models: Mapping[str, PipelineModel]) -> tuple[DataFrame, DataFrame]:
    """(refused, typed): requests with the reason why they get no price, and the others with typed columns."""
    numbers = {"area": "double", "floor": "int", "rooms": "double", "lat": "double", "lon": "double", "zip_code": "int"}
    checked = ev.validate_requests(requests)
    unread = F.array_join(F.array_compact(F.array(*[
        F.when(F.col(c).try_cast(kind).isNull(), F.lit(c)) for c, kind in numbers.items()])), ", ")
    checked = checked.withColumn("error", F.when(~F.col("ok"), F.concat(F.lit("missing: "), "missing"))
                                 .when(unread != "", F.concat(F.lit("not a number: "), unread))
                                 .when(~F.col("mode").isin(list(models)), F.concat(F.lit("no model for mode "), "mode")))
    refused = checked.where(F.col("error").isNotNull()).select(
        "id", "mode", F.lit(None).cast("double").alias("prediction"), "error")
    typed = checked.where(F.col("error").isNull()).drop("error").withColumns({
        "zip_code": F.col("zip_code").try_cast("int"),
        "area_sqm": F.col("area").try_cast("double"),
        "floor": F.col("floor").try_cast("int"),
        "rooms": F.col("rooms").try_cast("double"),
        "latitude": F.col("lat").try_cast("double"),
        "longitude": F.col("lon").try_cast("double"),
        "availability_date": F.col("availability_date").try_cast("date"),
        **{f: F.col(f) == 1 for f in ev.vocab.REQUEST_FLAGS},
        "is_rental": F.col("mode") == "rental",
    })
    return refused, typed


def _priced(refused: DataFrame, rows: DataFrame, models: Mapping[str, PipelineModel], log_scale: bool = False) -> DataFrame:
    """The refused requests and ``rows``, each priced by the model of its mode."""
    scored = refused
    for mode, model in models.items():
        out = model.transform(rows.where(F.col("mode") == mode))
        price = ft.from_log(F.col("prediction")) if log_scale else F.col("prediction")
        scored = scored.unionByName(out.select(
            "id", "mode", F.round(price, 2).alias("prediction"), F.lit(None).cast("string").alias("error")))
    return scored


def score_batch(requests: DataFrame, models: Mapping[str, PipelineModel], run_ts: str,
                log_scale: bool = False) -> DataFrame:
    """(id, mode, prediction, error) of all requests: valid ones by the model of
    their mode, rounded to two places; for the others ``error`` says why there
    is no prediction."""
    refused, typed = _typed(requests, models)
    if log_scale:
        for name in ("title", "description"):
            if name not in typed.columns:
                typed = typed.withColumn(name, F.lit(""))
        # The price per square metre is unknown when serving and sent as 0.
        rows = boosted_features(typed, ("title", "description")).withColumn("price_per_sqm", F.lit(0.0))
    else:
        rows = structured_features(typed, run_ts)
    return _priced(refused, rows, models, log_scale)


def score_batch_combined(requests: DataFrame, vectors: DataFrame, models: Mapping[str, PipelineModel], run_ts: str) -> DataFrame:
    """The same by combined models, which also look at a request's text and images.

    ``requests`` may carry ``description``; without a text the cluster that the
    request names counts, 0 if it names none.  ``vectors`` are (id, embedding)
    of the requests' images, any number each.
    """
    refused, typed = _typed(requests, models)
    if "description" not in typed.columns:
        typed = typed.withColumn("description", F.lit(None).cast("string"))
    return _priced(refused, combined_rows(structured_features(typed, run_ts), vectors), models)
