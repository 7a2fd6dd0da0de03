"""Exploratory statistics.  The data of every chart, not the chart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmill.functions.relational import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = {"price": 30, "area_sqm": 30, "rooms": 20, "price_per_sqm": 40}
DENSITY_COLUMNS = ("price", "area_sqm", "price_per_sqm")
CELLS_PER_BANDWIDTH = 4
MOMENTS = 10
CORRELATED = ("price", "rooms", "floor", "area_sqm", "price_per_sqm")


def _melt(df: DataFrame, columns: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """Columns to rows in one pass."""
    cols = list(columns.items())
    packed = df.select(*[c.alias(f"c{i}") for i, (_, c) in enumerate(cols)])
    pairs = ", ".join(f"'{n}', c{i}" for i, (n, _) in enumerate(cols))
    return packed.select(F.expr(f"stack({len(cols)}, {pairs}) as ({name}, {value})"))


def profile_schema(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the row count."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type"))
        for i, (n, t) in enumerate(df.dtypes)
    ])
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(entries), "rows")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    long = _melt(df, {c: F.col(c).cast("double") for c in columns}, "metric", "value")
    basic = long.groupBy("metric").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(long, QUARTILES).groupBy("metric").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"q{int(p * 100)}") for p in QUARTILES])
    return basic.join(quartiles, "metric", "left").withColumnRenamed("metric", "column")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency.

    Values are counted by digest, so long texts are not shuffled; only the
    winning value of each column is looked up.  Equal frequencies are settled
    by the digest.
    """
    digests = _melt(df, {c: F.md5(F.col(c).cast("string")) for c in columns}, "column", "digest")
    counts = digests.groupBy("column", "digest").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("digest").isNotNull()
    summary = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"),
        F.count_if(known).alias("unique"),
        F.max(F.when(known, F.struct("n", "digest"))).alias("best"),
    ).select("column", "count", "unique", F.col("best.n").alias("freq"), F.col("best.digest").alias("digest"))
    values = _melt(df, {c: F.col(c).cast("string") for c in columns}, "column", "top")
    tops = (
        values.withColumn("digest", F.md5("top"))
        .join(F.broadcast(summary.select("column", "digest")), ["column", "digest"])  # one row per column
        .groupBy("column").agg(F.min("top").alias("top"))
    )
    return summary.drop("digest").join(tops, "column", "left")


def describe_all(df: DataFrame, text: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Both summaries as one table; statistics of the other kind are null."""
    return describe_text(df, text).unionByName(
        describe_numeric(df, numeric), allowMissingColumns=True)


def missing_counts(df: DataFrame) -> DataFrame:
    """Nulls per column."""
    cols = df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return counted.select(F.expr(f"stack({len(cols)}, {pairs}) as (column, missing)"))


def eda_filter(df: DataFrame) -> DataFrame:
    """Plausible monthly prices, with the price per square metre."""
    return (
        df.where(F.col("price").between(500, 10_000))
        .withColumn("price_per_sqm", F.try_divide(F.col("price").cast("double"), F.col("area_sqm").cast("double")))
    )


def histograms(df: DataFrame, bins: Mapping[str, int] = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histograms of several columns: (metric, bin, lo, hi, n).

    One pass finds the ranges, a second counts per bin inside every task.
    """
    long = (
        _melt(df, {c: F.col(c).cast("double") for c in bins}, "metric", "value")
        .where(F.col("value").isNotNull())
    )
    ranges = long.groupBy("metric").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    flat = F.col("mn") == F.col("mx")
    ranges = ranges.select(
        "metric",
        F.when(flat, F.col("mn") - 0.5).otherwise(F.col("mn")).alias("mn"),
        F.when(flat, F.col("mx") + 0.5).otherwise(F.col("mx")).alias("mx"),
        F.create_map(*[F.lit(x) for kv in bins.items() for x in kv])[F.col("metric")].alias("bins"),
    )
    width = (F.col("mx") - F.col("mn")) / F.col("bins")
    position = F.least(F.floor((F.col("value") - F.col("mn")) / width), F.col("bins") - 1)
    return (
        long.join(F.broadcast(ranges), "metric")  # one row per histogram
        .groupBy("metric", position.cast("bigint").alias("bin"), "mn", "mx", "bins")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("metric", "bin", (F.col("mn") + F.col("bin") * width).alias("lo"),
                (F.col("mn") + (F.col("bin") + 1) * width).alias("hi"), "n")
    )


def _hermite(orders: int) -> list[list[int]]:
    """Coefficients of the Hermite polynomials He_0 .. by power: He_k+1(t) = t He_k(t) - k He_k-1(t)."""
    rows = [[1], [0, 1]]
    for k in range(1, orders - 1):
        up = [0, *rows[k]]
        rows.append([c - k * (rows[k - 1][j] if j < k else 0) for j, c in enumerate(up)])
    return rows[:orders]


def density_curve(df: DataFrame, columns: Sequence[str] = DENSITY_COLUMNS, grid: int = 200) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from minimum to maximum, with
    Scott's bandwidth: (metric, point, x, density).

    A column without spread has none.  Values are summed up per cell of a quarter bandwidth by their first ten moments,
    and only cells meet the grid, so the work after the aggregate does not grow with the number of different values.  With
    ``u`` and ``t`` the distances of value and grid point from the middle of the cell in bandwidths, the kernel is
    exp(-(t - u)^2 / 2) = exp(-t^2 / 2) sum He_k(t) u^k / k!.  As |u| <= 1/8 and |He_k(t)| exp(-t^2 / 4) <= 1.09 sqrt(k!), what is cut
    off after ten terms is less than 1e-12 of the kernel's peak.
    """
    values = _melt(df, {c: F.col(c).cast("double") for c in columns}, "metric", "value").where(F.col("value").isNotNull())
    shape = values.groupBy("metric").agg(
        F.min("value").alias("mn"), F.max("value").alias("mx"), F.count(F.lit(1)).alias("total"), F.stddev_samp("value").alias("sd"))
    shape = shape.where(F.col("sd") > 0).select(  # a single value has no curve
        "metric", "mn", "mx", "total", (F.col("sd") * F.pow(F.col("total").cast("double"), F.lit(-0.2))).alias("h"))
    off = (F.col("value") - F.col("mn")) / F.col("h")
    celled = values.join(F.broadcast(shape), "metric").withColumn("cell", F.floor(off * CELLS_PER_BANDWIDTH))  # one row per curve
    middle = (F.col("cell") + 0.5) / CELLS_PER_BANDWIDTH
    terms = [F.lit(1.0)]  # u^k / k!
    for k in range(1, MOMENTS):
        terms.append(terms[-1] * F.col("u") / k)
    moments = celled.withColumn("u", off - middle).groupBy("metric", "cell", "mn", "mx", "total", "h").agg(
        *[F.sum(term).alias(f"m{k}") for k, term in enumerate(terms)])
    rows = _hermite(MOMENTS)
    powers = [sum((F.col(f"m{k}") * rows[k][j] for k in range(j + 2, MOMENTS, 2)), F.col(f"m{j}")) for j in range(MOMENTS)]
    cells = moments.select("metric", "mn", "mx", "total", "h", middle.alias("middle"), *[p.alias(f"p{j}") for j, p in enumerate(powers)])
    step = (F.col("mx") - F.col("mn")) / F.lit(float(grid - 1))
    t = F.col("t")
    series = F.col(f"p{MOMENTS - 1}")
    for j in reversed(range(MOMENTS - 1)):
        series = series * t + F.col(f"p{j}")
    return (
        cells.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("x", F.col("mn") + F.col("point") * step)
        .withColumn("t", (F.col("x") - F.col("mn")) / F.col("h") - F.col("middle"))
        .withColumn("k", F.exp(-0.5 * t * t) * series)
        .groupBy("metric", "point", "x", "total", "h").agg(F.sum("k").alias("k"))
        .select("metric", F.col("point").cast("bigint").alias("point"), "x",
                (F.col("k") / (F.col("total") * F.col("h") * F.sqrt(2 * F.pi()))).alias("density"))
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of every pair over the rows that have both: (a, b, r); null where a column has no spread."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    upper = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]

    def r(i: int, j: int):
        # rows with a null do not count; r2 is null or (with no covariance) 1 where a column has no spread
        r2, sxy = F.regr_r2(columns[i], columns[j]), F.regr_sxy(columns[i], columns[j])
        return F.when((sxy != 0) | (r2 != 1), F.signum(sxy) * F.sqrt(r2)).alias(f"r{i}_{j}")

    one = typed.agg(*[r(i, j) for i, j in upper])
    cells = [
        f"'{a}', '{b}', r{min(i, j)}_{max(i, j)}"
        for i, a in enumerate(columns) for j, b in enumerate(columns)
    ]
    return one.select(F.expr(f"stack({len(cells)}, {', '.join(cells)}) as (a, b, r)"))


def avg_price_by_region(df: DataFrame) -> DataFrame:
    """Mean price per region, cheapest first."""
    return (
        df.where(F.col("region").isNotNull())
        .groupBy("region").agg(F.avg("price").alias("avg_price")).orderBy("avg_price", "region")
    )


def desc_length_vs_price(df: DataFrame, key: str = "src_id") -> DataFrame:
    """Characters of the description (0 without one) and the price."""
    return df.select(key, F.coalesce(F.length("description"), F.lit(0)).alias("desc_length"), "price")


def region_area_price_points(df: DataFrame, key: str = "src_id") -> DataFrame:
    """Region, area and price per square metre of every listing."""
    return df.select(key, "region", "area_sqm", "price_per_sqm")
