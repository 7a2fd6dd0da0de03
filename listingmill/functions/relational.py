"""Relational building blocks that keep working when the data no longer fits
one task: dense numbering, exact quantiles, equal-width bins, seeded noise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingmill.sources.workspace import stage


def dense_ids(df: DataFrame, order_by: Sequence[str], out: str = "id") -> DataFrame:
    """Number rows 1..n in ``order_by`` order without a one-task global sort.

    Sampled splitters cut the rows into ranges of about equal size, whatever
    the keys look like.  Rows are counted inside their range and shifted by the
    rows of all earlier ranges; only one count per range meets in one task.
    ``order_by`` should be unique: rows with equal keys share a range, and
    their order among each other is open.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A row knows its range and its place there from the partition it was sorted in; stored, so that neither changes.
    placed = df.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
    row = F.monotonically_increasing_id()
    placed = stage(placed.select("*", F.shiftright(row, 33).alias("_range"), row.bitwiseAND((1 << 33) - 1).alias("_place")), "ranges")
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col("_range"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_range")  # a row per range
        .withColumn(out, (F.col("_offset") + F.col("_place") + 1).cast("bigint"))
        .drop("_range", "_place", "_offset")
    )


#: Rows of a task that reads or derives whole texts.
TASK_ROWS = 50_000


def evenly(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in partitions of about ``rows`` rows, at least one per core.

    Files that compress well are split by their bytes, which leaves a few tasks with most of the rows; what is derived and
    stored from there inherits that.  Rows are dealt by all their columns, so equal or null keys do no harm.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(parts, *df.columns)


def scattered(df: DataFrame) -> Column:
    """A number that spreads rows over the partitions and is the same when a task runs again: a hash of the numeric columns
    (ids, prices; cheap), or of all plain ones where there is none."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    numeric = [c for c, k in kinds.items() if k in ("byte", "short", "integer", "long", "float", "double", "date", "timestamp")]
    return F.xxhash64(*[df[c] for c in numeric or [c for c, k in kinds.items() if k not in ("array", "map", "struct")]])


def category_slots(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, value, slot): the values of each column by falling frequency (equal counts by value), from slot 0 on."""
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = df.select(pair.alias("p")).select("p.*").where("value is not null").groupBy("field", "value").agg(
        (-F.count(F.lit(1))).alias("_n"))
    numbered = stage(dense_ids(counts, ["field", "_n", "value"], out="_id"), "categories")
    first = numbered.groupBy("field").agg(F.min("_id").alias("_first"))
    return numbered.join(F.broadcast(first), "field").select("field", "value", (F.col("_id") - F.col("_first")).alias("slot"))


def with_slot(df: DataFrame, slots: DataFrame, column: str, out: str, hot: int = 10_000) -> DataFrame:
    """``df`` with the slot of its ``column``, null if it has none.

    The ``hot`` most frequent values are broadcast; the others are rare by construction and meet in a shuffle, in which the
    rows that are done already keep to scattered keys of their own.
    """
    mine = slots.where(F.col("field") == column)
    top = mine.where(F.col("slot") < hot).select(F.col("value").alias("_v"), F.col("slot").alias("_s"))
    # one key, as a constant beside it would be folded into the condition and leave all rows that are done with one null key
    rare = mine.where(F.col("slot") >= hot).select(F.concat(F.lit("v"), "value").alias("_w"), F.col("slot").alias("_t"))
    value = F.col(column).cast("string")
    met = df.join(F.broadcast(top), value == F.col("_v"), "left")
    done = F.col("_s").isNotNull() | F.col(column).isNull()
    met = met.withColumn("_k", F.when(done, F.concat(F.lit("d"), scattered(df).cast("string"))).otherwise(F.concat(F.lit("v"), value)))
    both = met.join(rare, F.col("_k") == F.col("_w"), "left")
    return both.withColumn(out, F.coalesce("_s", "_t")).drop("_v", "_s", "_k", "_w", "_t")


#: Rank error of a sketch, as a share of the rows it has seen.
SKETCH = 10_000


def exact_quantiles(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per ``metric`` of a long (metric, value) table.

    A mergeable sketch of each metric brackets every wanted rank; only values
    between its two cuts are counted, one in two thousand, however close
    together the values are.  A second sketch, of these distinct values, cuts
    each bracket into 500 pieces, and only the one or two pieces that hold the
    rank are sorted.  Returns (metric, prob, quantile).
    """
    values = long.select("metric", F.col("value").cast("double").alias("value")).where(F.col("value").isNotNull())
    slack = 2.5 / SKETCH
    cuts = [max(p - slack, 0.0) for p in probs] + [min(p + slack, 1.0) for p in probs]
    sketch = values.groupBy("metric").agg(
        F.count(F.lit(1)).alias("total"), F.percentile_approx("value", F.array(*[F.lit(float(c)) for c in cuts]), F.lit(SKETCH)).alias("cuts"),
        F.min("value").alias("least"), F.max("value").alias("most"))
    few = F.col("total") < 4 * SKETCH  # the slack is less than a few ranks
    wanted = [F.struct(
        F.lit(float(p)).alias("prob"), ((F.col("total") - 1) * float(p)).alias("pos"),
        F.when(few, F.col("least")).otherwise(F.get("cuts", F.lit(i))).alias("lo"),
        F.when(few, F.col("most")).otherwise(F.get("cuts", F.lit(len(probs) + i))).alias("hi")) for i, p in enumerate(probs)]
    lists = stage(sketch.select("metric", F.array(*wanted).alias("b")), "brackets")  # a row per metric
    placed = values.join(F.broadcast(lists), "metric")
    # which brackets a value lies in, or below which, is settled before anything becomes a row of its own
    below = placed.select("metric", F.explode(F.filter("b", lambda b: F.col("value") < b["lo"])["prob"]).alias("prob")).groupBy(
        "metric", "prob").agg(F.count(F.lit(1)).alias("below"))
    brackets = stage(lists.select("metric", F.explode("b").alias("w")).select("metric", "w.prob", "w.pos").join(
        below, ["metric", "prob"], "left").withColumn("below", F.coalesce("below", F.lit(0))), "brackets")
    inside = placed.select("metric", "value", F.explode(F.filter(
        "b", lambda b: (F.col("value") >= b["lo"]) & (F.col("value") <= b["hi"]))["prob"]).alias("prob"))
    inside = stage(inside.groupBy("metric", "prob", "value").agg(F.count(F.lit(1)).alias("n")), "bracketed")

    grid = F.array(*[F.lit(i / 500) for i in range(1, 500)])
    pieces = inside.groupBy("metric", "prob").agg(F.percentile_approx("value", grid, F.lit(SKETCH)).alias("cuts"))
    cut = inside.join(F.broadcast(pieces), ["metric", "prob"]).select(
        "metric", "prob", "value", "n", F.size(F.filter("cuts", lambda c: c < F.col("value"))).alias("piece"))
    upto = W.partitionBy("metric", "prob").orderBy("piece").rowsBetween(W.unboundedPreceding, 0)
    sums = cut.groupBy("metric", "prob", "piece").agg(F.sum("n").alias("pn")).withColumn("upto", F.sum("pn").over(upto))
    held = sums.join(F.broadcast(brackets), ["metric", "prob"]).withColumn("from", F.col("below") + F.col("upto") - F.col("pn"))
    held = held.where((F.ceil("pos") >= F.col("from")) & (F.floor("pos") < F.col("below") + F.col("upto")))
    within = W.partitionBy("metric", "prob", "piece").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = cut.join(F.broadcast(held.select("metric", "prob", "piece", "pos", "from")), ["metric", "prob", "piece"]).withColumn(
        "end", F.col("from") + F.sum("n").over(within)).withColumn("start", F.col("end") - F.col("n"))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("end")), F.col("value")))

    found = ranked.groupBy("metric", "prob").agg(
        at(F.floor("pos")).alias("low"), at(F.ceil("pos")).alias("high"), F.first(F.col("pos") - F.floor("pos")).alias("part"))
    return found.select("metric", "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("quantile"))


def equal_width_bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin; right edge open except for the last bin."""
    width = (hi - lo) / F.lit(float(bins))
    return F.least(F.floor((value - lo) / width), F.lit(bins - 1)).cast("bigint")


def hash_int(*seeds: Column | str | int, digits: int = 13) -> Column:
    """Whole number of ``digits`` hex digits from an md5 of the arguments."""
    cols = [F.lit(str(s)) if isinstance(s, (int, str)) else s.cast("string") for s in seeds]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, digits), 16, 10).cast("bigint")


def uniform(*seeds: Column | str | int) -> Column:
    """Uniform (0, 1) number from a hash of its arguments: a recomputed task
    draws the same value again, unlike ``rand``, and any engine with md5 can."""
    return (hash_int(*seeds).cast("double") + 0.5) / F.lit(float(2**52))


def gaussian(*seeds: Column | str | int) -> Column:
    """Standard normal number from a hash of its arguments (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.log(uniform("radius", *seeds)))
    return radius * F.cos(2.0 * F.pi() * uniform("angle", *seeds))
