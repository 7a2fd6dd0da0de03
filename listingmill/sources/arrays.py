"""Large JSON files read in byte ranges, though a record may begin and end anywhere.

Spark's text reader cuts a file at closing braces, a character that is never the second half of an escape, so every byte
range yields whole pieces.  What a brace means depends on all text before it: whether a string is open, and how many objects.
Each range is therefore summed up for both ways its start can be; the sums (one row per range) are added up along each file,
and a second pass over the ranges, now with their true starts, puts the pieces of every record together.  Only a
record that a range border cuts through travels: its parts meet by file and record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listingmill.sources.workspace import stage

SUMS = "file long, start long, flips int, depth_out long, depth_in long"
PARTS = "file long, start long, place long, text string, closed boolean, whole boolean"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, piece, flips, open_out, open_in) in file order: text up to a closing brace, whether it
    opens or ends a string, and the objects that it opens if it begins outside or inside of a string."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    at = F.col("_metadata")
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # escapes never tell where a string ends
    rows = text.select(F.xxhash64(at["file_path"]).alias("file"), at["file_block_start"].alias("start"),
                       F.col("value").alias("piece"), plain.alias("plain"))

    def count(column, char: str):
        return (F.length(column) - F.length(F.replace(column, F.lit(char), F.lit("")))).cast("int")

    outside = F.regexp_replace("plain", '"[^"]*("|$)', "")
    inside = F.regexp_replace(F.regexp_replace("plain", '^[^"]*("|$)', ""), '"[^"]*("|$)', "")
    return rows.select("file", "start", "piece", (count(F.col("plain"), '"') % 2).alias("flips"),
                       count(outside, "{").alias("open_out"), count(inside, "{").alias("open_in"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """The stretches of a batch that come from one range, which may share a task with others."""
    columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names if name != "piece"}
    file, start = columns["file"], columns["start"]
    borders = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    for lo, hi in zip([0, *borders], [*borders, len(file)]):
        if hi > lo:
            yield int(lo), int(hi), {name: values[lo:hi] for name, values in columns.items()}


def _states(run: dict[str, np.ndarray], within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece, begun inside of a string (1) or not: that state before it, the objects it opens, and its brace closing one."""
    after = (np.cumsum(run["flips"]) + within) % 2
    before = np.concatenate([[within], after[:-1]])
    return before, np.where(before == 1, run["open_in"], run["open_out"]), after == 0


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: whether it flips strings, and the objects it leaves open from either beginning."""
    key, flips, depth = None, 0, [0, 0]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"file": pa.array([key[0]], pa.int64()), "start": pa.array([key[1]], pa.int64()), "flips": pa.array([flips], pa.int32()),
             "depth_out": pa.array([depth[0]], pa.int64()), "depth_in": pa.array([depth[1]], pa.int64())})

    for batch in batches:
        for _, _, run in _runs(batch):
            here = (int(run["file"][0]), int(run["start"][0]))
            if here != key:
                if key is not None:
                    yield row()
                key, flips, depth = here, 0, [0, 0]
            for begun in (0, 1):
                _, opened, closes = _states(run, (begun + flips) % 2)
                depth[begun] += int(opened.sum() - closes.sum())
            flips = int((flips + run["flips"].sum()) % 2)
    if key is not None:
        yield row()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that begin and end in their range as wholes; what the borders cut off as parts, in order."""
    key, within, depth, held, place, fresh = None, 0, 0, [], 0, False

    def part(closed: bool) -> tuple:
        return (*key, place, "}".join(held) + "}", closed, closed and fresh)

    def rows(made: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
        names = ["file", "start", "place", "text", "closed", "whole"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

    for batch in batches:
        made: list[tuple] = []
        texts = batch.column("piece")
        for lo, hi, run in _runs(batch):
            here = (int(run["file"][0]), int(run["start"][0]))
            if here != key:
                if held:
                    made.append(part(False))
                key, held, place = here, [], 0
                within, depth = int(run["within"][0]), int(run["depth"][0])
                fresh = within == 0 and depth == 0  # else the first record began in an earlier range
            before, opened, closes = _states(run, within)
            level = depth + np.cumsum(opened - closes)
            ends = np.flatnonzero(closes & (level == 0))
            pieces, first = texts.slice(lo, hi - lo).to_pylist(), 0
            for end in ends:
                held.extend(pieces[first:end + 1])
                made.append(part(True))
                held, first, place, fresh = [], int(end) + 1, place + 1, True
            held.extend(pieces[first:])
            within, depth = int((before[-1] + run["flips"][-1]) % 2), int(level[-1])
        if made:
            yield rows(made)
    if held:
        yield rows([part(False)])


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every object of the JSON files under ``path``."""
    pieces = _pieces(spark, path)
    sums = pieces.drop("piece").mapInArrow(_sum_up, SUMS)
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("within", (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int"))
    opened = F.when(F.col("within") == 1, F.col("depth_in")).otherwise(F.col("depth_out"))
    starts = sums.withColumn("opened", opened).select(
        F.col("file").alias("_file"), F.col("start").alias("_start"), "within",
        F.coalesce(F.sum("opened").over(before), F.lit(0)).alias("depth"))
    # one row per byte range; the hint keeps the order of the pieces, which a shuffled join would not
    begun = pieces.join(F.broadcast(stage(starts, "ranges")), (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
    parts = stage(begun.drop("_file", "_start").mapInArrow(_assemble, PARTS), "records")
    earlier = W.partitionBy("file").orderBy("start", "place").rowsBetween(W.unboundedPreceding, -1)
    cut = parts.where("not whole").withColumn("record", F.coalesce(F.sum(F.col("closed").cast("long")).over(earlier), F.lit(0)))
    joined = cut.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "text", "closed"))).alias("parts"))
    stitched = joined.select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    return parts.where("whole").select("text").union(stitched).select(
        F.regexp_replace("text", r"^[\s\x{FEFF},\[\]]+", "").alias("record")).where(F.col("record").startswith("{"))


def read_json_arrays(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The objects of JSON arrays as rows, each file read by as many tasks as it has byte ranges.

    Files may hold one array of objects, one object, or objects one after the other (JSON lines), in UTF-8, laid out in any
    way.  An object that does not parse is a row of nulls, and a file that ends inside of an object gives a row for the rest;
    other files are not affected.  Empty files and arrays have no rows, and elements that are no objects are none.
    """
    parsed = json_records(spark, path).select(F.from_json("record", schema).alias("r"))
    return parsed.select("r.*")
