"""Benchmark items inside documents: size-partitioned MinHash containment search with exact verification.

Shingles are ``width`` words, lower-cased. Items are partitioned by the size of their shingle set, so that one signature
length serves a partition: an item is contained at ``threshold`` if at most ``(1 - threshold) * size`` of its shingles are
missing, so of its ``floor((1 - threshold) * upper size) + 1`` smallest hashes - its MinHash signature - at least one is in
the document. The search therefore loses nothing, however long the document is. Document hashes probe the signatures by an
equi join; the signature table is broadcast only while its counted rows are under ``BROADCAST_ROWS``, else the join
shuffles. Candidates are verified on the shingles themselves, as sets. Only built-in functions are used.

Defined cases: null texts count as empty; an item or document of fewer than ``width`` words has no shingle and meets
nothing; rows that repeat an id and text are one item or document; of rows with one id and different texts the best
containment is reported; empty tables give an empty result; columns other than the id and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmill.sources.workspace import stage

WIDTH = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    spaced = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(spaced, " ", -1), lambda w: w != "")


def _starts(words: Column, width: int) -> Column:
    return F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(
        F.array().cast("array<int>"))


def _with_shingles(rows: DataFrame, name: str, width: int) -> DataFrame:
    """Adds the set of shingles of ``words``. (Lists that a lambda looks into are columns, or each step would rebuild them.)"""
    placed = rows.withColumn("at", _starts(F.col("words"), width))
    return placed.withColumn(name, F.array_distinct(F.transform(
        "at", lambda i: F.array_join(F.slice("words", i, width), " ")))).drop("at")


def _with_hashes(rows: DataFrame, width: int) -> DataFrame:
    """Adds one hash per shingle position, from the hashes of its words."""
    placed = rows.withColumn("each", F.transform("words", lambda w: F.xxhash64(w))).withColumn(
        "at", _starts(F.col("words"), width))
    return placed.withColumn("hashes", F.transform(
        "at", lambda i: F.xxhash64(*[F.get("each", i - 1 + k) for k in range(width)]))).drop("each", "at")


def _signatures(items: DataFrame, width: int, threshold: float) -> DataFrame:
    """(hash, item_key): the smallest hashes of each item, as many as its size partition asks for."""
    sized = _with_hashes(items, width).select("item_key", F.array_sort(F.array_distinct("hashes")).alias("hashes"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.size("hashes"), F.lit(1)).cast("double"))))  # partitions of doubling size
    length = (F.floor(upper * (1 - threshold) + 1e-9) + 1).cast("int")
    found = sized.select(F.explode_outer(F.slice("hashes", F.lit(1), length)).alias("hash"), "item_key")
    return found.filter("hash is not null")


def _doc_key(docs: DataFrame) -> Column:
    """What tells documents apart: rows that repeat an id, or have none, can have different texts."""
    return F.struct(docs["doc_id"], F.md5(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("h"))


def _pairs(docs: DataFrame, benchmark: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs doc_key, item_key with shared, item_shingles and containment, where the item is contained."""
    items = stage(benchmark.select(benchmark["item_id"], _words(benchmark["text"]).alias("words")).withColumn(
        "item_key", F.struct("item_id", F.md5(F.array_join("words", " ")).alias("h"))).dropDuplicates(["item_key"]), "items")
    signatures = stage(_signatures(items, width, threshold), "signatures")
    rows = docs.select(_doc_key(docs).alias("doc_key"), docs["text"])
    worded = rows.select("doc_key", _words(F.col("text")).alias("words"))
    # outer, as the planner would otherwise test each list for being empty before it is built, and so build it twice
    probes = _with_hashes(worded, width).select("doc_key", F.explode_outer("hashes").alias("hash"))
    small = signatures.count() <= BROADCAST_ROWS
    met = probes.join(F.broadcast(signatures) if small else signatures, "hash")
    candidates = stage(met.select("doc_key", "item_key").distinct(), "candidates")

    texts = rows.join(candidates.select("doc_key").distinct(), "doc_key", "left_semi").dropDuplicates(["doc_key"])
    ours = _with_shingles(items, "item_set", width).select("item_key", "item_set")
    worded = _with_shingles(texts.select("doc_key", _words(F.col("text")).alias("words")), "doc_set", width)
    theirs = candidates.join(worded.select("doc_key", "doc_set"), "doc_key")
    both = theirs.join(ours, "item_key").select("doc_key", "item_key", "doc_set", "item_set")
    pairs = both.select(
        "doc_key", "item_key", F.size(F.array_intersect("item_set", "doc_set")).cast("long").alias("shared"),
        F.size("item_set").cast("long").alias("item_shingles"))
    return pairs.filter(F.col("shared") >= F.lit(threshold) * F.col("item_shingles")).withColumn(
        "containment", F.col("shared") / F.col("item_shingles"))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs doc_id, item_id with shared, item_shingles (long) and containment of the item in the document."""
    found = _pairs(docs, benchmark, width, threshold)
    best = found.groupBy(F.col("doc_key.doc_id").alias("doc_id"), F.col("item_key.item_id").alias("item_id")).agg(
        F.max(F.struct("containment", "shared", "item_shingles")).alias("b"))
    return best.select("doc_id", "item_id", "b.shared", "b.item_shingles", "b.containment")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no benchmark item is contained, all columns unchanged."""
    found = _pairs(docs, benchmark, width, threshold).select(
        F.col("doc_key.doc_id").alias("found_id"), F.col("doc_key.h").alias("found_h")).distinct()
    # the row travels as one value, so that its columns may have any names
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _doc_key(docs).alias("key"))
    left = rows.join(found, F.col("key.doc_id").eqNullSafe(F.col("found_id")) & (F.col("key.h") == F.col("found_h")), "left_anti")
    return left.select("row.*")
