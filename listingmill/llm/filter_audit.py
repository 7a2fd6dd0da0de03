"""Audit of how five document filters interact, under every order in which they can be applied.

Each document has a mask: a bit per filter that it fails. Documents are counted per (part, mask), at most 32 cells a part, with
the weights documents, good ones and toxic ones. Every cell then folds over the array of all 120 orders, a literal of fixed
size that travels with the plan: ``transform`` goes over the orders, ``aggregate`` applies an order's filters left to right to
the cell and keeps a struct of weights per step, 600 in all. The cells of a part are merged by elementwise sums. The folds see
cells, never documents, so their work depends on the number of parts alone.

Filter conditions (words: maximal runs of other characters than ASCII white space, case-sensitive): A, fewer than 200 words; B,
less than half of the words distinct; C, more than 2 % of the code points in A-Z; D, any of ``#$%&*|``; E, the same text as a
document with a smaller ``doc_id``, table-wide. For E the smallest ``doc_id`` of each text digest (SHA-256) is found by a
pre-aggregated minimum; documents then meet it by (digest, doc_id), so the rows of a large group of copies lie apart.

Defined cases: a null text counts as empty; documents with a null ``doc_id`` neither fail E nor make others fail, and have no
label; rows that repeat a ``doc_id`` are documents each, and of equal texts with the smallest ``doc_id`` none fails E; a null part
counts as the empty string; a document is good (toxic) if any of its label rows says so, others are neither; texts of any length
are measured whole; an empty table gives an empty result, an empty or null label table no good or toxic ones; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmill.sources.workspace import stage

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WEIGHTS = ("docs", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def measured(docs: DataFrame, part: str) -> DataFrame:
    """(doc_id, part, mask, digest): the mask has the bits of A to D."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", r"[ \t-\r]+", -1), lambda w: w != F.lit("")))
    total, distinct = F.size("words"), F.size(F.array_distinct("words"))
    fails = {
        "A": total < MIN_WORDS,
        "B": F.lit(100) * distinct < F.lit(MIN_DISTINCT_PERCENT) * total,
        "C": F.lit(100) * F.regexp_count("text", F.lit("[A-Z]")) > F.lit(MAX_CAPITALS_PERCENT) * F.length("text"),
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }
    mask = reduce(Column.__add__, (F.when(c, bit(k)).otherwise(0) for k, c in fails.items()))
    return rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def weighted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the weights docs, good and toxic."""
    sure = labels.select(labels["doc_id"], *[F.coalesce((labels[c] == 1).cast("long"), F.lit(0)).alias(c) for c in ("quality", "toxic")])
    known = sure.filter(sure["doc_id"].isNotNull() & (F.col("quality") + F.col("toxic") > 0)).groupBy(
        F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    # rows without an id meet nothing; a second key keeps them apart
    known = known.withColumn("spread", F.lit(0).cast("long"))
    apart = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    met = apart.join(known, (F.col("doc_id") == F.col("labelled")) & (apart["spread"] == known["spread"]), "left")
    return met.select(*rows.columns, F.lit(1).cast("long").alias("docs"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def cells(rows: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents per part and mask of all five filters."""
    copies = bit("E")
    named = rows.filter("doc_id is not null")
    first = named.groupBy(F.col("digest").alias("d")).agg(F.min("doc_id").alias("first"))
    firsts = named.join(first, (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("first")))

    def counted(some: DataFrame, mask: Column, sign: int) -> DataFrame:
        return some.groupBy("part", mask.alias("mask")).agg(*[(F.lit(sign) * F.sum(w)).alias(w) for w in WEIGHTS])

    # all documents with an id count as copies; then the first of each text move to the cell without E
    parts = [counted(rows, F.when(F.col("doc_id").isNull(), F.col("mask")).otherwise(F.col("mask") + copies), 1),
             counted(firsts, F.col("mask") + copies, -1), counted(firsts, F.col("mask") + F.lit(0), 1)]
    return reduce(DataFrame.unionByName, parts).groupBy("part", "mask").agg(*[F.sum(w).alias(w) for w in WEIGHTS])


def _zero() -> Column:
    return F.lit(0).cast("long")


def _folded() -> Column:
    """600 structs of a cell: order by order, step by step."""
    orders = F.array(*[F.array(*[F.lit(bit(f)) for f in order]) for order in ORDERS])

    def step(state: Column, one: Column) -> Column:
        fails = F.col("mask").bitwiseAND(one) != 0
        here, before = state["alive"] & fails, ~state["alive"] & fails
        made = F.struct(
            F.when(state["alive"] & ~fails, F.col("docs")).otherwise(_zero()).alias("kept"),
            F.when(here, F.col("docs")).otherwise(_zero()).alias("removed"),
            F.when(before, F.col("docs")).otherwise(_zero()).alias("redundant"),
            F.when(F.col("mask") == one, F.col("docs")).otherwise(_zero()).alias("unique_fails"),
            F.when(here, F.col("good")).otherwise(_zero()).alias("good_lost"),
            F.when(here, F.col("toxic")).otherwise(_zero()).alias("toxic_lost"))
        return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["steps"], F.array(made)).alias("steps"))

    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(kind).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def _merged(folds: Column) -> Column:
    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))

    rest = F.slice(folds, F.lit(2), F.size(folds))
    return F.aggregate(rest, F.get(folds, F.lit(0)), add)


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, filter_order (all 120) and step (1 to 5): kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley, the removals of the step's filter summed over all orders.

    ``labels``: doc_id, quality and toxic, 1 for good and for toxic ones.
    """
    rows = stage(weighted(measured(docs, part), labels), "filter-masks")
    counted = stage(cells(rows), "filter-cells")
    folded = counted.select("part", _folded().alias("fold"))
    merged = folded.groupBy("part").agg(F.collect_list("fold").alias("folds"))  # 32 folds a part at most
    steps = merged.select("part", _merged(F.col("folds")).alias("sums"))
    # removals per filter over all orders, from the place of each filter in each order
    places = {f: [5 * i + order.index(f) for i, order in enumerate(ORDERS)] for f in FILTERS}
    shapley = F.array(*[F.aggregate(F.array(*[F.lit(p) for p in places[f]]), _zero(), lambda a, p: a + F.get("sums", p)["removed"])
                        for f in FILTERS])
    out = steps.withColumn("shapleys", shapley).select("part", "shapleys", F.posexplode("sums").alias("at", "sum"))
    order = F.get(F.array(*[F.lit(o) for o in ORDERS]), F.floor(F.col("at") / 5).cast("int"))
    out = out.withColumn("filter_order", order).withColumn("step", (F.col("at") % 5 + 1).cast("int"))
    name = F.substr("filter_order", F.col("step"), F.lit(1))
    return out.select("part", "filter_order", "step", *[F.col("sum")[c].alias(c) for c in COUNTS],
                      F.get("shapleys", F.ascii(name) - F.lit(ord("A"))).alias("shapley"))
