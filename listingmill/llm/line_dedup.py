"""Repeated runs of lines, from a suffix array over line-id sequences built by distributed prefix doubling.

Every line of every document starts a suffix. Suffixes are ranked by their first line, and then round by round by the
rank of their first ``h`` lines and the rank of the suffix ``h`` lines further on, which doubles ``h``. A rank is the number
of suffixes that are smaller as far as is known, so ranks of different rounds compare, and only suffixes whose first ``h`` lines
occur elsewhere take part in the next round; lines that occur once are never ranked. Sorted by rank, neighbouring suffixes share the longest common prefixes; their
lengths are read off the ranks of the rounds, longest first. A run of ``min_lines`` lines that occurs more than once is an
interval of the suffix array; its first place (smallest ``doc_id``, then line) stays and the lines under every other place
go, so that overlapping runs unite to maximal ones. Only built-in functions are used.

No group of equal lines or runs meets in one task: groups are counted with partial aggregation, ranked by sampled ranges of
their keys, and joined back with hot keys cut into slots. All other joins are by document and line, which are unique.

Defined cases: a null text counts as empty (one empty line); a null ``doc_id`` sorts before all others; rows that repeat
``doc_id`` and text are one document, and each gets the same result; a line without a visible character starts no run, so
that on its own it stays; a run may overlap its own copy; a text of any length is one row and its lines are rows of their
own; an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingmill.functions.relational import dense_ids
from listingmill.functions.skew import hot_counts, spread_join
from listingmill.sources.workspace import stage

MIN_LINES = 1
_PLACE = ["key", "line"]


def _suffixes(docs: DataFrame) -> DataFrame:
    """(key, line, left, a, b): a row per line; ``left`` lines from it to the end, ``b`` its 128-bit id."""
    names = docs.select("key", F.transform(F.split("body", "\n", -1), lambda x: F.unhex(F.md5(x))).alias("names")).dropDuplicates(["key"])
    # outer, as the planner would otherwise test each list for being empty before it is built, and so build it twice
    lines = names.select("key", F.size("names").alias("n"), F.posexplode_outer("names").alias("line", "b"))
    return stage(lines.select("key", "line", (F.col("n") - F.col("line")).alias("left"), F.lit(0).cast("long").alias("a"), "b"), "line-ids")


def _placed(groups: DataFrame) -> DataFrame:
    """The groups (a, b, size), stored sorted in sampled ranges, with their ``range`` and ``row``."""
    ranges = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id()
    placed = groups.repartitionByRange(ranges, "a", "b").sortWithinPartitions("a", "b")
    return stage(placed.select("*", F.shiftright(row, 33).alias("range"), row.alias("row")), "line-groups")


def _refined(groups: DataFrame) -> DataFrame:
    """(group, rank, size): ``a`` plus the members of the same ``a`` in groups with a smaller ``b``."""
    return _summed(_placed(groups))


def _summed(placed: DataFrame) -> DataFrame:
    """The ranks of stored groups, summed up within their ranges; one row per range carries its last ``a`` on to the next."""
    ends = placed.groupBy("range").agg(F.min("a").alias("low"), F.max("a").alias("high"))
    tails = placed.join(F.broadcast(ends), "range").filter(F.col("a") == F.col("high")).groupBy("range", "low", "high").agg(
        F.sum("size").alias("n"))
    upto = F.sum("n").over(W.partitionBy("high").orderBy("range").rowsBetween(W.unboundedPreceding, 0))
    earlier = F.lag(F.struct("high", "upto")).over(W.orderBy("range"))
    before = tails.withColumn("upto", upto).select("range", F.col("low").alias("a"), earlier.alias("e")).filter(
        F.col("e.high") == F.col("a")).select("range", "a", F.col("e.upto").alias("carried"))
    within = W.partitionBy("range", "a").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    summed = placed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rank = F.col("a") + F.col("inside") + F.coalesce("carried", F.lit(0))
    return summed.join(F.broadcast(before), ["range", "a"], "left").select(
        F.struct("a", "b").alias("group"), rank.alias("rank"), "size")


def _ranked(members: DataFrame, least: int = 1) -> DataFrame:
    """(key, line, left, rank, size): suffixes of equal rank ``a`` told apart by ``b``; ``size`` of them stay equal, and
    those of which fewer than ``least`` do are left out."""
    placed = _placed(members.groupBy("a", "b").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least))
    hot = hot_counts(placed.select(F.struct("a", "b").alias("group"), "size"), "group", "size")
    held = members.select(*_PLACE, "left", F.struct("a", "b").alias("group"))
    return stage(spread_join(held, _summed(placed), "group", hot).select(*_PLACE, "left", "rank", "size"), "line-ranks")


def _doubled(suffixes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The ranks by 1, 2, 4 ... lines of the suffixes whose so many first lines occur elsewhere, and the last rank of each
    suffix whose first line does, with the last level (``top``) at which it is ranked.

    A line that occurs once gets no rank: a suffix that goes on with one differs there from all others, wherever it sorts."""
    state, h, levels, settled = _ranked(suffixes, least=2), 1, [], []
    while True:
        open_ = (F.col("size") > 1) & (F.col("left") >= h)  # those that end here come first among their equals
        members = state.filter(open_)
        levels.append(members.select(*_PLACE, "rank"))
        if members.filter(F.col("left") > h).isEmpty():
            top = len(levels) - 2
            known = [s.withColumn("top", F.lit(i - 1)) for i, s in enumerate(settled)]
            return levels, _union([*known, state.withColumn("top", F.when(open_, top + 1).otherwise(top))]).select(*_PLACE, "rank", "top")
        settled.append(state.filter(~open_))
        after = _union([*settled, members]).filter(F.col("line") >= h).select(
            "key", (F.col("line") - h).alias("line"), F.col("rank").alias("b"))
        once = F.when(F.col("left") > h, -2 - F.monotonically_increasing_id()).otherwise(-1)
        pairs = members.join(after, _PLACE, "left").select(
            *_PLACE, "left", F.col("rank").alias("a"), F.coalesce("b", once).alias("b"))
        state, h = _ranked(stage(pairs, "line-pairs")), 2 * h


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def _longest(levels: list[DataFrame], ranks: DataFrame) -> DataFrame:
    """(key, longest): the most lines that a suffix of the document shares from its first on with any other suffix.

    Neighbours in the suffix array are compared by their ranks, at the longest level that both have first; what is equal is
    skipped.  A suffix ranked at ``top`` shares at least ``2 ** top`` lines and less than twice as many, so only
    those of a document's highest ``top`` are compared."""
    deep = F.col("top") == F.max("top").over(W.partitionBy("key"))
    numbered = dense_ids(ranks.select(*_PLACE, "rank", "top", deep.alias("deep")), ["rank", *_PLACE], out="at")
    order = stage(numbered.select("at", *_PLACE, "top", "deep"), "line-order")
    ahead = order.select((F.col("at") + 1).alias("at"), F.col("key").alias("key2"), F.col("line").alias("line2"),
                         F.col("top").alias("top2"), F.col("deep").alias("deep2"))
    met = order.join(ahead, "at").filter(F.col("deep") | F.col("deep2"))
    pairs = stage(met.select("key", "line", "key2", "line2", F.lit(0).alias("common"), F.least("top", "top2").alias("top")), "line-neighbours")
    compared = None
    for k in reversed(range(len(levels))):
        begun = pairs.filter(F.col("top") == k).drop("top")
        held = begun if compared is None else compared.unionAll(begun)
        here = levels[k].select("key", F.col("line").alias("l"), F.col("rank").alias("r"))
        there = levels[k].select(F.col("key").alias("key2"), F.col("line").alias("l2"), F.col("rank").alias("r2"))
        met = held.withColumns({"l": F.col("line") + F.col("common"), "l2": F.col("line2") + F.col("common")})
        met = met.join(here, ["key", "l"], "left").join(there, ["key2", "l2"], "left")
        more = F.when(F.col("r") == F.col("r2"), F.lit(1 << k)).otherwise(F.lit(0))
        compared = stage(met.select("key", "line", "key2", "line2", (F.col("common") + more).alias("common")), "line-compared")
    both = compared.select("key", "common").unionAll(compared.select("key2", "common"))
    return both.groupBy("key").agg(F.max("common").alias("longest"))


def _later(levels: list[DataFrame], min_lines: int) -> DataFrame:
    """(key, line) of all places but the first of each run of ``min_lines`` lines: intervals of the suffix array, told apart
    by the ranks of the two longest levels that cover them."""
    k = min_lines.bit_length() - 1
    if k >= len(levels):
        return levels[0].select(*_PLACE).filter("false")  # no run is that long
    rest = min_lines - (1 << k)
    name = levels[k].withColumn("end", F.col("rank"))
    if rest:
        ends = levels[k].filter(F.col("line") >= rest).select("key", (F.col("line") - rest).alias("line"), F.col("rank").alias("end"))
        name = levels[k].join(ends, _PLACE)
    places = stage(name.select(*_PLACE, F.struct("rank", "end").alias("run")), "line-runs")
    first = places.groupBy("run").agg(F.min(F.struct(*_PLACE)).alias("first"))
    return spread_join(places, first, "run").filter(F.struct(*_PLACE) != F.col("first")).select(*_PLACE)


def line_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_runs (maximal removed runs), longest_run (lines of the longest run
    of this document that also starts at another place of any document, kept or not), kept_text."""
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), body.alias("body")).withColumn(
        "key", F.struct(F.col("doc_id"), F.xxhash64("body").alias("h")))
    levels, ranks = _doubled(_suffixes(rows))
    longest = _longest(levels, ranks)
    starts = _later(levels, min_lines).groupBy("key").agg(F.collect_list("line").alias("starts"))
    marks = stage(longest.join(starts, "key", "left").select(F.col("key").alias("k"), "longest", "starts"), "line-marks")
    return _apply(rows.join(marks, F.col("key").eqNullSafe(F.col("k")), "left"), min_lines)


def _visible(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _apply(joined: DataFrame, min_lines: int) -> DataFrame:
    out = joined.select("doc_id", "longest", F.split("body", "\n", -1).alias("lines"), "starts")
    begun = F.filter("starts", lambda s: _visible(F.get("lines", s)))
    covered = F.array_distinct(F.flatten(F.transform(begun, lambda s: F.sequence(s, s + F.lit(min_lines - 1)))))
    out = out.select("doc_id", "longest", "lines", F.coalesce(covered, F.array().cast("array<int>")).alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")  # by hash, so linear in the lines
    heads = F.array_except("gone", F.transform("gone", lambda i: i + 1))
    out = out.select("doc_id", "longest", "lines", "gone", kept.alias("kept"), heads.alias("heads"))
    return out.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
        F.size("heads").cast("long").alias("n_runs"), F.coalesce("longest", F.lit(0)).cast("long").alias("longest_run"),
        F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n").alias("kept_text"))
