"""Joins and components that stay spread out when a few keys hold much of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from listingmill.sources.workspace import stage

#: A key is hot from this share of a table on, so there are at most as many hot keys as this says.
MOST_HOT_KEYS = 10_000
LEAST_HOT_ROWS = 1_000


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, slots) of the keys that hold more than ``1 / MOST_HOT_KEYS`` of all rows (and ``LEAST_HOT_ROWS``), with the
    number of slots that cuts them into pieces of that size.  ``MOST_HOT_KEYS`` rows at most, so it may be broadcast.

    ``df`` is read twice, so it should be a stored table."""
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    return _hot(counts, df.agg(F.count(F.lit(1))).scalar())


def hot_counts(counts: DataFrame, key: str, size: str) -> DataFrame:
    """The same of a table whose keys are counted already: a row per ``key`` and the ``size`` of it."""
    return _hot(counts.select(F.col(key).alias("_hot"), F.col(size).alias("_n")), counts.agg(F.sum(size)).scalar())


def _hot(counts: DataFrame, total: Column) -> DataFrame:
    piece = F.greatest(F.lit(LEAST_HOT_ROWS), F.floor(total / F.lit(MOST_HOT_KEYS)) + 1)
    return counts.where(F.col("_n") > piece).select("_hot", F.ceil(F.col("_n") / piece).cast("int").alias("_slots"))


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Inner join on ``key``, whose hot values in ``left`` are dealt to several slots that each get the rows of ``right``.

    ``left`` should be a stored table, ``right`` have few rows per key.  Columns other than ``key`` must differ.  ``hot``
    are the hot keys where they are known.
    """
    hot = F.broadcast(hot_keys(left, key) if hot is None else hot)
    return _dealt(left, hot, key).join(_repeated(right, hot, key), [key, "_slot"]).drop("_slot")


def _slotted(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return df.join(hot, df[key] == F.col("_hot"), "left").withColumn("_slots", F.coalesce("_slots", F.lit(1))).drop("_hot")


def _dealt(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Each row in one slot of its key."""
    return _slotted(df, hot, key).withColumn("_slot", F.pmod(F.xxhash64(*df.columns), F.col("_slots")).cast("int")).drop("_slots")


def _repeated(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Each row in all slots of its key."""
    return _slotted(df, hot, key).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1))).drop("_slots")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``links`` (a, b); ``root`` is the smallest node that can be reached.

    Labels fall to the smallest label next door and then jump to the label of their label, until none changes.  A node
    with very many links is cut into slots, as is a label that very many nodes share.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a != b").distinct()
    edges = stage(both, "edges")
    hot = F.broadcast(hot_keys(edges, "b"))  # as hot in a, which only meets an aggregate
    dealt = stage(_dealt(edges, hot, "b"), "dealt-edges")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        beside = _repeated(labels.select(F.col("node").alias("b"), "root"), hot, "b")
        near = dealt.join(beside, ["b", "_slot"]).groupBy("a").agg(F.min("root").alias("near"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        low = stage(low, "labels")
        jumped = spread_join(low, low.select(F.col("node").alias("low"), F.col("low").alias("root")), "low")
        changed = Observation()
        new = jumped.select("node", "old", F.least("low", "root").alias("root")).observe(
            changed, F.count_if(F.col("root") != F.col("old")).alias("nodes"))
        labels = stage(new.select("node", "root", "old"), "labels").select("node", "root")
        if not changed.get["nodes"]:
            return labels
