"""Exact duplicates by content sort.

Texts are range-partitioned with sampled splitters on their head (a text hash breaks the ties of shared beginnings), sorted
externally, and equal texts, now adjacent, are told apart by comparing neighbours in full; each run keeps one identifier. Only a
text that holds more than a ten-thousandth of all rows (and ``LEAST_HOT_ROWS``) is cut, by its rows' identifiers, into runs of about that size.
Such texts are fewer than ``MOST_HOT_TEXTS``: their runs are merged by SHA-256 and broadcast, so no row is dealt by its text
again. Only built-in functions are used.

Defined cases: a null text counts as empty; texts of any length are compared whole, by one task each; a null ``doc_id`` loses
against any other; of rows that repeat the same ``doc_id`` and text exactly one is kept; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are ignored by ``exact_duplicates`` and carried by ``drop_exact_duplicates``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingmill.sources.workspace import stage

MOST_HOT_TEXTS = 10_000
LEAST_HOT_ROWS = 100
HEAD_CHARS = 64


def unchanged(text: Column) -> Column:
    return text


def _better(column: str, keep: str) -> Column:
    return F.desc_nulls_last(column) if keep == "largest" else F.asc_nulls_last(column)


def _best(keep: str) -> Callable[[str], Column]:
    return F.max if keep == "largest" else F.min


def _runs(docs: DataFrame, normalise: Callable[[Column], Column], keep: str) -> DataFrame:
    """(row, doc_id, sha, hot, place, run_best, run_size): rows of equal texts in one run, or in several if the text is hot.

    The row travels as one value, so that its columns may have any names.
    """
    body = F.coalesce(normalise(F.col("row")["text"].cast("string")), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    # splitters are sampled from the heads, as whole texts would be too large for the driver
    keyed = rows.select("row", F.substring(body, 1, HEAD_CHARS).alias("head"), F.xxhash64(body).alias("text_hash"))
    counts = stage(keyed.groupBy(F.col("text_hash").alias("hot_hash")).agg(F.count(F.lit(1)).alias("n")), "text-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    piece = max(LEAST_HOT_ROWS, total // MOST_HOT_TEXTS + 1)
    hot = F.broadcast(counts.filter(F.col("n") > piece).select("hot_hash", F.ceil(F.col("n") / piece).alias("slots")))
    slot = F.when(F.col("slots").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col("row")["doc_id"]), F.col("slots")))
    dealt = keyed.join(hot, F.col("text_hash") == F.col("hot_hash"), "left").select(
        "row", "head", "text_hash", slot.alias("slot"), F.col("slots").isNotNull().alias("hot")).repartitionByRange(
        "head", "text_hash", "slot")
    texts = dealt.withColumns({"body": body, "doc_id": F.col("row")["doc_id"]})
    whole = Window.partitionBy("head", "text_hash", "slot", "body")
    return texts.select(
        "row", "doc_id", F.unhex(F.sha2("body", 256)).alias("sha"), "hot",
        F.row_number().over(whole.orderBy(_better("doc_id", keep))).alias("place"),
        _best(keep)("doc_id").over(whole).alias("run_best"), F.count(F.lit(1)).over(whole).alias("run_size"))


def _merged(runs: DataFrame, keep: str) -> DataFrame:
    """``runs`` with keep_id and group_size over all runs of the text; at most ``MOST_HOT_TEXTS`` texts have several."""
    several = runs.filter("hot and place = 1").groupBy(F.col("sha").alias("hot_sha")).agg(
        _best(keep)("run_best").alias("best"), F.sum("run_size").alias("size"))
    met = runs.join(F.broadcast(several), F.col("sha") == F.col("hot_sha"), "left")
    return met.withColumns({
        "keep_id": F.when(F.col("hot"), F.col("best")).otherwise(F.col("run_best")),
        "group_size": F.when(F.col("hot"), F.col("size")).otherwise(F.col("run_size"))})


def _stays() -> Column:
    """Rows of one text and identifier are in one run, so that one row is first in its run and has the identifier that stays."""
    return (F.col("place") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))


def exact_duplicates(docs: DataFrame, normalise: Callable[[Column], Column] = unchanged, keep: str = "smallest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 of the normalised text.

    ``keep`` names the identifier that stays of equal texts: ``smallest`` or ``largest``.
    """
    runs = stage(_runs(docs.select("doc_id", "text"), normalise, keep).drop("row"), "exact-runs")
    return _merged(runs, keep).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), _stays().alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, normalise: Callable[[Column], Column] = unchanged, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    firsts = stage(_runs(docs, normalise, keep).filter("place = 1"), "exact-firsts")
    return _merged(firsts, keep).filter(_stays()).select("row.*")
