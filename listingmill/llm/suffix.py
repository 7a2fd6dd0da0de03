"""Repeated byte strings with a suffix array per bucket.

A byte goes if a ``length``-byte string over it also starts in a document with a smaller ``doc_id``. Every window of
``length`` bytes has an anchor, its smallest seed hash, common seeds last, so equal windows have equal anchors. Windows with an anchor that
occurs once anywhere cannot match; the others travel, as the short stretches of text under one anchor, to the bucket of
the anchor, each distinct stretch of a batch once, with the smallest and largest ``doc_id`` it has there.

A bucket builds the suffix array over its distinct stretches, in memory, and the runs of its Burrows-Wheeler transform with
samples at the run ends. The stretches are walked from right to left over the runs, which gives each suffix its row; the rows
that share the next ``length`` bytes are a block, read off the whole suffix array, and the smallest document of the block
answers the window. No matching statistics are computed and the index is not held compressed. Where all
stretches under an anchor are equal - the inside of copies, most of a repetitive corpus - the whole block is known without
an index. What the bucket sends back are runs of windows with the smallest document that has them.

Defined cases: a null text counts as empty; shorter texts keep everything; a null ``doc_id`` counts as the largest, and rows of
one ``doc_id`` never match each other; repeated rows give one row each; an empty table gives an empty result; columns other
than ``doc_id`` (whole numbers) and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmill.llm.exchange import (BYTE_VALUES, SLAB, Batch, Rolling, anchored, answer, ask, batches, by_bucket, distinct,
                                      distinct_pairs, heard, mixed, packed, unpacked)
from listingmill.sources.workspace import stage

LENGTH = 50
SEED_BYTES = 20
#: Symbols (0 to 256) that fit one 63-bit number; the doubling starts from their rank.
PACKED = 7
#: Bytes of stretches that share an index, about; it takes some hundred times as much memory while it is built.
INDEX_BYTES = 1 << 20
#: One batch in so many is counted for the list of common seeds; how often they are in a slab at least; how long the list may be.
COMMON_OF = 8
COMMON_IN_SLAB = 8
MOST_COMMON = 1 << 16
#: One run of windows: stretch, first window in it, windows, smallest document.
RUN = np.dtype([("stretch", "<u4"), ("first", "<u4"), ("count", "<u4"), ("low", "<i8")])


# --- stretches of a batch -------------------------------------------------------------

def _seeds(batch: Batch, length: int) -> Iterator[tuple[int, int, Rolling, np.ndarray]]:
    """(begin, end, rolling hash, seed hashes), a stretch of bytes at a time."""
    n = len(batch.body)
    for low in range(0, max(n - length + 1, 0), SLAB):
        high = min(n, low + SLAB + length - 1)
        roll, m = Rolling(BYTE_VALUES[batch.body[low:high]]), high - low
        yield low, high, roll, mixed(roll(slice(0, m - SEED_BYTES + 1), slice(SEED_BYTES, m + 1)))


def _common_seeds(table: DataFrame, columns: list[str], length: int) -> bytes:
    """Hashes of seeds that many documents have, at most ``MOST_COMMON``, in order.

    They come last when a window's anchor is chosen: a phrase that a large part of all documents share would otherwise be the
    anchor of as many stretches, which meet in one index. Any order finds the same windows, so one batch in ``COMMON_OF`` is counted.
    """
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                for _, _, _, seeds in _seeds(Batch(*(row[c] for c in columns)), length):
                    keys, n = np.unique(seeds, return_counts=True)
                    often = n >= COMMON_IN_SLAB
                    yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(n[often])], names=["seed", "n"])

    some = table.where(F.pmod(F.xxhash64("batch"), F.lit(COMMON_OF)) == 0).select(*columns).mapInArrow(count, "seed long, n long")
    found = some.groupBy("seed").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "seed").limit(MOST_COMMON).select("seed").collect()
    return np.sort(np.array([r[0] for r in found], dtype=np.int64)).tobytes()


@lru_cache(maxsize=2)
def _common_table(common: bytes) -> np.ndarray:
    """Of the first 22 bits of a hash: whether a common seed begins so; a few others come last with it, which does no harm."""
    table = np.zeros(1 << 22, dtype=bool)
    table[np.frombuffer(common, np.uint64) >> np.uint64(42)] = True
    return table


def _slabs(batch: Batch, length: int, common: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, windows, anchor hash, stretch hash), a stretch of bytes at a time."""
    for low, high, roll, seeds in _seeds(batch, length):
        m = high - low
        valid = np.ones(m - length + 1, dtype=bool)  # but for the last places of each document, where no window fits
        for end in batch.ends[slice(*np.searchsorted(batch.ends, [low, high], side="right"))].tolist():
            valid[max(end - length + 1 - low, 0):max(end - low, 0)] = False
        order = seeds
        if common:
            order = seeds >> np.uint64(1)
            order[_common_table(common)[seeds >> np.uint64(42)]] |= np.uint64(1 << 63)
        first, count, place = anchored(order, valid, length - SEED_BYTES + 1)
        yield first + low, count, seeds[place], mixed(roll(first, first + count + length - 1) + count.astype(np.uint64))


class Stretches:
    """Runs of windows under one anchor in a batch: ``first``, ``count``, ``seed``, ``text`` (hash) and ``doc`` (its id)."""

    def __init__(self, batch: Batch, length: int, common: bytes = b""):
        parts = list(_slabs(batch, length, common))
        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        self.first, self.count, self.seed, self.text = (
            (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, t) for t in kinds))
        self.doc = batch.ids[np.searchsorted(batch.ends, self.first, side="right")] if len(self.first) else np.zeros(0, np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, the number of each stretch's anchor, and whether several documents have it."""
        keys, group, _ = distinct(self.seed)
        low = np.full(len(keys), np.iinfo(np.int64).max)
        high = np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, group, self.doc)
        np.maximum.at(high, group, self.doc)
        return keys, group, high > low

    def choose(self, anchors: list | None, buckets: int) -> None:
        """Keep the stretches whose anchor occurs elsewhere, and number the distinct ones."""
        keys, group, _ = self.anchors()
        ok = heard(keys, anchors, buckets)[group]
        for name in ("first", "count", "seed", "text", "doc"):
            setattr(self, name, getattr(self, name)[ok])
        self.example, self.number = distinct_pairs(self.seed, self.text)
        self.low = np.full(len(self.example), np.iinfo(np.int64).max)
        self.high = np.full(len(self.example), np.iinfo(np.int64).min)
        np.minimum.at(self.low, self.number, self.doc)
        np.maximum.at(self.high, self.number, self.doc)


def _gather(body: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many stretches, one after another."""
    if not len(begin):
        return np.zeros(0, np.uint8)
    shift = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return body[shift + np.arange(len(shift))]


def _send(batch: Batch, s: Stretches, length: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    order, bounds = by_bucket(s.seed[s.example], buckets)
    for b in np.nonzero(np.diff(bounds))[0].tolist():
        mine = order[bounds[b]:bounds[b + 1]]
        at = s.example[mine]
        size = s.count[at] + length - 1
        yield b, packed(b"".join((
            np.uint64(len(mine)).tobytes(), s.seed[at].tobytes(), mine.astype("<u4").tobytes(), size.astype("<u4").tobytes(),
            s.low[mine].tobytes(), s.high[mine].tobytes(), _gather(batch.body, s.first[at], size).tobytes())))


# --- the index of a bucket --------------------------------------------------------------

class RunIndex:
    """Run-length Burrows-Wheeler transform of texts that each end with a 0 symbol, with samples at the run ends."""

    def __init__(self, symbols: np.ndarray, length: int):
        n = len(symbols)
        order, short, part = self._sorted(symbols, length)
        before = symbols[order - 1]  # the transform; the text is circular
        edge = np.concatenate([[True], before[1:] != before[:-1]])
        self.starts = np.nonzero(edge)[0]
        self.heads = before[self.starts]
        sizes = np.diff(np.append(self.starts, n))
        self.samples = order[np.append(self.starts[1:], n) - 1]  # text position at the last row of each run
        # rank of a run's head before the run, and first row of each symbol
        by_head = np.argsort(self.heads, kind="stable")
        total = np.cumsum(sizes[by_head]) - sizes[by_head]
        target = np.zeros(len(self.heads), dtype=np.int64)  # row reached from the first row of each run
        target[by_head] = total
        self.shift = np.repeat(target - self.starts, sizes)  # of each row, so that no step searches for its run
        # rows whose next ``length`` symbols agree are one block
        new = np.concatenate([[True], (short[order][1:] != short[order][:-1]) | (part[order][1:] != part[order][:-1])])
        self.block = np.cumsum(new) - 1
        self.order = order

    @staticmethod
    def _sorted(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffix array by prefix doubling from ``PACKED`` symbols on, and the two ranks that together name the first ``length`` symbols."""
        n, short = len(symbols), None
        have = min(PACKED, length)
        pair = symbols.astype(np.int64)
        for k in range(1, have):
            pair = pair * 257 + np.roll(symbols, -k)
        order = np.argsort(pair)
        rank = np.empty(n, dtype=np.int64)  # of each suffix, how many are smaller as far as is known
        rank[order], open_ = RunIndex._split(pair[order], np.arange(n))
        while True:
            if short is None and have * 2 >= length:
                short, part = rank.copy(), np.roll(rank, have - length)
            # only suffixes that are still equal to others are sorted again, inside their places
            some = order[open_]
            pair = rank[some] * n + rank[(some + have) % n]
            by = np.argsort(pair)
            some = order[open_] = some[by]
            named, still = RunIndex._split(pair[by], open_)
            changed = (named != rank[some]).any()
            rank[some] = named
            open_ = still
            have *= 2
            if not len(open_) or have >= n or not changed:  # longer prefixes tell no more apart
                some = order[open_]
                order[open_] = some[np.lexsort((some, rank[some]))]
                return (order, short, part) if short is not None else (order, rank, rank)

    @staticmethod
    def _split(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys at these places: the first place with the same key, and the places whose key occurs twice or more."""
        new = np.ones(len(keys) + 1, dtype=bool)
        new[1:-1] = keys[1:] != keys[:-1]
        first = places[np.maximum.accumulate(np.where(new[:-1], np.arange(len(keys)), 0))]
        return first, places[~(new[:-1] & new[1:])]

    def step(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one symbol earlier."""
        return rows + self.shift[rows]


def _window_lows(texts: np.ndarray, sizes: np.ndarray, lows: np.ndarray, length: int) -> np.ndarray:
    """For the windows of all texts, one after another: the smallest document that has the window."""
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(int(ends[-1]), dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends - 1] = False
    symbols[inside] = texts.astype(np.int64) + 1
    index = RunIndex(symbols, length)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    best = np.full(int(index.block[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(best, index.block, lows[owner[index.order]])
    # stream all texts from right to left, side by side; the row of each end symbol starts its text
    row_of = np.empty(len(symbols), dtype=np.int64)
    row_of[index.order] = np.arange(len(symbols))
    rows = row_of[ends - 1]
    del row_of
    begins = ends - 1 - sizes
    out = np.zeros(len(symbols), dtype=np.int64)
    todo = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[todo], -np.arange(1, int(sizes.max()) + 1), side="right")
    rows = rows[todo]
    for k, n in enumerate(active.tolist()):
        rows[:n] = index.step(rows[:n])
        if k + 1 >= length:
            out[ends[todo[:n]] - 2 - k] = best[index.block[rows[:n]]]
    window = np.arange(len(symbols)) - begins[owner] <= sizes[owner] - length
    return out[window]


def _parts(stretches: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Stretches, sorted by anchor, in parts that need an index each: an anchor's stay together, and a part has about
    ``INDEX_BYTES`` unless one anchor has more."""
    before = np.cumsum(sizes) - sizes
    first = np.nonzero(np.append(True, seeds[1:] != seeds[:-1]))[0]  # of each anchor
    part = before[first] // INDEX_BYTES
    return np.split(stretches, first[1:][part[1:] != part[:-1]])


def _bucket(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Runs of windows that a smaller document has, too, by batch."""
    seeds, numbers, sizes, lows, highs, texts, sender = [], [], [], [], [], [], []
    for k, body in enumerate(rows["body"]):
        raw = unpacked(body)
        n = int(np.frombuffer(raw, "<u8", 1)[0])
        at = 8
        for held, kind in ((seeds, "<u8"), (numbers, "<u4"), (sizes, "<u4"), (lows, "<i8"), (highs, "<i8")):
            held.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        texts.append(np.frombuffer(raw, np.uint8, offset=at))
        sender.append(np.full(n, k))
    seed, number, size, low, high, text, sender = map(np.concatenate, (seeds, numbers, sizes, lows, highs, texts, sender))
    size, ends = size.astype(np.int64), np.cumsum(size, dtype=np.int64)
    begin = ends - size
    named = np.zeros(len(seed), dtype="<u8")
    step = 1 << 16
    for a in range(0, len(seed), step):  # the stretches' own hashes, again
        b = min(len(seed), a + step)
        roll = Rolling(BYTE_VALUES[text[begin[a]:ends[b - 1]]])
        named[a:b] = mixed(roll(begin[a:b] - begin[a], ends[a:b] - begin[a]) + (size[a:b] - length + 1).astype(np.uint64))
    example, which = distinct_pairs(seed, named)
    owner = np.full(len(example), np.iinfo(np.int64).max)
    np.minimum.at(owner, which, low)
    # anchors with one stretch are known; the others go through the index
    mixed_group = np.zeros(len(example), dtype=bool)
    same = seed[example][1:] == seed[example][:-1]  # distinct stretches are sorted by anchor
    mixed_group[1:] |= same
    mixed_group[:-1] |= same
    hard = np.nonzero(mixed_group)[0]
    n_windows = size[example] - length + 1
    first_window = np.concatenate([[0], np.cumsum(n_windows)])
    lows_of = np.repeat(owner, n_windows)
    if len(hard):
        for some in _parts(hard, seed[example[hard]], size[example[hard]]):
            at = np.repeat(first_window[some] - np.concatenate([[0], np.cumsum(n_windows[some])[:-1]]), n_windows[some])
            lows_of[at + np.arange(len(at))] = _window_lows(
                _gather(text, begin[example[some]], size[example[some]]), size[example[some]], owner[some], length)
    # runs of windows with one smallest document, for each distinct stretch
    new = np.concatenate([[True], lows_of[1:] != lows_of[:-1]]) if len(lows_of) else np.zeros(0, bool)
    new[first_window[:-1]] = True
    run_first = np.nonzero(new)[0]
    run_count = np.diff(np.append(run_first, len(lows_of)))
    run_owner = np.searchsorted(first_window, run_first, side="right") - 1
    run_from = np.searchsorted(run_owner, np.arange(len(example) + 1))
    per = np.diff(run_from)[which]
    sent = np.repeat(np.arange(len(seed)), per)
    run = np.repeat(run_from[which] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(len(sent))
    useful = lows_of[run_first[run]] < high[sent]
    sent, run = sent[useful], run[useful]
    out = np.zeros(len(sent), dtype=RUN)
    out["stretch"], out["count"], out["low"] = number[sent], run_count[run], lows_of[run_first[run]]
    out["first"] = run_first[run] - first_window[run_owner[run]]
    bounds = np.searchsorted(sender[sent], np.arange(len(rows) + 1))
    return pd.DataFrame({"batch": rows["batch"].to_numpy(), "runs": [
        packed(out[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]})


# --- the operator ------------------------------------------------------------------------

def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary)."""
    table, buckets = batches(docs)
    body = ["ids", "nulls", "sizes", "body"]
    common = _common_seeds(table, body, length)

    def ask_anchors(*row) -> Iterator[tuple[int, bytes]]:
        keys, _, several = Stretches(Batch(*row), length, common).anchors()
        return ask(keys, several, buckets)

    anchors = stage(answer(table, ask_anchors, body, np.dtype("<u8")), "anchors").withColumnRenamed("replies", "anchors")
    seeded = table.join(anchors, "batch", "left")

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                batch = Batch(*(row[c] for c in body))
                s = Stretches(batch, length, common)
                s.choose(row["anchors"], buckets)
                made = list(_send(batch, s, length, buckets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["batch"]] * len(made), pa.int64()), pa.array([b for b, _ in made], pa.int64()),
                     pa.array([x for _, x in made], pa.binary())], names=["batch", "bucket", "body"])

    def index(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _bucket(rows, length)

    sent = seeded.select("batch", *body, "anchors").mapInArrow(send, "batch long, bucket long, body binary")
    found = sent.groupBy("bucket").applyInPandas(index, "batch long, runs binary")
    runs = stage(found.groupBy("batch").agg(F.collect_list("runs").alias("runs")), "runs")
    final = table.join(anchors, "batch", "left").join(runs, "batch", "left").select("batch", *body, "anchors", "runs")

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                yield _kept(Batch(*(row[c] for c in body)), row["anchors"], row["runs"], buckets, length, common)

    return final.mapInArrow(keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _kept(batch: Batch, anchors: list | None, runs: list | None, buckets: int, length: int, common: bytes) -> pa.RecordBatch:
    s = Stretches(batch, length, common)
    s.choose(anchors, buckets)
    told = np.frombuffer(b"".join(unpacked(x) for x in runs or []), RUN)
    told = told[np.argsort(told["stretch"], kind="stable")]
    bounds = np.searchsorted(told["stretch"], np.arange(len(s.example) + 1))
    per = np.diff(bounds)[s.number] if len(s.number) else np.zeros(0, np.int64)
    place = np.repeat(np.arange(len(per)), per)
    run = told[np.repeat(bounds[:-1][s.number] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(len(place))] \
        if len(place) else told[:0]
    ok = run["low"] < s.doc[place]
    begin = s.first[place[ok]] + run["first"][ok]
    change = np.zeros(len(batch.body) + 1, dtype=np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + run["count"][ok] + (length - 1), -1)
    gone = np.cumsum(change)[:-1] > 0
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    out = []
    for k, (a, b) in enumerate(zip(batch.starts.tolist(), batch.ends.tolist())):
        mine = gone[a:b]
        removed = int(mine.sum())
        kept = batch.body[a:b][~mine].tobytes() if removed else batch.raw[a:b]
        spans = int(head[a:b].sum()) + int(removed > 0 and mine[0] and not head[a])
        out.append((None if batch.null[k] else int(batch.ids[k]), b - a, removed, spans, kept))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 4, pa.binary()))],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
