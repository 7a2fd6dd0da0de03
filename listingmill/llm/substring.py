"""Repeated passages of words by seeds and counted windows.

Seeds are shingles of ``SEED_WORDS`` words; winnowing picks the smallest seed hash of every window as its anchor, so equal
windows have equal anchors. Documents meet on anchors: those that occur once anywhere are no candidates. Every window
under an anchor that is left is counted over all documents by a 96-bit digest of its words, so a frequent anchor never becomes
pairs of places; no match is extended and the words are not compared. Overlapping windows unite to maximal repeats; a repeat has at least ``window`` words.

Defined cases: a null text has no words; texts shorter than a window keep everything; a null ``doc_id`` is kept as null; rows
that repeat are separate places, so each is a repeat of the other; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from listingmill.llm.exchange import (BYTE_VALUES, R_INVERSE, SLAB, Batch, R, Rolling, anchored, answer, ask, batches, distinct,
                                      heard, mixed)
from listingmill.sources.workspace import stage

WINDOW = 35
SEED_WORDS = 8
DIGEST = np.dtype([("a", "<u8"), ("b", "<u4")])
_IS_SPACE = np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))
_R2 = np.uint64(0xD1B54A32D192ED03)
_R2_INVERSE = np.uint64(pow(0xD1B54A32D192ED03, -1, 1 << 64))


class Words:
    """The words of a batch: hash, begin and end in its bytes, and where each document's words end."""

    def __init__(self, batch: Batch):
        self.batch = batch
        space = _IS_SPACE[batch.body]
        edge = np.zeros(len(space) + 1, dtype=bool)  # documents touch each other without a space between
        edge[batch.starts] = True
        word = ~space
        begins = word & np.concatenate([[True], space[:-1]]) if len(word) else word
        begins |= word & edge[:-1]
        ends = word & np.concatenate([space[1:], [True]]) if len(word) else word
        ends |= word & edge[1:]
        self.begin, self.end = np.nonzero(begins)[0], np.nonzero(ends)[0] + 1
        self.hash = np.zeros(len(self.begin), dtype=np.uint64)
        at = 0
        while at < len(self.begin):  # a stretch of bytes at a time
            stop = max(at + 1, int(np.searchsorted(self.begin, self.begin[at] + SLAB)))
            low = self.begin[at]
            roll = Rolling(BYTE_VALUES[batch.body[low:self.end[stop - 1]]])
            b, e = self.begin[at:stop] - low, self.end[at:stop] - low
            self.hash[at:stop] = mixed(roll(b, e) + (e - b).astype(np.uint64))
            at = stop
        self.doc_end = np.searchsorted(self.begin, batch.ends)
        self.doc = np.repeat(np.arange(len(batch.ids)), np.diff(self.doc_end, prepend=0))

    def runs(self, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first window, windows, anchor hash) of runs of windows with one anchor, a stretch of words at a time."""
        n = len(self.hash)
        for low in range(0, max(n - window + 1, 0), SLAB):
            high = min(n, low + SLAB + window - 1)
            roll = Rolling(self.hash[low:high])
            m = high - low
            seeds = mixed(roll(slice(0, m - SEED_WORDS + 1), slice(SEED_WORDS, m + 1)))
            starts = np.arange(low, high - window + 1)
            valid = starts + window <= self.doc_end[self.doc[starts]]
            first, count, place = anchored(seeds, valid, window - SEED_WORDS + 1)
            yield first + low, count, seeds[place]

    def digests(self, starts: np.ndarray, window: int) -> np.ndarray:
        out = np.zeros(len(starts), dtype=DIGEST)
        n = len(self.hash)
        for low in range(0, n, SLAB):
            a, b = np.searchsorted(starts, [low, low + SLAB])
            if a < b:
                part = self.hash[low:min(n, low + SLAB + window)]
                at = starts[a:b] - low
                out["a"][a:b] = mixed(Rolling(part)(at, at + window))
                out["b"][a:b] = mixed(Rolling(mixed(part + R), _R2, _R2_INVERSE)(at, at + window)) >> np.uint64(32)
        return out


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs = list(words.runs(window))
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*runs))


def _candidates(words: Words, window: int, anchors: list | None, buckets: int) -> np.ndarray:
    """Starts of the windows whose anchor occurs elsewhere, too."""
    first, count, seed = _anchors(words, window)
    keys, group, _ = distinct(seed)
    ok = heard(keys, anchors, buckets)[group]
    first, count = first[ok], count[ok]
    begin = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) if len(first) else first
    return begin + np.arange(len(begin))


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    table, buckets = batches(docs)
    body = ["ids", "nulls", "sizes", "body"]

    def ask_anchors(*row) -> Iterator[tuple[int, bytes]]:
        _, _, seed = _anchors(Words(Batch(*row)), window)
        keys, _, counts = distinct(seed)
        return ask(keys, counts > 1, buckets)

    anchors = stage(answer(table, ask_anchors, body, np.dtype("<u8")), "anchors").withColumnRenamed("replies", "anchors")
    seeded = table.join(anchors, "batch", "left")

    def ask_windows(*row) -> Iterator[tuple[int, bytes]]:
        words = Words(Batch(*row[:4]))
        keys, _, counts = distinct(words.digests(_candidates(words, window, row[4], buckets), window))
        return ask(keys, counts > 1, buckets)

    windows = stage(answer(seeded, ask_windows, [*body, "anchors"], DIGEST), "windows")
    final = table.join(anchors, "batch", "left").join(windows, "batch", "left")

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                yield _kept(Words(Batch(*(row[c] for c in body))), window, row["anchors"], row["replies"], buckets)

    return final.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string")


def _kept(words: Words, window: int, anchors: list | None, replies: list | None, buckets: int) -> pa.RecordBatch:
    starts = _candidates(words, window, anchors, buckets)
    keys, group, _ = distinct(words.digests(starts, window))
    twice = starts[heard(keys, replies, buckets)[group]]
    change = np.zeros(len(words.hash) + 1, dtype=np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + window, -1)
    gone = np.cumsum(change)[:-1] > 0
    batch, out, at = words.batch, [], 0
    for k, end in enumerate(words.doc_end.tolist()):
        stay = np.nonzero(~gone[at:end])[0] + at
        if len(stay) == end - at:
            text = b" ".join(batch.raw[batch.starts[k]:batch.ends[k]].split())
        else:
            text = b" ".join(batch.raw[a:b] for a, b in zip(words.begin[stay].tolist(), words.end[stay].tolist()))
        out.append((None if batch.null[k] else int(batch.ids[k]), end - at, end - at - len(stay), text.decode()))
        at = end
    columns = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
        names=["doc_id", "n_words", "n_removed", "kept_text"])
