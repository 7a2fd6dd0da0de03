"""Helpers of the operators that find repeated windows: batches of documents, winnowed anchors, and one exchange of keys.

Documents are kept as rows of a few megabytes (a batch), stored once, bucketed by batch, so that later joins by batch do not
move the texts. A batch sends each key (the hash of an anchor or a window) once, however often it occurs there, to the bucket
of the key; the bucket answers with one bit per key: does it occur elsewhere, too? So a key that a third of all documents
share costs a few bytes per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmill.llm.tokens import by_bytes
from listingmill.sources.workspace import fresh_path

BATCH_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20
SLAB = 1 << 20
R = np.uint64(0x9E3779B97F4A7C15)
R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def packed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpacked(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


# --- batches ----------------------------------------------------------------------

def batches(docs: DataFrame) -> tuple[DataFrame, int]:
    """(batch, ids, sizes, body): documents in rows of about ``BATCH_BYTES``; and the number of buckets that suits them.

    ``ids`` are signed 64-bit numbers (a null counts as the largest), ``sizes`` byte lengths (-1: the id is null).
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def row() -> pa.RecordBatch:
            ids = np.array([np.iinfo(np.int64).max if d is None else d for d, _ in held], dtype="<i8")
            texts = [x.encode() for _, x in held]
            sizes = np.array([len(x) for x in texts], dtype="<i8")
            null = np.packbits([d is None for d, _ in held]).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([x], pa.binary()) for x in (ids.tobytes(), null, sizes.tobytes(), packed(b"".join(texts)))],
                names=["ids", "nulls", "sizes", "body"])

        for some in parts:
            for small in by_bytes(iter([some]), "text", BATCH_BYTES // 4):
                held += zip(*(c.to_pylist() for c in small.columns))
                size += small.column("text").nbytes
                if size >= BATCH_BYTES:
                    yield row()
                    held, size = [], 0
        if held:
            yield row()

    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"batches_{uuid.uuid4().hex}"
    made = rows.mapInArrow(pack, "ids binary, nulls binary, sizes binary, body binary").withColumn(
        "batch", F.monotonically_increasing_id())
    made.repartition(slots, "batch").write.option("path", fresh_path(spark, name)).option("compression", "uncompressed").bucketBy(
        slots, "batch").sortBy("batch").saveAsTable(name)
    return spark.table(name), max(slots, int(total // BUCKET_BYTES) + 1)


class Batch:
    """The documents of one row: bytes side by side."""

    def __init__(self, ids: bytes, nulls: bytes, sizes: bytes, body: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.null = np.unpackbits(np.frombuffer(nulls, np.uint8))[:len(self.ids)].astype(bool)
        self.ends = np.cumsum(np.frombuffer(sizes, "<i8"))
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        self.raw = unpacked(body)
        self.body = np.frombuffer(self.raw, np.uint8)


# --- hashes -----------------------------------------------------------------------

def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * R)


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit values, from prefix sums of value times power of an odd number."""

    def __init__(self, values: np.ndarray, base: np.uint64 = R, inverse: np.uint64 = R_INVERSE):
        n = len(values)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers(base, n + 1)[:n], out=self.prefix[1:])
        self.back = _powers(inverse, n + 1)

    def __call__(self, begin: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        out = self.prefix[end] - self.prefix[begin]
        out *= self.back[begin]
        return out


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers; those for a slab are computed once in each worker."""
    return _slab_powers(base)[:n] if n <= 2 * SLAB else _all_powers(base, n)


@lru_cache(maxsize=4)
def _slab_powers(base: np.uint64) -> np.ndarray:
    return _all_powers(base, 2 * SLAB)


def _all_powers(base: np.uint64, n: int) -> np.ndarray:
    power = np.full(n, base, dtype=np.uint64)
    power[0] = 1
    return np.multiply.accumulate(power)


def anchored(seeds: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with the same anchor: first window, number of windows, place of the anchor.

    ``seeds[i]`` is the hash of the seed that starts at i; a window covers ``width`` seeds; its anchor is the smallest,
    the first of equal ones. Only windows with ``valid`` count.
    """
    n = len(valid)
    if not n or not valid.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    bits = np.uint64(22)
    low = (seeds >> bits << bits) | np.arange(len(seeds), dtype=np.uint64)
    step, held = 1, low
    while step * 2 <= width:
        held = np.minimum(held[:-step], held[step:])
        step *= 2
    rest = width - step
    held = np.minimum(held[:len(held) - rest], held[rest:]) if rest else held
    place = (held[:n] & np.uint64((1 << 22) - 1)).astype(np.int64)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    first = np.nonzero(new)[0]
    stop = np.nonzero(valid & ~np.append(valid[1:] & ~new[1:], False))[0] + 1
    return first, stop - first, place[first]


# --- one bit per key ------------------------------------------------------------------

def ask(keys: np.ndarray, several: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Messages (bucket, body) for distinct ``keys`` - structured rows, or 64-bit - in the order of ``by_bucket``."""
    order, bounds = by_bucket(keys, buckets)
    for b in np.nonzero(np.diff(bounds))[0].tolist():
        mine = order[bounds[b]:bounds[b + 1]]
        yield b, keys[mine].tobytes() + np.packbits(several[mine]).tobytes()


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    h = keys["a"] if keys.dtype.names else keys
    where = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    return order, np.searchsorted(where[order], np.arange(buckets + 1))


def answer(table: DataFrame, question: Callable[..., Iterator[tuple[int, bytes]]], columns: list[str], dtype: np.dtype) -> DataFrame:
    """(batch, replies): for each message of ``question`` over the rows of ``table``, which keys occur in another message, or
    more than once in their own. ``replies`` are (bucket, bits) in the order of the keys."""
    bits = 8 * dtype.itemsize + 1

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in range(part.num_rows):
                batch, *values = (part.column(c)[row].as_py() for c in ("batch", *columns))
                made = list(question(*values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch] * len(made), pa.int64()), pa.array([b for b, _ in made], pa.int64()),
                     pa.array([x for _, x in made], pa.binary())], names=["batch", "bucket", "body"])

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(x) * 8 // bits for x in rows["body"]]
        keys = np.concatenate([np.frombuffer(x[:n * dtype.itemsize], dtype) for x, n in zip(rows["body"], sizes)])
        several = np.concatenate([np.unpackbits(np.frombuffer(x[n * dtype.itemsize:], np.uint8))[:n]
                                  for x, n in zip(rows["body"], sizes)]).astype(bool)
        _, group, count = np.unique(keys, return_inverse=True, return_counts=True)
        twice = count >= 2
        twice[group[several]] = True
        said = np.split(twice[group], np.cumsum(sizes)[:-1])
        return pd.DataFrame({"batch": rows["batch"], "bucket": key[0], "said": [np.packbits(x).tobytes() for x in said]})

    sent = table.select("batch", *columns).mapInArrow(send, "batch long, bucket long, body binary")
    met = sent.groupBy("bucket").applyInPandas(meet, "batch long, bucket long, said binary")
    return met.groupBy("batch").agg(F.collect_list(F.struct("bucket", "said")).alias("replies"))


def heard(keys: np.ndarray, replies: list | None, buckets: int) -> np.ndarray:
    """The bit of each of the ``keys`` that were asked about."""
    order, bounds = by_bucket(keys, buckets)
    out = np.zeros(len(keys), dtype=bool)
    for r in replies or []:
        a, b = bounds[r["bucket"]], bounds[r["bucket"] + 1]
        out[order[a:b]] = np.unpackbits(np.frombuffer(r["said"], np.uint8))[:b - a].astype(bool)
    return out


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the distinct pairs in ascending order: the place where each first occurs; and the number of every pair among them."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the number of each key among them, and counts."""
    values, group, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return values, group, counts
