"""Token ids in binary files: frequency-ranked, in byte-aligned variable-length coding with separate control bytes.

Texts become ids by the library of the vocabulary file, and an end id. All ids of the corpus are counted; the r-th most
frequent (ties: the smaller id) is stored as r, so that the 256 most frequent take one byte and the next 65,280 two. Of four
ranks, a control byte holds the four lengths; control bytes and data bytes lie apart, so that a block is decoded by numpy
without a loop: a table of 256 rows gives the lengths, their running sum the places, a mask per length the values.

A written folder has three parts, all written and read by Spark alone, so any store it reaches will do and a lost executor's
files are written again:

* ``ranks``: one file, the ids by rank, little-endian unsigned 32-bit;
* ``blocks``: files in ascending ``doc_id`` order (by the number in their names), each a sequence of blocks of whole
  documents and about ``BLOCK_IDS`` ids; each block ends with a line feed (the separator of Spark's writer);
* ``index``: a Parquet table (file, first, ids): how many ids lie before each file.

Block: header (see ``HEADER``; the checksum covers all after it), doc_ids (signed 64-bit), a bit per document that has none,
ids per document (64-bit), control bytes, data bytes. Documents are range-partitioned by (doc_id, row), so neither a repeated
``doc_id`` nor a hot stretch of them is one task; the files' number follows the ids.

Defined cases: a null text counts as empty and is its end id alone; a null ``doc_id`` is kept and comes first; rows that repeat
a ``doc_id`` are stored each, next to each other; a very long text is one block of its own; an empty table gives an empty
folder, which reads back as an empty table; a ``doc_id`` that is no whole number is a TypeError at once; columns other than
``doc_id`` and ``text`` are ignored. A damaged block is a ValueError.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from listingmill.llm.tokens import by_bytes, encoder
from listingmill.sources.workspace import stage

END_ID = 1
BLOCK_IDS = 256 << 10
FILE_IDS = 8 << 20
COUNTED_ROWS = 200
CACHED_WORDS = 300_000
WORDS_AT_ONCE = 500
GROUPS_AT_ONCE = 16
HEADER = struct.Struct("<4sIQQI")  # mark, documents, ids, bytes of data, checksum
MARK = b"IDB1"
SEPARATOR = b"\n"
#: Fixed value: a vocabulary that cuts texts by this pattern drops white space, so words can be encoded one by one.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of these characters alone are the same in every normal form and as long in lower case.
_UNCHANGED = "^[!-~À-ÖØ-öø-įĴ-ňŊ-ſ]+$"

#: Lengths of the four values of each control byte, and the bits that a value of each length has.
LENGTHS = np.stack([(np.arange(256) >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype="<u4")


# --- the coding -----------------------------------------------------------------

def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    sizes = 1 + (values > MASKS[1]).astype(np.uint8) + (values > MASKS[2]) + (values > MASKS[3])
    codes = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    codes[:len(values)] = sizes - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values back."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(sizes, dtype=np.int64)
    if n and ends[-1] != len(data):
        raise ValueError("control bytes and data bytes differ in length")
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    if not n:
        return np.zeros(0, "<u4")
    wide = np.lib.stride_tricks.sliding_window_view(padded, 4)[ends - sizes]
    return wide.view("<u4").ravel() & MASKS[sizes]


def block(doc_ids: list[int | None], ranks: list[np.ndarray]) -> bytes:
    """A block of whole documents, without its separator."""
    control, data = encode(np.concatenate(ranks) if ranks else np.zeros(0, "<u4"))
    body = b"".join([
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.packbits(np.array([d is None for d in doc_ids], bool)).tobytes(),
        np.array([len(x) for x in ranks], "<i8").tobytes(), control, data])
    return HEADER.pack(MARK, len(doc_ids), sum(map(len, ranks)), len(data), zlib.crc32(body)) + body


def blocks(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, which are null, ids per document, ranks) of each block of a file."""
    at = 0
    while at < len(raw):
        mark, docs, ids, size, checksum = HEADER.unpack_from(raw, at)
        at += HEADER.size
        parts, end = [], at
        for n in (8 * docs, -(-docs // 8), 8 * docs, -(-ids // 4), size):
            parts.append(raw[end:end + n])
            end += n
        if mark != MARK or raw[end:end + 1] != SEPARATOR or zlib.crc32(raw[at:end]) != checksum:
            raise ValueError(f"damaged block before byte {end}")
        null = np.unpackbits(np.frombuffer(parts[1], np.uint8))[:docs].astype(bool)
        yield np.frombuffer(parts[0], "<i8"), null, np.frombuffer(parts[2], "<i8"), decode(parts[3], parts[4], ids)
        at = end + 1


def ids_before(raw: bytes) -> int:
    """Ids of a file, from the headers of its blocks."""
    at = total = 0
    while at < len(raw):
        _, docs, ids, size, _ = HEADER.unpack_from(raw, at)
        at += HEADER.size + 16 * docs + -(-docs // 8) + -(-ids // 4) + size + 1
        total += ids
    return total


# --- ids of texts ---------------------------------------------------------------

class Words:
    """Ids of many texts at once: every distinct word goes to the library once, if the vocabulary drops white space.

    Words whose characters no normal form changes are sent in long texts, many at a time. Their ids are told apart by the
    tokens that end a word, as many for each as the vocabulary's pattern finds parts in it. All other words are sent one by
    one. The ids of up to ``CACHED_WORDS`` words are remembered; when there are more, those of the last texts.
    """

    def __init__(self, path: str):
        self.library, self.by_word, self.special, self.ends = encoder(path), False, [], np.zeros(0, bool)
        self._forget()
        if not path.endswith(".json"):
            return
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        cut, normal, model = held.get("pre_tokenizer") or {}, held.get("normalizer") or {}, held["model"]
        first = (cut.get("pretokenizers") or [cut])[0]
        steps = [x["type"] for x in normal.get("normalizers") or [normal] if x]
        self.special = [t["content"] for t in held["added_tokens"]]
        self.by_word = (
            first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
            and first["pattern"].get("Regex") == _WORD_PATTERN and set(steps) <= {"NFC", "Replace", "Lowercase"}
            and "Lowercase" in steps and model.get("end_of_word_suffix") and model.get("dropout") is None
            and not held.get("post_processor") and all(t.isascii() and not any(map(str.isspace, t)) for t in self.special))
        if self.by_word:
            self.ends = np.zeros(1 + max([*model["vocab"].values(), *(t["id"] for t in held["added_tokens"])]), bool)
            self.ends[[n for t, n in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if not self.by_word or not len(texts):
            each = [np.asarray(x, "<u4") for x in self.library.encode(texts.to_pylist())]
            return np.concatenate([np.zeros(0, "<u4"), *each]), np.array([len(x) for x in each], np.int64)
        lower = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts if self._has_special(lower).true_count else lower)  # no special string may arise
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        sizes, starts, table = self._each(words.dictionary)
        place = words.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[place]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat((starts[place] - ends[:-1]).astype(np.int32), lengths)
        at += np.arange(ends[-1], dtype=np.int32)
        return table.take(at), np.diff(ends[bounds])

    def _has_special(self, lower: pa.Array) -> pa.Array:
        found = pa.array(np.zeros(len(lower), bool))
        for t in self.special:
            found = pc.or_(found, pc.match_substring(lower, t.lower()))
        return found

    def _forget(self) -> None:
        self.known, self.sizes, self.table = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _each(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids and place of the first of each word, in the table that is returned, too."""
        place = pc.index_in(words, self.known)
        missing = np.nonzero(place.is_null().to_numpy(zero_copy_only=False))[0]
        order, sizes, table = self._encode(words.take(pa.array(missing)))
        missing = missing[order]
        new = words.take(pa.array(missing))
        found = place.fill_null(0).to_numpy().astype(np.int64)
        found[missing] = len(self.known) + np.arange(len(new))
        all_sizes, all_table = np.concatenate([self.sizes, sizes]), np.concatenate([self.table, table])
        out = all_sizes[found], (np.cumsum(all_sizes) - all_sizes)[found], all_table
        if len(self.known) + len(new) > CACHED_WORDS:
            self._forget()
            if len(words) <= CACHED_WORDS:  # the words of these texts stay, so that frequent ones are not encoded again
                sizes, starts, _ = out
                at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
                self.known, self.sizes, self.table = words, sizes, all_table[at + np.arange(len(at))]
            return out
        self.known, self.sizes, self.table = pa.concat_arrays([self.known, new]), all_sizes, all_table
        return out

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the words; in that order, the number of ids of each and all ids."""
        lower = pc.ascii_lower(words)
        parts = pc.count_substring_regex(lower, _WORD_PATTERN).to_numpy(zero_copy_only=False)
        plain = pc.and_not(pc.match_substring_regex(words, _UNCHANGED), self._has_special(lower)).to_numpy(zero_copy_only=False)
        some, rest, held = np.nonzero(plain)[0], [np.nonzero(~plain)[0]], words.to_pylist()
        groups = list(_few(some, WORDS_AT_ONCE))
        order, sizes, table = [], [], [np.zeros(0, "<u4")]
        for group, ids in self._of_groups(groups, held):
            ends = np.concatenate([[0], np.nonzero(self.ends[ids])[0] + 1])
            stops = np.cumsum(parts[group])
            if len(ends) != stops[-1] + 1:
                rest.append(group)
                continue
            order.append(group)
            sizes.append(np.diff(ends[stops], prepend=0))
            table.append(ids)
        alone = np.concatenate(rest)
        each = [np.array(x, "<u4") for few in _few(alone, GROUPS_AT_ONCE * WORDS_AT_ONCE) for x in self.library.encode([held[i] for i in few])]
        return (np.concatenate([*order, alone]), np.concatenate([*sizes, np.array([len(x) for x in each], np.int64)]).astype(np.int64),
                np.concatenate([*table, *each]))

    def _of_groups(self, groups: list[np.ndarray], held: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each group of words and the ids of its text; some at a time, as what the library returns takes far more room than the ids."""
        for some in _few(groups, GROUPS_AT_ONCE):
            for group, ids in zip(some, self.library.encode([" ".join([held[i] for i in g]) for g in some])):
                yield group, np.array(ids, "<u4")


def _few(items: Sequence, n: int) -> Iterator[Sequence]:
    """The items, ``n`` at a time."""
    return (items[i:i + n] for i in range(0, len(items), n))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> Words:
    return Words(path)


def packed(ids: np.ndarray) -> bytes:
    """Ids on their way between tasks: their bytes apart, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(ids.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def encoded(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): all ids of each text and the end id, ``packed``."""
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be a whole number")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            ids, counts = word_encoder(path).ids(some.column("text"))
            each = [packed(np.concatenate([x, end])) for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(each, pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids binary")


def frequencies(made: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs. A task sends each of its ids once, so at most a vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for some in batches:
            for few in range(0, some.num_rows, COUNTED_ROWS):  # an array as long as the vocabulary is not for a single row
                rows = some.column("ids")[few:few + COUNTED_ROWS]
                seen = np.bincount(np.concatenate([unpacked(x.as_buffer()) for x in rows]))
                if len(seen) > len(held):
                    seen, held = held, seen
                held[:len(seen)] += seen
        found = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(held[found], pa.int64())], names=["id", "n"])

    return made.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# --- files ----------------------------------------------------------------------

def _write_bytes(rows: DataFrame, folder: str) -> None:
    """The binary column as files: a text writer takes any bytes as they are."""
    rows.select(F.col(rows.columns[0]).cast("string").alias("value")).write.text(folder)


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    """Write the ids of all texts to ``folder``, which must not exist yet."""
    spark = docs.sparkSession
    made = stage(encoded(docs, path, end_id).withColumn("row", F.monotonically_increasing_id()), "ids")
    counts = frequencies(made).orderBy(F.desc("n"), "id").collect()  # as long as the vocabulary at most
    by_rank = np.array([r["id"] for r in counts], "<u4")
    _write_bytes(spark.createDataFrame([(bytearray(by_rank.tobytes()),)], "value binary").coalesce(1), f"{folder}/ranks")
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, "<u4")
    rank[by_rank] = np.arange(len(by_rank), dtype="<u4")
    shared = spark.sparkContext.broadcast(rank)  # a vocabulary

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block(names, held)], pa.binary())], names=["block"])

        for some in batches:
            for doc, raw in zip(some.column("doc_id").to_pylist(), some.column("ids")):
                ranks = shared.value[unpacked(raw.as_buffer())]
                if held and size + len(ranks) > BLOCK_IDS:
                    yield row()
                    names, held, size = [], [], 0
                names.append(doc)
                held.append(ranks)
                size += len(ranks)
        if held:
            yield row()

    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = max(slots, sum(r["n"] for r in counts) // FILE_IDS + 1)
    ordered = made.repartitionByRange(files, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    _write_bytes(ordered.select("doc_id", "ids").mapInArrow(pack, "block binary"), f"{folder}/blocks")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            yield pa.RecordBatch.from_arrays(
                [some.column("file"), pa.array([ids_before(x.as_py()) for x in some.column("content")], pa.int64())],
                names=["file", "ids"])

    sums = _files(spark, folder).mapInArrow(total, "file long, ids long")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for every FILE_IDS ids or so
    sums.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0))).write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/blocks")
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a written folder: doc_id, start (ids of all documents before it), n_tokens, ids."""
    ranks = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/ranks").select("content").collect()
    by_rank = np.frombuffer(b"".join(bytes(r["content"])[:-1] for r in ranks), "<u4")  # a vocabulary
    shared = spark.sparkContext.broadcast(by_rank)
    files = _files(spark, folder).join(spark.read.parquet(f"{folder}/index").select("file", "first"), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for raw, start in zip(some.column("content"), some.column("first").to_pylist()):
                for docs, null, counts, held in blocks(raw.as_py()):
                    ends = np.concatenate([[0], np.cumsum(counts)])
                    ids = shared.value[held].tobytes()
                    yield pa.RecordBatch.from_arrays([
                        pa.array(docs, pa.int64(), mask=null), pa.array(start + ends[:-1], pa.int64()), pa.array(counts, pa.int64()),
                        pa.array([ids[4 * a:4 * b] for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
                    start += int(ends[-1])

    return files.select("content", "first").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
