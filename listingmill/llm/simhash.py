"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has a bit for each position that is set in more than half of a text's shingle hashes. Rows with the same
fingerprint are one node, so copies never meet as pairs. Nodes are cut into tiles by population count, and only pairs of tiles
whose counts differ by at most the radius can hold links; each such pair is one group, compared in blocks with numpy's
exclusive-or and bit counts. All nodes take part, nothing is sampled: the work is quadratic in distinct fingerprints, less
what the counts skip. Where the radius is small against the width, tiles hold only fingerprints that agree in two of
``radius + 2`` blocks of bits, as any pair of a link must, and the work follows the input; the links are the same. A pair of
tiles returns a spanning forest of its links, at most one row per node, never all pairs.
Components come from alternating large-star and small-star steps over these rows, written to the shared folder each round.

The pipeline's near stage takes links only as candidates, over distinct shingles and with a wide radius. Tiles hold only
fingerprints whose sets share one of their first shingles, common ones last, as any pair of the similarity must (prefix filter); so the work
follows the input. The nodes of each candidate component meet again with their sets of shingle hashes (64 bits), in tiles, and
only pairs whose sets have the Jaccard similarity link. A component in which many pairs are close and none is similar, and one large
group of near copies, are quadratic work. The row that stays
has the smallest ``doc_id`` that is not null, then the smallest text digest; rows are told apart by both.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and links like any other; rows with a
null ``doc_id`` take part, and a component's identifier is its smallest one that is not null; repeated rows give one row each (the near stage keeps or
drops rows that repeat id and text together);
an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmill.llm.tokens import by_bytes
from listingmill.sources.workspace import stage

SEED = 42
TILE = 16384
SMALL = 64
KEY_BITS = 32
CHUNK = 1 << 20
SET_ROWS = 256
SET_BYTES = 2 << 20
#: One text in so many is counted for the list of common shingles, which is at most so long.
COMMON_OF = 64
MOST_COMMON = 1 << 17


# --- fingerprints -----------------------------------------------------------------

def _spread(h: np.ndarray, lane: int) -> np.ndarray:
    """Further independent 64 bits from a hash, for fingerprints of more than 64 bits."""
    if lane == 0:
        return h
    x = h + np.uint64(lane * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_chunks(data: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``CHUNK`` bytes; each list begins with the last ``size - 1`` words before it."""
    at, carried = 0, []
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = carried + data[at:end].split()
        at = end
        yield words
        carried = words[-(size - 1):] if size > 1 else []


def _hashes(data: bytes, size: int) -> Iterator[np.ndarray]:
    seen = 0
    last: list[bytes] = []
    for words in _word_chunks(data, size):
        seen, last = max(seen, len(words)), words
        if len(words) >= size:
            line = b" ".join(words)
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
            ends = np.cumsum(sizes) - 1
            begins = ends - sizes + 1
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(line[a:b], SEED) for a, b in zip(begins.tolist(), ends[size - 1:].tolist())], dtype=np.uint64)
    if 0 < seen < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(last), SEED)], dtype=np.uint64)


def fingerprint(text: str, size: int, lanes: int) -> bytes:
    """The fingerprint of a text, 8 bytes per lane, most significant first."""
    return _majority(_hashes(text.encode().lower(), size), lanes)


def _majority(hashes: Iterable[np.ndarray], lanes: int) -> bytes:
    """The bits that are set in more than half of the hashes."""
    ones, total = np.zeros((lanes, 64), dtype=np.int64), 0
    for h in hashes:
        total += len(h)
        for lane in range(lanes):
            bits = np.unpackbits(_spread(h, lane).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[lane] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > total, axis=1).tobytes() if total else bytes(8 * lanes)


def fingerprints(docs: DataFrame, size: int = 3, bits: int = 64) -> DataFrame:
    """doc_id and its fingerprint (binary) over shingles of ``size`` words, A-Z lower-cased, repeats included."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            made = [fingerprint(x, size, bits // 64) for x in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(made, pa.binary())], names=["doc_id", "fp"])

    return rows.mapInArrow(digest, f"doc_id {kind}, fp binary")


# --- tiles ------------------------------------------------------------------------

def _lanes(fps: pd.Series | np.ndarray) -> np.ndarray:
    """(lanes, n) unsigned 64-bit."""
    if not len(fps):
        return np.zeros((1, 0), dtype=np.uint64)
    return np.ascontiguousarray(np.frombuffer(b"".join(fps), dtype=">u8").astype(np.uint64).reshape(len(fps), -1).T)


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``radius``. Unlike texts differ in half of all bits: as many lanes as set them apart are compared
    for all pairs, the other lanes only for the pairs that are left."""
    dense = min(len(a), radius // 32 + 2)
    apart = np.bitwise_count(a[0][:, None] ^ b[0][None, :]).astype(np.uint8 if dense < 4 else np.uint16)
    for lane in range(1, dense):
        apart += np.bitwise_count(a[lane][:, None] ^ b[lane][None, :])
    i, j = np.nonzero(apart <= radius)
    far = apart[i, j].astype(np.int64)
    for lane in range(dense, len(a)):
        far += np.bitwise_count(a[lane][i] ^ b[lane][j])
        ok = far <= radius
        i, j, far = i[ok], j[ok], far[ok]
    return i, j


def _forest(n: int, blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest node index linked with each of ``n`` nodes, from blocks of index pairs."""
    root = np.arange(n)
    for i, j in blocks:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def _compare(left: pd.DataFrame, right: pd.DataFrame | None, radius: int) -> pd.DataFrame:
    """Edges (fp, other) of a spanning forest of the links in a tile, or between two tiles."""
    a = _lanes(left["fp"])
    b = a if right is None else _lanes(right["fp"])
    step = max(1, (1 << 18) // max(1, b.shape[1]))
    shift = 0 if right is None else a.shape[1]

    def blocks():
        for at in range(0, a.shape[1], step):
            i, j = _near(a[:, at:at + step], b[:, at:] if right is None else b, radius)
            yield i + at, j + (at if right is None else shift)

    fps = np.concatenate([left["fp"].to_numpy(), right["fp"].to_numpy() if right is not None else []])
    root = _forest(len(fps), blocks())
    mine = np.nonzero(root != np.arange(len(fps)))[0]
    return pd.DataFrame({"fp": fps[mine], "other": fps[root[mine]]})


def links(nodes: DataFrame, radius: int, bits: int = 64) -> DataFrame:
    """(fp, other): edges that connect exactly the distinct ``fp`` of ``nodes`` within ``radius`` bits of each other."""
    blocks = radius + 2
    if bits % (8 * blocks) == 0 and bits // blocks * 2 >= KEY_BITS:
        return _links_by_blocks(nodes, radius, bits // 8 // blocks, blocks)
    return _links_by_count(nodes, radius)


def _links_by_blocks(nodes: DataFrame, radius: int, width: int, blocks: int) -> DataFrame:
    """Within ``radius`` bits, two of ``radius + 2`` blocks of ``width`` bytes are equal, wherever the bits differ.

    So only fingerprints that share two blocks are compared.
    """
    pairs = [(a, b) for a in range(blocks) for b in range(a + 1, blocks)]
    keys = [F.struct(F.lit(k).alias("k"), F.concat(*[F.substring("fp", 1 + width * x, width) for x in pair]).alias("v"))
            for k, pair in enumerate(pairs)]
    return _links_in_groups(nodes.select("fp", "ones", F.explode(F.array(*keys)).alias("key")), radius)


def _links_in_groups(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, other): edges that connect exactly what chains of fingerprints with the same ``key`` within ``radius`` bits connect.

    ``rows`` are key, fp and ones; a fingerprint may have many keys. A group of more than ``TILE`` is cut into tiles by hash
    and each pair of its tiles is a group of its own; single fingerprints are left out.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    placed = rows.join(sizes, "key").withColumn("tiles", F.ceil(F.col("n") / F.lit(TILE)).cast("int"))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    sent = placed.select("key", "fp", "ones", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("to")).select(
        F.struct("key", F.least("tile", "to"), F.greatest("tile", "to")).alias("group"), "fp", "ones",
        (F.col("tile") > F.col("to")).alias("second"))
    # a number for each group, so that neighbours in a sorted partition can be told apart without nested values
    sent = sent.select(F.xxhash64("group").alias("g"), F.md5(F.to_json("group")).alias("h"), "fp", "ones", "second")
    sent = sent.repartition("g", "h").sortWithinPartitions("g", "h", "second", "ones").drop("ones")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in _whole_groups(batches):
            yield pa.RecordBatch.from_pandas(_compare_groups(rows_, radius), preserve_index=False, schema=pa.schema(
                [("fp", pa.binary()), ("other", pa.binary())]))

    return sent.mapInArrow(compare, "fp binary, other binary")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The rows of a sorted partition, cut between groups; a group has two tiles at most."""
    held = None
    for batch in batches:
        rows = batch.to_pandas()
        held = rows if held is None else pd.concat([held, rows], ignore_index=True)
        last = (held["h"] == held["h"].iloc[-1]).to_numpy() if len(held) else np.zeros(0, bool)
        if len(held) and not last.all():
            yield held[~last]
            held = held[last].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _compare_groups(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Spanning forests of all groups of a stretch: small groups side by side, large ones tile by tile."""
    group = (rows["h"] != rows["h"].shift()).cumsum().to_numpy() - 1
    size = np.bincount(group, minlength=1)
    second = rows.groupby(group)["second"].any().to_numpy()
    large = (size > SMALL) | second
    out = []
    for g in np.nonzero(large)[0].tolist():
        mine = rows[group == g]
        out.append(_compare(mine[~mine["second"]], mine[mine["second"]] if second[g] else None, radius))
    small = np.nonzero(~large[group])[0]
    fps, group = rows["fp"].to_numpy()[small], group[small]
    lanes = _lanes(fps)

    def shifted():
        for step in range(1, SMALL):
            at = np.nonzero(group[step:] == group[:-step])[0] if step < len(group) else group[:0]
            if not len(at):
                return
            far = sum(np.bitwise_count(x[at] ^ x[at + step]).astype(np.int64) for x in lanes)
            yield at[far <= radius], at[far <= radius] + step

    root = _forest(len(fps), shifted())
    mine = np.nonzero(root != np.arange(len(fps)))[0]
    out.append(pd.DataFrame({"fp": fps[mine], "other": fps[root[mine]]}))
    return pd.concat(out, ignore_index=True)


def _links_by_count(nodes: DataFrame, radius: int) -> DataFrame:
    """All tiles whose population counts allow it, against each other."""
    spark, tile = nodes.sparkSession, TILE
    counts = {r["ones"]: r["n"] for r in nodes.groupBy("ones").agg(F.count(F.lit(1)).alias("n")).collect()}
    # tiles in order of population count: (count, tiles of this count, first tile); a row per count, whatever the input;
    # small neighbouring counts share a tile
    ladder, first, held = [], 0, 0
    for ones in sorted(counts):
        if held and held + counts[ones] > tile:
            first, held = first + 1, 0
        n = math.ceil(counts[ones] / tile)
        ladder.append((ones, n, first))
        held += counts[ones]
        if n > 1:
            first, held = first + n, 0
    reach = []
    for ones, n, start in ladder:
        last = max(s + m for o, m, s in ladder if o - ones <= radius)
        low = min(s for o, m, s in ladder if ones - o <= radius)
        reach.append((ones, n, start, low, last - 1))
    table = spark.createDataFrame(reach or [(0, 1, 0, 0, 0)], "ones int, n int, start int, low int, high int")
    placed = nodes.join(F.broadcast(table), "ones").withColumn(
        "tile", F.col("start") + F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tile": [key[0]], "size": [len(rows["fp"].iloc[0])], "fps": [b"".join(rows["fp"])],
                             "low": [rows["low"].min()], "high": [rows["high"].max()]})

    # a tile is one value, so what goes to the pairs are tiles, not rows
    tiles = placed.select("fp", "tile", "low", "high").groupBy("tile").applyInPandas(
        pack, "tile int, size int, fps binary, low int, high int")
    sent = tiles.select("tile", "size", "fps", F.explode(F.sequence("low", "high")).alias("to")).select(
        "size", "fps", (F.col("tile") > F.col("to")).alias("second"), F.least("tile", "to").alias("a"), F.greatest("tile", "to").alias("b"))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, second = rows[~rows["second"]], rows[rows["second"]]
        if not len(first) or (key[0] != key[1] and not len(second)):
            return pd.DataFrame({"fp": [], "other": []})
        return _compare(_unpack(first), _unpack(second) if key[0] != key[1] else None, radius)

    return sent.groupBy("a", "b").applyInPandas(compare, "fp binary, other binary")


def _unpack(tile: pd.DataFrame) -> pd.DataFrame:
    raw, size = tile["fps"].iloc[0], int(tile["size"].iloc[0])
    return pd.DataFrame({"fp": [raw[i:i + size] for i in range(0, len(raw), size)]})


# --- components -------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node that an edge (fp, other) touches."""
    links_ = stage(edges.select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v")).distinct(), "links")
    while True:
        both = links_.unionByName(links_.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: greater neighbours to the smallest neighbour
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        # small star: smaller neighbours, and the node itself, to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after = stage(small.select("e.u", "e.v").filter("u != v").distinct(), "links")
        changed = after.exceptAll(links_).limit(1).count() + links_.exceptAll(after).limit(1).count()
        links_ = after
        if not changed:
            break
    return links_.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 3, bits: int = 64, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest doc_id reachable over links)."""
    prints = stage(fingerprints(docs, size, bits), "fingerprints")
    nodes = stage(_nodes(prints), "nodes")
    found = components(links(nodes, radius, bits))
    rooted = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    label = stage(rooted.join(names, "root").select("fp", "component_id"), "labels")
    return prints.join(label, "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def _nodes(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints with their smallest doc_id and their number of set bits."""
    digits = F.hex("fp")
    ones = sum(n * (F.length(digits) - F.length(F.regexp_replace(digits, f"[{some}]", "")))
               for n, some in ((1, "1248"), (2, "3569AC"), (3, "7BDE"), (4, "F")))
    return prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")).withColumn("ones", ones.cast("int"))


# --- near copies of the pipeline ----------------------------------------------------

def shingle_set(text: str, size: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_hashes(text.encode().lower(), size)]))


def radius_for(similarity: float, bits: int, slack: float = 5.0) -> int:
    """Differing bits that sets of this Jaccard similarity have on average, plus ``slack`` standard deviations.

    Ties of even counts set small sets further apart: four of five shingles differ in 3 of 16 bits, the most at 0.8.
    """
    odds = max(math.acos(2 * similarity / (1 + similarity)) / math.pi, 3 / 16)
    return round(bits * odds + slack * math.sqrt(bits * odds * (1 - odds)))


def _common_shingles(rows: DataFrame, size: int) -> np.ndarray:
    """Hashes of shingles that many texts have, in order: they come last when the first shingles of a set are named.

    Any order of the shingles finds the same pairs, so it is enough to count one text in ``COMMON_OF``; the order only decides
    how many dissimilar texts are compared.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            sets = [shingle_set(x, size) for x in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["key"])

    some = rows.where(F.pmod(F.xxhash64("h"), F.lit(COMMON_OF)) == 0).select("text").mapInArrow(read, "key long")
    found = some.groupBy("key").count().where("count > 3").orderBy(F.desc("count"), "key").limit(MOST_COMMON).select("key").collect()
    return np.sort(np.array([r[0] for r in found], dtype=np.int64).view(np.uint64))


def first_shingles(hashes: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set, by hash and common ones last, so many that two sets of this similarity share one of them."""
    n = len(hashes)
    if n and len(common):
        last = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
        hashes = np.concatenate([hashes[~last], hashes[last]])
    return hashes[:n - math.ceil(n * similarity - 1e-9) + 1] if n else hashes


def _set_prints(rows: DataFrame, size: int, bits: int, similarity: float) -> DataFrame:
    """doc_id, text digest, fingerprint and digest of the set of shingles, together the node, and its first shingles."""
    kind = dict(rows.dtypes)["doc_id"]
    common = _common_shingles(rows, size)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            sets = [shingle_set(x, size) for x in some.column("text").to_pylist()]
            fps = [_majority(np.array_split(x, len(x) * 8 // CHUNK + 1), bits // 64) for x in sets]
            nodes = [fp + xxhash.xxh128_digest(x.tobytes()) for fp, x in zip(fps, sets)]
            first = [first_shingles(x, common, similarity).view(np.int64) for x in sets]
            ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *first])))
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), some.column("h"), pa.array(fps, pa.binary()), pa.array(nodes, pa.binary()), keys],
                names=["doc_id", "h", "fp", "node", "keys"])

    return rows.select("doc_id", "h", "text").mapInArrow(
        digest, f"doc_id {kind}, h string, fp binary, node binary, keys array<bigint>")


def _met(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, fp, ones): fingerprints of sets that share one of their first shingles, as any two sets of the similarity do.

    Shingles with the same sets, as the many of two copies, are one key. Sums of hashes tell groups of sets apart.
    """
    each = prints.groupBy("node").agg(F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys"))
    postings = each.select(F.xxhash64("fp").alias("id"), F.explode("keys").alias("key"))
    postings = stage(postings, "first-shingles")
    mark = F.xxhash64("id", F.lit(SEED))
    groups = postings.groupBy("key").agg(
        F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("high"), F.sum(mark.bitwiseAND(0xFFFFFFFF)).alias("low")).where("a != b")
    groups = stage(groups.groupBy("a", "b", "n", "high", "low").agg(F.min("key").alias("key")), "shared-shingles")
    several = groups.where("n > 2").select("key")
    if several.count() <= MOST_COMMON:
        several = F.broadcast(several)
    two = groups.where("n = 2").select("key", F.explode(F.array("a", "b")).alias("id"))
    rows = two.unionByName(postings.join(several, "key").select("key", "id").distinct())
    return rows.join(nodes.select(F.xxhash64("fp").alias("id"), "fp", "ones"), "id").select("key", "fp", "ones")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """root, node and the hashes of its shingles (8 bytes each), from root, node and text."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            made = [shingle_set(x, size).tobytes() for x in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column("root"), some.column("node"), pa.array(made, pa.binary())],
                                             names=["root", "node", "hashes"])

    return rows.select("root", "node", "text").mapInArrow(read, "root binary, node binary, hashes binary")


def _verify(left: pd.DataFrame, right: pd.DataFrame | None, radius: int, similarity: float, width: int) -> pd.DataFrame:
    """Edges (fp, other) between nodes, a spanning forest of the links in a tile or between two tiles: pairs within ``radius``
    whose sets have the similarity. A pair that earlier links already connect is not looked at."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    nodes = both["node"].to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in both["hashes"]]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    lanes = _lanes(np.array([x[:width] for x in nodes], dtype=object))
    root = np.arange(len(nodes))
    for i in range(len(left)):
        others = np.arange(i + 1 if right is None else len(left), len(nodes))
        others = others[root[others] != root[i]]
        low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[low >= similarity * high - 1e-9]
        others = others[sum(np.bitwise_count(x[others] ^ x[i]).astype(np.int64) for x in lanes) <= radius]
        while len(others):  # in slices, as one link may connect many of the others
            now, others = others[:64], others[64:]
            for j in now[root[now] != root[i]].tolist():
                if root[i] == root[j]:
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if shared * (1 + similarity) >= similarity * (size[i] + size[j]) - 1e-9:
                    root[root == max(root[i], root[j])] = min(root[i], root[j])
            others = others[root[others] != root[i]]
    mine = np.nonzero(root != np.arange(len(nodes)))[0]
    return pd.DataFrame({"fp": nodes[mine], "other": nodes[root[mine]]})


def _verified_links(sets: DataFrame, radius: int, similarity: float, width: int) -> DataFrame:
    """(fp, other): edges that connect exactly the nodes of each ``root`` that chains of verified links connect.

    A root with many nodes or bytes is cut into tiles; each pair of its tiles is a group, and a tile travels as one value.
    """
    total = sets.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("hashes")).alias("size"))
    total = stage(total.select("root", F.greatest(F.ceil(F.col("n") / SET_ROWS), F.ceil(F.col("size") / SET_BYTES), F.lit(1)).cast(
        "int").alias("tiles")).filter("tiles > 1"), "large-roots")
    placed = sets.join(total, "root", "left")
    schema = "fp binary, other binary"
    whole = placed.filter("tiles is null").select(F.col("root").alias("h"), "node", "hashes")
    whole = whole.repartition("h").sortWithinPartitions("h")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            made = [_verify(x.reset_index(drop=True), None, radius, similarity, width) for _, x in rows.groupby("h", sort=False)]
            yield pa.RecordBatch.from_pandas(pd.concat(made, ignore_index=True), preserve_index=False, schema=pa.schema(
                [("fp", pa.binary()), ("other", pa.binary())]))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"root": [key[0]], "tile": [key[1]], "tiles": [rows["tiles"].iloc[0]],
                             "nodes": [rows["node"].tolist()], "sets": [rows["hashes"].tolist()]})

    cut = placed.filter("tiles is not null").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    tiles = cut.groupBy("root", "tile").applyInPandas(
        pack, "root binary, tile int, tiles int, nodes array<binary>, sets array<binary>")
    sent = tiles.select("root", "tile", "nodes", "sets", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("to")).select(
        "root", "nodes", "sets", (F.col("tile") > F.col("to")).alias("second"), F.least("tile", "to").alias("a"),
        F.greatest("tile", "to").alias("b"))

    def pair(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, second = rows[~rows["second"]], rows[rows["second"]]
        if not len(first) or (key[1] != key[2] and not len(second)):
            return pd.DataFrame({"fp": [], "other": []})
        left, right = (pd.DataFrame({"node": list(x["nodes"].iloc[0]), "hashes": list(x["sets"].iloc[0])}) if len(x) else None
                       for x in (first, second))
        return _verify(left, right, radius, similarity, width)

    return whole.mapInArrow(alone, schema).unionByName(sent.groupBy("root", "a", "b").applyInPandas(pair, schema))


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8, bits: int = 512) -> DataFrame:
    """One document of each group of near-duplicates, all columns unchanged: the smallest ``doc_id`` stays.

    Candidates are texts that share one of the first shingles of their sets, as all pairs of this similarity do, and whose
    wide fingerprints over distinct shingles are within a radius eight standard deviations beyond the mean of the worst such
    pair; chains of them are cut into groups, and only pairs whose sets of shingles have the Jaccard similarity link. Texts
    with equal sets are one node.
    """
    radius = radius_for(similarity, bits, 8.0)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"], text.alias("text"), F.md5(text).alias("h"))
    prints = stage(_set_prints(rows, size, bits, similarity), "set-prints")
    near = components(_links_in_groups(stage(_met(prints, _nodes(prints)), "met"), radius)).withColumnRenamed("node", "of")
    nodes = prints.groupBy("fp", "node").agg(F.min(F.struct("doc_id", "h")).alias("one"))
    nodes = nodes.join(near, F.col("fp") == F.col("of"), "left").select("node", "one", F.coalesce("root", "fp").alias("root"))
    nodes = stage(nodes, "set-nodes")
    met = stage(nodes.groupBy("root").count().filter("count > 1").select("root"), "met-roots")
    some = stage(nodes.join(met, "root", "left_semi").select(
        "root", "node", F.col("one.doc_id").alias("one_id"), F.col("one.h").alias("one_h")), "met-nodes")
    read = rows.join(some, (F.col("h") == F.col("one_h")) & F.col("doc_id").eqNullSafe(F.col("one_id")))
    sets = stage(_sets(read, size).dropDuplicates(["node"]), "sets")
    found = components(_verified_links(sets, radius, similarity, bits // 8)).withColumnRenamed("node", "of")
    rooted = stage(prints.join(found, F.col("node") == F.col("of"), "left").select(
        F.coalesce("root", "node").alias("root"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h").alias("row")), "rooted")
    best = rooted.groupBy("root").agg(F.min("row").alias("kept"), F.max("row").alias("last")).filter("kept != last")
    gone = rooted.join(stage(best.select("root", "kept"), "kept"), "root").filter("row != kept").select(
        F.col("row.doc_id").alias("gone_id"), F.col("row.h").alias("gone_h")).distinct()
    # the row travels as one value, so that its columns may have any names
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("id"), F.md5(text).alias("h"))
    return whole.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("h") == F.col("gone_h")), "left_anti").select("row.*")
