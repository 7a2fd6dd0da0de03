"""Packing by cutting-stock column generation.

Documents become token ids and an end id. Full sequences are cut off long documents; what is left over (1 to ``size`` ids) is
counted by length class, a histogram of fixed width however large the input is. A linear program over filling patterns of
that histogram is solved by column generation: its dual prices go to a knapsack dynamic program, which returns the next
pattern, until the price bound shows that less than ``GAP`` can be gained. Rounded pattern counts then meet documents by
their rank in their length class: the r-th document of a class belongs to the pattern, sequence and slot that hold the r-th
item of that class, found by a join on few ranges. Ranks come from small random buckets inside a class and the sizes of the
buckets before, so a class that holds a third of all documents is no single task.

The rounding leaves less than one use of each pattern: at most as many sequences as there are classes. Those documents are
laid end to end and cut into full sequences, the last one into powers of two, which need no padding.

Defined cases: a null text counts as empty and is its end id alone; repeated rows are packed each; a null ``doc_id`` is kept; an
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from listingmill.llm.tokens import by_bytes, encoder
from listingmill.sources.workspace import stage

SIZE = 2048
END_ID = 1
CLASS_WIDTH = 4
GAP = 5e-4
MAX_COLUMNS = 4000
BUCKET_ROWS = 200_000


# --- the linear program ---------------------------------------------------------

def _knapsack(prices: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """Best price of items of 1 .. len(prices) units in ``capacity`` units, any number of each; item units and counts."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        n = min(room, len(prices))
        gain = prices[:n] + best[room - n:room][::-1]
        k = int(gain.argmax())
        best[room], took[room] = gain[k], k + 1
    pattern, room = {}, capacity
    while room > 0 and best[room] > 0:
        pattern[int(took[room])] = pattern.get(int(took[room]), 0) + 1
        room -= int(took[room])
    return float(best[capacity]), pattern


def column_generation(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], float]]:
    """Patterns (units of length -> items) and how often to use each, from the linear program

    minimise uses, such that the patterns hold ``demand`` items of each length; revised simplex, one column at a time.
    """
    lengths = sorted(demand)
    if not lengths:
        return []
    m, place = len(lengths), {u: i for i, u in enumerate(lengths)}
    need = np.array([demand[u] for u in lengths], dtype=float)
    basis = [{u: capacity // u} for u in lengths]
    inverse = np.diag([1.0 / (capacity // u) for u in lengths])
    uses = inverse @ need
    for _ in range(MAX_COLUMNS):
        duals = inverse.sum(axis=0)
        prices = np.zeros(capacity)
        prices[np.array(lengths) - 1] = np.maximum(duals, 0)
        value, pattern = _knapsack(prices, capacity)
        if value <= 1 + GAP:  # no solution is better than the present one divided by this value
            break
        column = np.zeros(m)
        for u, n in pattern.items():
            if u in place:
                column[place[u]] = n
        step = inverse @ column
        ok = step > 1e-9
        ratios = np.where(ok, uses / np.where(ok, step, 1), np.inf)
        out = int(ratios.argmin())
        theta = ratios[out]
        uses = np.maximum(uses - theta * step, 0)
        uses[out] = theta
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        basis[out] = {u: n for u, n in pattern.items() if u in place}
    return [(p, float(x)) for p, x in zip(basis, uses) if x > 1e-7]


def rounded(patterns: list[tuple[dict[int, int], float]], demand: dict[int, int]) -> list[tuple[dict[int, int], int]]:
    """Whole uses: rounded down first, then one more of each pattern, largest fraction first, while items last."""
    left, out = dict(demand), []
    for p, x in patterns:
        n = min([math.floor(x + 1e-6), *(left[u] // k for u, k in p.items())])
        out.append([p, n, x - n])
        for u, k in p.items():
            left[u] -= n * k
    for row in sorted(out, key=lambda r: -r[2]):
        if all(left[u] >= k for u, k in row[0].items()):
            row[1] += 1
            for u, k in row[0].items():
                left[u] -= k
    return [(p, n) for p, n, _ in out if n]


# --- documents -------------------------------------------------------------------

def tokenised(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """Pieces before packing: uid, doc_id, start, length, ids (little-endian unsigned 32-bit), ids_crc32, doc_tokens.

    Every piece but the last of a document has ``size`` ids. ``uid`` is unique once the table is written.
    """
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    kind, arrow = dict(rows.dtypes)["doc_id"], to_arrow_type(rows.schema["doc_id"].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            out: list[list] = [[], [], [], [], [], []]
            texts, names = some.column("text").to_pylist(), some.column("doc_id").to_pylist()
            for doc, ids in zip(names, encoder(path).ids(texts)):
                raw, total = ids.tobytes() + END_ID.to_bytes(4, "little"), len(ids) + 1
                for start in range(0, total, size):
                    part = raw[4 * start:4 * (start + size)]
                    for c, v in zip(out, (doc, start, len(part) // 4, part, zlib.crc32(part), total)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (arrow, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens"])

    made = rows.mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long")
    return made.withColumn("uid", F.monotonically_increasing_id())


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank``, 0 .. n - 1 inside each ``units`` class."""
    buckets = max(1, math.ceil(rows / BUCKET_ROWS)) * 4
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    sizes = dealt.groupBy("units", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("units").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = dealt.withColumn("place", F.row_number().over(Window.partitionBy("units", "bucket").orderBy("uid")) - 1)
    return inside.join(before, ["units", "bucket"]).withColumn("rank", F.col("before") + F.col("place")).drop(
        "bucket", "before", "place")


def _plan_rows(plan: list[tuple[dict[int, int], int]]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(units, from rank, to rank, items per sequence, first sequence) of each class in each pattern; sequences in all."""
    rows, taken, sequence = [], {}, 0
    for pattern, n in plan:
        for units, items in pattern.items():
            start = taken.get(units, 0)
            rows.append((units, start, start + n * items, items, sequence))
            taken[units] = start + n * items
        sequence += n
    return rows, sequence


def pack(docs: DataFrame, path: str, size: int = SIZE, width: int = CLASS_WIDTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids."""
    spark = docs.sparkSession
    pieces = stage(tokenised(docs, path, size), "pieces")
    narrow = pieces.select("uid", "length", F.ceil(F.col("length") / width).cast("int").alias("units"))
    capacity = size // width
    counts = {r["units"]: r["n"] for r in narrow.groupBy("units").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = counts.get(capacity, 0)  # fills a sequence by itself
    demand = {u: n for u, n in counts.items() if u != capacity}
    plan = rounded(column_generation(demand, capacity), demand)
    rows, used = _plan_rows([*plan, *([({capacity: 1}, whole)] if whole else [])])
    table = spark.createDataFrame(
        rows, "units int, from_rank long, to_rank long, items int, first_sequence long")  # at most patterns x items rows

    ranked = stage(_ranked(narrow, sum(counts.values())), "ranked")
    met = ranked.join(table, (ranked["units"] == table["units"]) & (ranked["rank"] >= F.col("from_rank"))
                      & (ranked["rank"] < F.col("to_rank")), "left").select(
        "uid", "length", "rank", ranked["units"], "from_rank", F.when(
            F.col("items").isNotNull(), F.col("first_sequence") + F.floor((F.col("rank") - F.col("from_rank")) / F.col("items"))
        ).alias("sequence_id"))
    met = stage(met, "dealt")
    fixed = met.filter("sequence_id is not null").withColumn("offset", F.coalesce(F.sum("length").over(
        Window.partitionBy("sequence_id").orderBy("units", "uid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = fixed.select("uid", "sequence_id", "offset")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    packed = pieces.join(placed, "uid").select(*columns)
    return packed.unionByName(_rest(pieces, met.filter("sequence_id is null"), used, size).select(*columns))


def _rest(pieces: DataFrame, left: DataFrame, first: int, size: int) -> DataFrame:
    """What the rounding left, end to end. At most one use of each pattern, so its rows are bounded by the classes."""
    line = left.select("uid", "length", F.coalesce(F.sum("length").over(
        Window.orderBy("units", "rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("from"))
    line = stage(line, "rest")  # its true size lets the planner broadcast it rather than shuffle all ids
    total = int(line.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])
    # ends of the sequences: full ones, then the powers of two of what is left
    full = total // size * size
    tail = [1 << b for b in range(size.bit_length() - 1, -1, -1) if (total - full) >> b & 1]
    tail_ends = np.cumsum([full, *tail]).tolist()
    row = pieces.join(line.select("uid", "from"), "uid")
    kind, arrow = dict(pieces.dtypes)["doc_id"], to_arrow_type(pieces.schema["doc_id"].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc, start, raw, tokens, at in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "start", "ids", "doc_tokens", "from"))):
                done, n = 0, len(raw) // 4
                while done < n:
                    here = at + done
                    if here < full:
                        sequence, begin, end = here // size, here // size * size, (here // size + 1) * size
                    else:
                        k = int(np.searchsorted(tail_ends, here, side="right"))
                        sequence, begin, end = full // size + k - 1, tail_ends[k - 1], tail_ends[k]
                    stop = min(n, done + end - here)
                    part = raw[4 * done:4 * stop]
                    for c, v in zip(out, (doc, start + done, stop - done, zlib.crc32(part), tokens, first + sequence,
                                          here - begin, part)):
                        c.append(v)
                    done = stop
            types = (arrow, *[pa.int64()] * 6, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return row.select("doc_id", "start", "ids", "doc_tokens", "from").mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (the pieces' ids one after another), doc_ids, offsets."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
