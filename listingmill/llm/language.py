"""Language ID by cross-parsing entropy.

A suffix automaton is built over labelled text of each language. A text is then parsed, left to right, into the longest
phrases that occur in the language's sample; text that is like the sample needs few phrases. The language that needs fewest
phrases per character wins, and the score is how much fewer it needs than the runner-up.

The sample is bounded: per language the ``DOCS_PER_LANGUAGE`` labelled documents with the smallest hash of their identifier,
``EXCERPT`` characters from the middle of each; beyond 64 languages fewer of each, so that all share ``SAMPLED_DOCS`` and none
is left out. Everything else covers whole texts: they are cut into blocks of ``BLOCK`` characters, a phrase ends with its block, and the blocks of many
texts walk through the automata side by side, so a long text is no long task by itself.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without labelled rows every text is; rows with
a null language are never learnt from; ties go to the first language in alphabetical order; repeated rows give one row each;
an empty table gives an empty result; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingmill.llm.tokens import by_bytes

DOCS_PER_LANGUAGE = 256
EXCERPT = 160
SAMPLED_DOCS = 64 * DOCS_PER_LANGUAGE
BLOCK = 1024
BATCH_BYTES = 2 << 20
UNKNOWN = "und"
ALPHABET = 63  # letters of a language that are looked up in its dense table; the others are searched


@lru_cache(maxsize=1)
def _folded() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower-case letter or a space, and whether it is a letter."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    fold = np.full(0x110000, 32, dtype=np.uint32)
    for c in np.nonzero(letter)[0].tolist():
        low = chr(c).lower()
        fold[c] = ord(low) if len(low) == 1 else c
    return fold, letter


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the automaton of all substrings; state 0 is the empty string."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        here = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = here
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    return moves


class Table:
    """Next state for state and symbol, times two, plus one if a new phrase begins with the symbol.

    State 0 is between phrases; symbol 0, which the sample has not, is a phrase of its own. Symbols below ``width`` are looked
    up in a dense table, all others among the sorted transitions."""

    def __init__(self, moves: list[dict[int, int]], letters: int):
        self.width, self.letters = min(letters, ALPHABET) + 1, letters + 1
        self.first = np.array([2 * moves[0].get(c, 0) + 1 for c in range(self.letters)], dtype=np.int32)
        self.dense = np.tile(self.first[:self.width], len(moves))
        keys = np.fromiter((s * self.letters + c for s, m in enumerate(moves) if s for c in m if c > 0), dtype=np.int64)
        to = np.fromiter((2 * t for s, m in enumerate(moves) if s for c, t in m.items() if c > 0), dtype=np.int32)
        state, c = keys // self.letters, keys % self.letters
        often = c < self.width
        self.dense[state[often] * self.width + c[often]] = to[often]
        order = np.argsort(keys[~often])
        self.keys, self.to = keys[~often][order], to[~often][order]

    def moves(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        rare = np.nonzero(symbol >= self.width)[0] if self.letters > self.width else ()
        if not len(rare):
            return self.dense[state * self.width + symbol]
        out = self.dense[state * self.width + np.where(symbol < self.width, symbol, 0)]
        out[rare] = self.first[symbol[rare]]
        key = state[rare].astype(np.int64) * self.letters + symbol[rare]
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == key if len(self.keys) else np.zeros(len(at), dtype=bool)
        out[rare[hit]] = self.to[at[hit]]
        return out


class Parser:
    """The automata of all languages, as tables. Every letter of a sample has a symbol; 0 is a letter that no sample has."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        fold, _ = _folded()
        self.languages = [lang for lang, _ in samples]
        texts = [[fold[_points(x)] for x in some] for _, some in samples]
        known = np.unique(np.concatenate([x for some in texts for x in some] or [np.zeros(0, np.uint32)]))
        symbol = np.zeros(0x110000, dtype=np.int32)
        symbol[known] = np.arange(1, len(known) + 1)
        self.symbol = symbol[fold]
        self.tables, self.local = [], []
        for some in texts:
            # the language's own numbers, the most frequent letters first
            values, counts = np.unique(np.concatenate([symbol[x] for x in some] or [np.zeros(0, np.int32)]), return_counts=True)
            local = np.zeros(len(known) + 1, dtype=np.int32)
            local[values[np.argsort(-counts, kind="stable")]] = np.arange(1, len(values) + 1)
            line: list[int] = []
            for x in some:
                line += local[symbol[x]].tolist() + [-1]  # no phrase crosses two excerpts
            self.tables.append(Table(suffix_automaton(line), len(values)))
            self.local.append(local)

    def phrases(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Phrases of each language in each text; texts lie one after another and begin at ``starts``."""
        ends = np.append(starts[1:], len(symbols))
        per = -(-(ends - starts) // BLOCK)
        owner = np.repeat(np.arange(len(starts)), per)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begin = starts[owner] + within * BLOCK
        size = np.minimum(BLOCK, ends[owner] - begin)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
        out = np.zeros((len(self.tables), len(starts)), dtype=np.int64)
        for k, table in enumerate(self.tables):
            mine = self.local[k][symbols]
            state, count = np.zeros(len(begin), dtype=np.int32), np.zeros(len(begin), dtype=np.int64)
            for step, n in enumerate(active):
                move = table.moves(state[:n], mine[begin[:n] + step])
                count[:n] += move & 1
                state[:n] = move >> 1
            np.add.at(out[k], owner, count)
        return out


@lru_cache(maxsize=2)
def _parser(samples: tuple[tuple[str, tuple[str, ...]], ...]) -> Parser:
    return Parser(samples)


def learn(docs: DataFrame, usable: Column | None = None) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The bounded sample: (language, excerpts), from the rows where ``usable`` holds and language and text are not null."""
    rows = docs.filter(docs["lang"].isNotNull() & docs["text"].isNotNull() & (F.lit(True) if usable is None else usable))
    languages = rows.select(docs["lang"].alias("lang")).distinct().count()
    each = max(1, min(DOCS_PER_LANGUAGE, SAMPLED_DOCS // max(languages, 1)))
    text = docs["text"].cast("string")
    some = rows.select(
        docs["lang"].alias("lang"), F.xxhash64(docs["doc_id"]).alias("draw"),
        F.substr(text, F.greatest(F.lit(1), F.floor(F.length(text) / 2).cast("int") - EXCERPT // 2), F.lit(EXCERPT)).alias("excerpt"))
    first = some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "excerpt")))
    held: dict[str, list[str]] = {}
    for r in sorted(first.filter(F.col("place") <= each).collect(), key=lambda r: (r["lang"], r["place"])):
        held.setdefault(r["lang"], []).append(r["excerpt"])
    return tuple((lang, tuple(x)) for lang, x in sorted(held.items()))


def predict(docs: DataFrame, samples: tuple[tuple[str, tuple[str, ...]], ...]) -> DataFrame:
    """One row per document: doc_id, lang_pred and score (0 to 1)."""
    rows = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # bounded by the sample's parameters
    kind = dict(rows.dtypes)["doc_id"]

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text", BATCH_BYTES):
            texts = [x or "" for x in some.column("text").to_pylist()]
            langs, scores, _ = _guess(_parser(shared.value), texts)
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*some.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(guess, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, languages: Sequence[str] | None = None) -> DataFrame:
    """The documents whose language is known, all columns unchanged; learnt from the documents themselves.

    ``languages``: only these. Without labelled documents there is nothing to compare with, so that every document with a letter
    stays, whatever ``languages`` says.
    """
    samples = learn(docs)
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    wanted = None if languages is None or not samples else set(languages)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text", BATCH_BYTES):
            langs, _, letters = _guess(_parser(shared.value), [x or "" for x in some.column("text").to_pylist()])
            yield some.filter(pa.array([bool(has) and (wanted is None or lang in wanted) for lang, has in zip(langs, letters)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def _guess(parser: Parser, texts: list[str]) -> tuple[list[str], list[float], np.ndarray]:
    """Language and score of each text, and whether it has a letter."""
    points = [_points(x) for x in texts]
    starts = np.cumsum([0, *map(len, points)])[:-1]
    flat = np.concatenate(points) if points else np.zeros(0, np.uint32)
    _, letter = _folded()
    letters = np.concatenate([[0], np.cumsum(letter[flat])])
    has = letters[np.append(starts[1:], len(flat))] > letters[starts]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not parser.languages or not texts:
        return langs, scores, has
    counts = parser.phrases(parser.symbol[flat], starts)
    best = counts.argmin(axis=0)
    ranked = np.sort(counts, axis=0)
    gain = 1 - ranked[0] / np.maximum(ranked[1] if len(ranked) > 1 else ranked[0] * 2, 1)
    for i in np.nonzero(has)[0].tolist():
        langs[i], scores[i] = parser.languages[best[i]], float(gain[i])
    return langs, scores, has


def held_out(docs: DataFrame) -> Column:
    """The fold that is never learnt from: a quarter of all documents, by a checksum of the identifier."""
    return F.coalesce(F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learnt from the documents that are not held out."""
    samples = learn(docs, ~held_out(docs))
    out = predict(docs, samples)
    return out.select("doc_id", held_out(out).alias("held_out"), "lang_pred", "score")
