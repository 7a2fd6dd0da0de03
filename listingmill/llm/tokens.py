"""Token counts and ids: batches balanced by bytes, long texts split at safe boundaries.

A space that follows a character other than white space always starts a new word of the byte-level vocabularies, so a long
text is split before such spaces and its pieces are encoded as texts of their own. The pieces of many texts form a batch of
about ``BATCH_BYTES``, whatever the lengths of the texts, and go to the library in one call; nothing but lengths (or ids as
bytes) leaves the worker. Special strings inside texts are treated as the library does by default.

Defined cases: a null text counts as empty; a text without any safe boundary is encoded as one piece; repeated rows, and
rows with a null ``doc_id``, give one row each; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
PIECE_CHARS = 64 << 10
_SAFE = re.compile(r"(?<=\S) ")
#: In texts of these characters all libraries' character classes agree.
_PLAIN = re.compile("[\t-\r -~¡-±´-¸º»¿-ɏ]*")
#: Fixed value: how byte-level vocabularies of this family cut a text into words.
_WORDS = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of about ``size`` characters, cut only before spaces that follow other characters."""
    out, start = [], 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary: itself, or the next one from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """The library of a vocabulary file, loaded once in each worker."""

    def __init__(self, path: str):
        self.path, self.fast, self.splits = path, None, False
        if path.endswith(".model"):  # this library puts a mark before each text, so texts stay whole
            import sentencepiece
            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer, pre_tokenizers
        self.model = Tokenizer.from_file(path)
        cut = self.model.pre_tokenizer
        self.splits = isinstance(cut, pre_tokenizers.ByteLevel) and not cut.add_prefix_space and cut.use_regex \
            and self.model.normalizer is None
        special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        if self.splits:
            self._load_ranks(special)

    def _load_ranks(self, special: list[str]) -> None:
        """The same merges for ``tiktoken``, from the same file, if they are in id order and nothing else is set."""
        import json

        import tiktoken
        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = {letter: b for b, letter in _byte_letters().items()}
        ids = {k: v for k, v in model["vocab"].items() if k not in special}
        ranks = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if ranks == sorted(ranks) and len(ids) == len(ranks) + 256 and not model.get("ignore_merges"):
            self.fast = tiktoken.Encoding("plain", pat_str=_WORDS, special_tokens={}, mergeable_ranks={
                bytes(byte[c] for c in token): n for token, n in ids.items()})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.path.endswith(".model"):
            return self.model.encode(texts, num_threads=1)
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        cut = [pieces(x) if self.splits else [x] for x in texts]
        return [p for x in cut for p in x], np.cumsum([0, *map(len, cut)])

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, by the library of the file."""
        if not texts:
            return np.zeros(0, dtype=np.int64)
        flat, starts = self._cut(texts)
        if self.path.endswith(".model"):
            counts = [len(x) for x in self.encode(flat)]
        else:
            counts = [len(x) for x in self.model.encode_batch_fast(flat, add_special_tokens=False)]
        return np.add.reduceat(np.asarray(counts, dtype=np.int64), starts[:-1])

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text. Plain pieces without special strings run through the same merges in ``tiktoken``, which is
        several times faster; all others through the library of the file."""
        flat, starts = self._cut(texts)
        plain = [bool(self.fast and _PLAIN.fullmatch(x) and not self.special.search(x)) for x in flat]
        others = iter(self.encode([x for x, p in zip(flat, plain) if not p]))
        for a, b in zip(starts, starts[1:]):
            yield np.asarray([n for i in range(a, b) for n in (
                self.fast.encode_ordinary(flat[i]) if plain[i] else next(others))], dtype="<u4")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in by_bytes(batches, "text"):
            texts = some.column("text")
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), pc.binary_length(texts).cast(pa.int64()),
                 pa.array(encoder(path).lengths(texts.to_pylist()))], names=["doc_id", "n_bytes", "n_tokens"])

    out = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
