"""Text expressions.  All stay on the JVM; word classes are spelled out because
Java's ``\\w`` and ``\\b`` only know ASCII."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NOT_AFTER_WORD = r"(?<![\p{L}\p{N}_])"
NOT_BEFORE_WORD = r"(?![\p{L}\p{N}_])"
SPACE = r"[\s\p{Z}]"

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+(?=(\.0*)?\s*$)"


def quote(word: str) -> str:
    """Escape a word for a regular expression."""
    return "".join("\\" + ch if ch in r"\.[]{}()*+?^$|-" else ch for ch in word)


def contains_any(text: Column, words: Sequence[str], whole_words: bool = False) -> Column:
    """True where lower-case ``text`` contains one of ``words``; null text is false.

    The default is a plain substring test.  ``whole_words`` asks for word bounds.
    """
    if whole_words:
        hit = text.rlike(
            NOT_AFTER_WORD + "(?:" + "|".join(quote(w) for w in words) + ")" + NOT_BEFORE_WORD
        )
    else:
        hit = reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    return F.coalesce(hit, F.lit(False))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, the empty text when there is none."""
    return F.regexp_extract(text, pattern, group)


def number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    return F.regexp_substr(text, F.lit(_NUMBER)).try_cast("double")


def whole_number(text: Column) -> Column:
    """Text to bigint; null unless it is a number without a fraction."""
    return F.regexp_substr(text, F.lit(_WHOLE_NUMBER)).try_cast("bigint")


def trim_ws(text: Column) -> Column:
    """Strip every kind of white space at both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, so ``biel/bienne``
    becomes ``Biel/Bienne`` (``initcap`` only splits on blanks)."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))),
        "",
    )


def tokens(text: Column) -> Column:
    """White-space separated tokens of the lower-cased text; punctuation sticks."""
    return F.split(F.lower(text), SPACE + "+")


def words(text: Column) -> Column:
    """Runs of at least two word characters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD + "{2,}"), F.lit(0))


def strip_tags(html: Column) -> Column:
    """Inner text of an HTML fragment: tags removed, common entities decoded, trimmed."""
    bare = F.regexp_replace(html, r"<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return trim_ws(bare)
