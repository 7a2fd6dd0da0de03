"""Chat formatting: a sandboxed template language, compiled to Python closures.

A template is parsed into a syntax tree; operators and filters on constants are folded, constant conditions are pruned and
neighbouring constants merged; what is left becomes closures that yield pieces of text with a flag: is the piece inside a
``{% generation %}`` block, that is, under the loss mask.

The language: text, ``{{ expression }}``, ``{% for x in list %}``, ``{% if %} {% elif %} {% else %}``, ``{% set %}``,
``{% generation %}``, each closed by ``{% end... %}``; a ``-`` inside a tag trims the white space on its side. Expressions:
strings, whole numbers, true, false, none, names, ``x.key`` and ``x['key']`` on message fields, ``+ ~ == != and or not in``,
parentheses and the filters of ``FILTERS``. There are no calls, no attributes of Python objects and no loops but over given
lists, so a template can reach nothing but its input and ends after one pass over it.

A loop pulls its list as it goes, so a conversation streams through a template turn by turn: one of any length needs the
memory of one turn. Its output comes in parts of about ``PART_CHARS`` characters, cut between pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

PART_CHARS = 1 << 20
MARK = re.compile(r"<(\\*)\|")
MARKED = re.compile(r"<(\\+)\|")

CHAT_TEMPLATE = (
    "{% for message in messages %}{{ '<|im_start|>' + message.role | escape_line + '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}{{ '<|im_end|>' ~ '\\n' }}{% endfor %}")


def escape(text: str) -> str:
    r"""Control strings begin with ``<|``; a backslash goes between, one more than were there."""
    return MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return MARKED.sub(lambda m: "<" + m[1][1:] + "|", text)


def escape_line(text: str) -> str:
    """Also keeps the text on one line."""
    return escape(text.replace("%", "%25").replace("\n", "%0A"))


def unescape_line(text: str) -> str:
    return unescape(text).replace("%0A", "\n").replace("%25", "%")


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(str(v)), "escape_line": lambda v: escape_line(str(v)), "trim": lambda v: str(v).strip(),
    "upper": lambda v: str(v).upper(), "lower": lambda v: str(v).lower(), "length": lambda v: len(v),
}
OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b, "~": lambda a, b: shown(a) + shown(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b, "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}
LEVELS = (("or",), ("and",), ("==", "!=", "in"), ("+", "~"))
TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.S)
TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+~|.()\[\]=]))""")
WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """The template is not of this language."""


def shown(value) -> str:
    return "" if value is None else str(value)


# --- parsing: a tree of tuples (kind, ...) -----------------------------------

class _Expression:
    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            text, number, name, sign = m.groups()
            if text is not None:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda x: ESCAPES.get(x[1], x[1]), text[1:-1], flags=re.S)))
            elif number is not None:
                self.tokens.append(("const", int(number)))
            else:
                self.tokens.append(("sign", sign) if sign else ("name", name))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *wanted: str) -> str | None:
        kind, value = self.peek()
        if kind in ("sign", "name") and value in wanted:
            self.at += 1
            return value
        return None

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"a name is missing before {value!r}")
        self.at += 1
        return value

    def whole(self):
        tree = self.level(0)
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def level(self, n: int):
        if n == len(LEVELS):
            return self.filtered()
        if n == 2 and self.take("not"):
            return ("not", self.level(n))
        left = self.level(n + 1)
        while op := self.take(*LEVELS[n]):
            left = ("op", op, left, self.level(n + 1))
        return left

    def filtered(self):
        tree = self.atom()
        while True:
            if self.take("."):
                tree = ("item", tree, ("const", self.name()))
            elif self.take("["):
                tree = ("item", tree, self.level(0))
                if not self.take("]"):
                    raise TemplateError("a ] is missing")
            elif self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                tree = ("filter", name, tree)
            else:
                return tree

    def atom(self):
        kind, value = self.peek()
        if self.take("("):
            tree = self.level(0)
            if not self.take(")"):
                raise TemplateError("a ) is missing")
            return tree
        self.at += 1
        if kind == "const":
            return ("const", value)
        if kind == "name":
            return ("const", WORDS[value]) if value in WORDS else ("get", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template: ("block", nodes)."""
    stack: list[tuple[str, list]] = [("", [])]
    at, trim = 0, False

    def add(node) -> None:
        stack[-1][1].append(node)

    def text(upto: int, cut: bool) -> None:
        piece = source[at:upto]
        piece = piece.lstrip() if trim else piece
        piece = piece.rstrip() if cut else piece
        if piece:
            add(("text", piece))

    for m in TAG.finditer(source):
        out, tag = m[2], m[5]
        text(m.start(), bool(m[1] or m[4]))
        at, trim = m.end(), bool(m[3] or m[6])
        if out is not None:
            add(("out", _Expression(out).whole()))
            continue
        e = _Expression(tag)
        word = e.name()
        if word == "for":
            name = e.name()
            if not e.take("in"):
                raise TemplateError("a loop reads: for name in list")
            stack.append(("for", [name, e.whole()]))
        elif word == "if":
            stack.append(("if", [e.whole()]))
        elif word in ("elif", "else"):
            if stack[-1][0] != "if":
                raise TemplateError(f"{word} outside of if")
            add((word, e.whole() if word == "elif" else ("const", True)))
        elif word == "set":
            name = e.name()
            if not e.take("="):
                raise TemplateError("an assignment reads: set name = value")
            add(("set", name, e.whole()))
        elif word == "generation":
            stack.append(("generation", []))
        elif word in ("endfor", "endif", "endgeneration") and stack[-1][0] == word[3:]:
            kind, held = stack.pop()
            add(_closed(kind, held))
        else:
            raise TemplateError(f"unexpected {word!r}")
    text(len(source), False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return ("block", stack[0][1])


def _closed(kind: str, held: list) -> tuple:
    if kind == "for":
        return ("for", held[0], held[1], ("block", held[2:]))
    if kind == "generation":
        return ("generation", ("block", held))
    branches = [[held[0], []]]
    for node in held[1:]:
        if node[0] in ("elif", "else"):
            branches.append([node[1], []])
        else:
            branches[-1][1].append(node)
    return ("if", [(test, ("block", body)) for test, body in branches])


# --- folding ------------------------------------------------------------------

def fold(tree: tuple) -> tuple:
    kind = tree[0]
    if kind == "op":
        op, a, b = tree[1], fold(tree[2]), fold(tree[3])
        if a[0] == "const" and b[0] == "const":
            return ("const", OPERATORS[op](a[1], b[1]))
        if op in ("+", "~") and b[0] == "const" and a[0] == "op" and a[1] == op and a[3][0] == "const":
            return ("op", op, a[2], ("const", OPERATORS[op](a[3][1], b[1])))
        return ("op", op, a, b)
    if kind in ("not", "item", "filter"):
        parts = [fold(x) if isinstance(x, tuple) else x for x in tree[1:]]
        if kind == "filter" and parts[1][0] == "const":
            return ("const", FILTERS[parts[0]](parts[1][1]))
        if kind == "not" and parts[0][0] == "const":
            return ("const", not parts[0][1])
        return (kind, *parts)
    if kind == "out":
        value = fold(tree[1])
        return ("text", shown(value[1])) if value[0] == "const" else ("out", value)
    if kind == "block":
        nodes: list[tuple] = []
        for node in map(fold, tree[1]):
            some = node[1] if node[0] == "block" else [node]
            for x in some:
                if x[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + x[1])
                elif x != ("text", ""):
                    nodes.append(x)
        return ("block", nodes)
    if kind == "if":
        left = []
        for test, body in ((fold(t), fold(b)) for t, b in tree[1]):
            if test[0] != "const" or test[1]:
                left.append((test, body))
            if test[0] == "const" and test[1]:
                break
        return left[0][1] if left and left[0][0][0] == "const" else ("if", left)
    if kind == "for":
        return ("for", tree[1], fold(tree[2]), fold(tree[3]))
    if kind == "generation":
        return ("generation", fold(tree[1]))
    if kind == "set":
        return ("set", tree[1], fold(tree[2]))
    return tree


# --- closures -----------------------------------------------------------------

def _value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda scope, v=tree[1]: v
    if kind == "get":
        return lambda scope, name=tree[1]: scope.get(name)
    if kind == "item":
        of, key = _value(tree[1]), _value(tree[2])
        return lambda scope: x.get(key(scope)) if isinstance(x := of(scope), dict) else None
    if kind == "filter":
        fn, inner = FILTERS[tree[1]], _value(tree[2])
        return lambda scope: fn(inner(scope))
    if kind == "not":
        inner = _value(tree[1])
        return lambda scope: not inner(scope)
    op, a, b = tree[1], _value(tree[2]), _value(tree[3])
    if op == "and":
        return lambda scope: a(scope) and b(scope)
    if op == "or":
        return lambda scope: a(scope) or b(scope)
    fn = OPERATORS[op]
    return lambda scope: fn(a(scope), b(scope))


def _writer(tree: tuple, marked: bool = False) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    kind = tree[0]
    if kind == "text":
        piece = [(tree[1], marked)]
        return lambda scope: iter(piece)
    if kind == "out":
        value = _value(tree[1])
        return lambda scope: iter([(shown(value(scope)), marked)])
    if kind == "set":
        name, value = tree[1], _value(tree[2])
        return lambda scope: iter(scope.__setitem__(name, value(scope)) or ())
    if kind == "generation":
        return _writer(tree[1], True)
    if kind == "block":
        nodes = [_writer(x, marked) for x in tree[1]]

        def block(scope):
            for node in nodes:
                yield from node(scope)
        return block
    if kind == "if":
        branches = [(_value(t), _writer(b, marked)) for t, b in tree[1]]

        def choose(scope):
            for test, body in branches:
                if test(scope):
                    yield from body(scope)
                    return
        return choose
    name, items, body = tree[1], _value(tree[2]), _writer(tree[3], marked)

    def loop(scope):
        inner = dict(scope)
        for n, item in enumerate(items(scope) or ()):
            inner[name], inner["loop"] = item, {"index": n + 1, "index0": n, "first": n == 0}
            yield from body(inner)
    return loop


@lru_cache(maxsize=64)
def compiled(source: str) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    """Closure that yields (text, under the loss mask) for a scope such as {"messages": ...}."""
    return _writer(fold(parse(source)))


# --- conversations ------------------------------------------------------------

def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _parts(pieces: Iterable[tuple[str, bool]], size: int) -> Iterator[tuple[str, list[list[int]]]]:
    """Text and mask spans (code points) of each part."""
    held, spans, n, some = [], [], 0, False
    for text, masked in pieces:
        if n and n + len(text) > size:
            yield "".join(held), spans
            held, spans, n = [], [], 0
        some = True
        held.append(text)
        if masked:
            spans.append([n, n + len(text)])
        n += len(text)
    if held or not some:
        yield "".join(held), spans


def format_conversations(turns: DataFrame, template: str = CHAT_TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """Conversations, by rows of turns (conv_id, turn, role, text), to (conv_id, part, formatted, spans).

    ``spans`` are the [start, end) code points of the part under the loss mask. Turns are ordered by turn, null first, ties by
    role and text; repeated rows are repeated turns; null roles and texts are empty; rows without ``conv_id`` are one
    conversation; other columns are ignored; an empty table gives an empty result. The parts of a conversation stay
    together in one partition, in order.
    """
    empty = F.lit("")
    rows = turns.select(
        turns["conv_id"], turns["turn"], F.coalesce(turns["role"].cast("string"), empty).alias("role"),
        F.coalesce(turns["text"].cast("string"), empty).alias("text"))
    kind = dict(rows.dtypes)["conv_id"]
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = compiled(template)
        schema = pa.schema([("conv_id", key_type), ("part", pa.int32()), ("formatted", pa.string()),
                            ("spans", pa.list_(pa.list_(pa.int32())))])
        out, size = [], 0
        for conv, group in groupby(_rows(batches), key=lambda r: r[0]):
            messages = ({"role": role, "text": text} for _, _, role, text in group)
            for n, (text, spans) in enumerate(_parts(write({"messages": messages}), part_chars)):
                out.append((conv, n, text, spans))
                size += len(text)
                if size > part_chars:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    key_type = to_arrow_type(rows.schema["conv_id"].dataType)
    return dealt.mapInArrow(render, f"conv_id {kind}, part int, formatted string, spans array<array<int>>")


TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the default template's output says, one row per conversation: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. Reads the parts as they lie, so call it on ``format_conversations`` directly."""
    kind = dict(formatted.dtypes)["conv_id"]
    key_type = to_arrow_type(formatted.schema["conv_id"].dataType)

    def digest(parts) -> tuple:
        turns, loss, n_turns, loss_chars, chars, rest = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
        for _, _, text, spans in parts:
            chars += len(text)
            for a, b in spans:
                plain = unescape(text[a:b])
                loss.update(plain.encode())
                loss_chars += len(plain)
            rest, end = rest + text, 0
            for m in TURN.finditer(rest):
                turns.update(f"{unescape_line(m[1])}\n{unescape(m[2])}\n".encode())
                n_turns, end = n_turns + 1, m.end()
            rest = rest[end:]
        return n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", key_type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        out = [(conv, *digest(group)) for conv, group in groupby(_rows(batches), key=lambda r: r[0])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return formatted.mapInArrow(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
