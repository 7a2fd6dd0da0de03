"""Repair of conversation structure: turns are aligned with the alternating grammar at the least cost.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in pairs: its role initials are
``(s?(ua)+)?``. For each feasible length, the grammar has one string of initials (odd: with a system turn). Turns are aligned
with each of these strings by Wagner and Fischer's table. The incumbent, the cheapest alignment so far, gives Ukkonen's band: a
cell whose surplus of turns before it and after it already costs more in deletions and insertions lies outside, and so does a
length as a whole. Costs are summed from the end, so that the walk back from the first cell picks, of equally cheap edits, the
one with the smallest letter; its letters are the audit, and the audits of all lengths are compared.

Edits: (K)eep 0, (R)erole to user or assistant 2, (D)elete 3, (I)nsert an empty user or assistant turn 2. Blank turns and those
whose role and text were seen earlier in the conversation must be deleted; an undeleted truncated turn adds 1.

A conversation streams through one task in order and is never collected: ``BLOCK_TURNS`` turns at a time are aligned from each
state of the grammar (start, after s, after u, after a) to each state, and the cheapest way to every state is kept with its
audit and a running SHA-256 of the repaired turns. Of two equally cheap audits of the same turns none is a prefix of the other
(the longer one would have inserted more), so the smaller stays smaller whatever follows and blocks lose nothing. What is held
besides a block is a letter per turn. Copies of a block's pattern are aligned once in each worker.

Defined cases: a null role or text counts as one space; a null ``conv_id`` is a conversation of its own; null turns come first;
turns of the same number are ordered by role and text; rows that repeat are copies, the later of which are duplicates; turns of
any length count whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TURNS = 32
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START = "^"  # the state before any turn; the others are called by the last initial
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}
BLANK = r"^[ \t-\r]*\z"
CUT_OFF = r"[^.!? \t-\r][ \t-\r]*\z"


# --- the grammar -----------------------------------------------------------------

def target(state: str, length: int, system: bool) -> str:
    """The initials of ``length`` turns after ``state``; ``system``: the first is a system turn (at the start only)."""
    first = "s" if system else ""
    pairs = "au" if state == "u" else "ua"
    return first + (pairs * (length // 2 + 1))[:length - len(first)]


# --- alignment of one block ------------------------------------------------------

def align(turns: str, goal: str, most: float) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of ``turns`` into the initials ``goal``, if they cost ``most`` or less.

    A turn is the initial of its role (``-``: another role), in capitals if truncated, or ``x`` if it must be deleted.
    """
    n, m = len(turns), len(goal)
    forced = [0] * (n + 1)  # turns after i that must go
    for i in range(n - 1, -1, -1):
        forced[i] = forced[i + 1] + (turns[i] == "x")

    def least(gone: int, rows: int, columns: int) -> int:
        """No edits of ``rows`` turns, ``gone`` of which must go, into ``columns`` initials are cheaper."""
        out = max(gone, rows - columns)
        return DELETE * out + INSERT * (columns - rows + out)

    table: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = table[i], table[i + 1] if i < n else {}
        for j in range(m, -1, -1):
            if least(forced[0] - forced[i], i, j) + least(forced[i], n - i, m - j) > most:
                continue
            best = 0 if i == n and j == m else math.inf
            if i < n and j in below:
                best = below[j] + DELETE
            if j < m and goal[j] != "s" and j + 1 in row:
                best = min(best, row[j + 1] + INSERT)
            if i < n and j < m and j + 1 in below:
                best = min(best, below[j + 1] + _match(turns[i], goal[j]))
            if best < math.inf:
                row[j] = best
    if 0 not in table[0] or table[0][0] > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:  # letters in ASCII order: D, I, K, R
        here = table[i][j]
        if i < n and table[i + 1].get(j, math.inf) + DELETE == here:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != "s" and table[i].get(j + 1, math.inf) + INSERT == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == goal[j] else "R")
            i, j = i + 1, j + 1
    return table[0][0], "".join(audit)


def _match(turn: str, initial: str) -> float:
    if turn == "x":
        return math.inf
    fault = TRUNCATED if turn.isupper() or turn == "=" else 0
    if turn.lower() == initial:
        return KEEP + fault
    return math.inf if initial == "s" else REROLE + fault


@lru_cache(maxsize=1 << 14)
def ways(turns: str, state: str, last: bool) -> dict[str, tuple[int, str]]:
    """The cheapest (cost, audit) from ``state`` to each state, by way of ``turns``; ``last``: to states that may end."""
    best: dict[str, tuple[int, str]] = {}
    forced = turns.count("x")
    near = len(turns) - forced
    # From the nearest length outwards, so that the incumbent is good from the start. Deleting all turns and inserting three
    # reaches every state that can be reached without a system turn, so no length beyond that cost can win.
    longest = near + (DELETE * near + INSERT * 3) // INSERT
    for length in sorted(range(longest + 1), key=lambda k: (abs(k - near), k)):
        for system in (False, True) if state == START and length else (False,):
            goal = target(state, length, system)
            end = goal[-1] if goal else state
            if last and end not in (START, "a"):
                continue
            known = best.get(end)
            gap = abs(length - near) * (INSERT if length > near else DELETE) + DELETE * forced
            limit = known[0] if known else math.inf
            if last and best:  # one contest for all states that may end
                limit = min(limit, *(c for c, _ in best.values()))
            if gap > limit:
                continue
            found = align(turns, goal, limit)
            if found and (known is None or found < known):
                best[end] = found
    return best


# --- conversations -----------------------------------------------------------------

class Path:
    """The cheapest way to a state: cost, audit and the hash of the repaired turns."""

    def __init__(self, cost: int = 0, audit: str = "", digest: hashlib._Hash | None = None, turns: int = 0):
        self.cost, self.audit, self.turns = cost, audit, turns
        self.digest = digest or hashlib.sha256()

    def after(self, state: str, audit: str, cost: int, block: list[tuple[str, str]]) -> Path:
        out = Path(cost, self.audit + audit, self.digest.copy(), self.turns)
        rows = iter(block)
        for edit in audit:
            role, text = next(rows) if edit != "I" else ("", "")
            if edit == "D":
                continue
            if edit != "K":
                state_now = "a" if state == "u" else "u"
                role = NAMES[state_now]
            state = role[:1]
            out.digest.update((("\n" if out.turns else "") + f"{role}:{text}").encode())
            out.turns += 1
        return out


class Conversation:
    """Takes the turns of a conversation in order."""

    def __init__(self):
        self.paths = {START: Path()}
        self.block: list[tuple[str, str]] = []
        self.signs: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            if turn != self.last:
                self.distinct += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.before = initial
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        sign = initial if initial in ("s", "u", "a") else "-"
        if fault == "truncated":
            sign = "=" if sign == "-" else sign.upper()
        self.signs.append("x" if fault in ("blank", "duplicate") else sign)
        self.block.append((role, text))
        if len(self.block) > BLOCK_TURNS:  # one turn stays back, for the end is aligned with what may end alone
            self._advance(BLOCK_TURNS, last=False)

    def _advance(self, n: int, last: bool) -> None:
        turns, block = "".join(self.signs[:n]), self.block[:n]
        best: dict[str, tuple[int, str, str, str]] = {}
        for state, path in self.paths.items():
            for end, (cost, audit) in ways(turns, state, last).items():
                one = (path.cost + cost, path.audit + audit, audit, state)
                if end not in best or one[:2] < best[end][:2]:
                    best[end] = one
        self.paths = {end: self.paths[state].after(state, audit, cost, block) for end, (cost, _, audit, state) in best.items()}
        del self.signs[:n], self.block[:n]

    def result(self) -> tuple[int, int, int, int, int, int, str, str]:
        if self.block:
            self._advance(len(self.block), last=True)
        best = min((p for s, p in self.paths.items() if s in (START, "a")), key=lambda p: (p.cost, p.audit))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost, best.audit, best.digest.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: conversations with one kind of damage in a quarter of the rows, by a checksum of
    ``conv_id:turn``; rows that are dropped stay as marks (``gone``), so that no conversation is lost."""
    def known(name: str) -> Column:
        return F.coalesce(turns[name].cast("string"), F.lit(" "))

    kind = (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20).alias("kind")
    rows = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].cast("long").alias("turn"), known("role").alias("role"),
                        known("text").alias("text"), kind)
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"),
                       F.explode(copies).alias("copy")).drop("copy")


def intact(turns: DataFrame) -> DataFrame:
    """The same columns, nothing damaged."""
    return turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                        *[F.coalesce(turns[c].cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(False).alias("gone"))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (as ``intact`` or ``damaged`` give them): conv_id and ``RESULT``."""
    kind = dict(rows.dtypes)["conv_id"]
    # one shuffle: the window and the stream both want whole conversations
    dealt = rows.repartition("conv_id").withColumn("place", F.row_number().over(
        Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))))
    fault = F.when(F.col("text").rlike(BLANK), "blank").when(F.col("place") > 1, "duplicate").when(
        F.col("text").rlike(CUT_OFF), "truncated").otherwise("")
    ordered = dealt.select("conv_id", "gone", "turn", "role", "text", fault.alias("fault"), "place").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text", "place")
    names = [x.split()[0] for x in RESULT.split(", ")]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        conv, types = None, None

        def made(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done))
            held = [pa.array(columns[0], types), *(pa.array(c, pa.int64()) for c in columns[1:7]),
                    *(pa.array(c, pa.string()) for c in columns[7:])]
            return pa.RecordBatch.from_arrays(held, names=["conv_id", *names])

        for some in batches:
            types, done = some.schema.field("conv_id").type, []
            for c, gone, turn, role, text, what in zip(*(some.column(x).to_pylist() for x in (
                    "conv_id", "gone", "turn", "role", "text", "fault"))):
                if now is None or c != conv:
                    if now is not None:
                        done.append((conv, *now.result()))
                    conv, now = c, Conversation()
                if not gone:
                    now.add(turn, role, text, what)
            if done:
                yield made(done)
        if now is not None:
            yield made([(conv, *now.result())])

    return ordered.mapInArrow(stream, f"conv_id {kind}, {RESULT}")
