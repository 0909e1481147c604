"""Repair of the turn structure of conversations by a run-length dynamic program.

A row is a symbol: the initial of its role and its fault. Equal consecutive symbols are one
run. Editing a row moves a conversation between four states (nothing yet, after system,
user or assistant), so a symbol is a 4 x 4 matrix of least costs, inserts included; the
costs to go before a run are those behind it, advanced by the cached binary powers of that
matrix under (min, +). From the costs to go the choices are unrolled row by row, always the
first letter that loses nothing, which gives the least audit of the cheapest ones.

Rows of a conversation reach their task twice, sorted: first as symbols of a few bytes, from
which the audit follows, then with their texts, which are hashed as they stream by. Of a
conversation a task holds a letter per row and nine bytes per run, never its texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAR = 1 << 50  # Above any cost, and twice it is still a long.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK = " \t\n\v\f\r"
ROWS_AT_ONCE = RUNS_AT_ONCE = 65_536

# Faults of a row, the first that it has.
SOUND, CUT, DUPLICATE, EMPTY = range(4)

# A symbol is one number: which initial, the last for all others, and which fault.
INITIALS = "suao"


def spoken(state: int) -> int:
    """The state after the turn that may be inserted, or given to a row, in this state."""
    return ASSISTANT if state == USER else USER


def symbol_of(initial: str, fault: int) -> int:
    return INITIALS.index(initial) * 4 + fault


@cache
def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of each edit that uses up a row, in order of letters."""
    initial, fault = INITIALS[symbol // 4], symbol % 4
    found = [("D", DELETE, state)]
    if fault in (SOUND, CUT):
        extra = TRUNCATED if fault == CUT else 0
        kept = SYSTEM if initial == "s" and state == NOTHING else spoken(state)
        if initial == {SYSTEM: "s", USER: "u", ASSISTANT: "a"}[kept]:
            found.append(("K", KEEP + extra, kept))
        found.append(("R", REROLE + extra, spoken(state)))
    return found


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Costs by way of ``a``, then ``b``: the matrix product under (min, +)."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


@cache
def inserts() -> np.ndarray:
    """Costs of any number of inserts."""
    one = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(one, 0)
    for state in range(4):
        one[state, spoken(state)] = INSERT
    return product(product(one, one), product(one, one))


@cache
def power(symbol: int, exponent: int) -> np.ndarray:
    """Least costs over ``2 ** exponent`` rows of one symbol, with inserts before each."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    row = np.full((4, 4), FAR, np.int64)
    for state in range(4):
        for _, cost, after in choices(symbol, state):
            row[state, after] = min(row[state, after], cost)
    return product(inserts(), row)


def before(symbol: int, rows: int, behind: np.ndarray) -> np.ndarray:
    """Costs to go before a run, from those behind it."""
    exponent = 0
    while rows:
        if rows & 1:
            behind = np.minimum((power(symbol, exponent) + behind).min(axis=1), FAR)
        rows >>= 1
        exponent += 1
    return behind


def at_each_row(symbol: int, rows: int, behind: np.ndarray) -> np.ndarray:
    """Costs to go before the last 0, 1, ... ``rows`` rows of a run, doubled by the powers."""
    known = behind[None, :]
    exponent = 0
    while len(known) <= rows:
        further = (power(symbol, exponent)[None, :, :] + known[:, None, :]).min(axis=2)
        known = np.concatenate((known, np.minimum(further, FAR)))
        exponent += 1
    return known[: rows + 1]


def accepted() -> np.ndarray:
    """Costs to go behind the last row: none in a complete conversation, else inserts."""
    ends = np.array([0, FAR, FAR, 0], np.int64)
    return np.minimum((inserts() + ends).min(axis=1), FAR)


def _unroll(codes: Sequence[int], lengths: Sequence[int], behind: list[np.ndarray], state: int, out: list[str]) -> int:
    """Append the least letters of some runs to ``out``; the state that they end in."""
    for symbol, left, to_go in zip(codes, lengths, behind, strict=True):
        while left:
            part = min(left, ROWS_AT_ONCE)
            costs = at_each_row(symbol, part, before(symbol, left - part, to_go)).tolist()
            for row in range(part, 0, -1):
                now, after = costs[row], costs[row - 1]
                while True:
                    here = now[state]
                    (_, delete, _), *others = choices(symbol, state)
                    if delete + after[state] == here:
                        out.append("D")
                        break
                    if INSERT + now[spoken(state)] == here:
                        out.append("I")
                        state = spoken(state)
                        continue
                    letter, _, state = next(x for x in others if x[1] + after[x[2]] == here)
                    out.append(letter)
                    break
            left -= part
    return state


def _solve(codes: Sequence[int], lengths: Sequence[int]) -> tuple[int, str]:
    # Backward over all runs, keeping the costs behind each part of them; then forward, where
    # the costs inside a part are made again.
    to_go, behind_part = accepted(), []
    for i in reversed(range(len(codes))):
        if (i + 1) % RUNS_AT_ONCE == 0 or i + 1 == len(codes):
            behind_part.append(to_go)
        to_go = before(codes[i], lengths[i], to_go)
    state, pieces = NOTHING, []
    for begin in range(0, len(codes), RUNS_AT_ONCE):
        part = slice(begin, begin + RUNS_AT_ONCE)
        behind = [behind_part.pop()]
        for symbol, rows in zip(codes[part][:0:-1], lengths[part][:0:-1], strict=True):
            behind.append(before(symbol, rows, behind[-1]))
        letters: list[str] = []
        state = _unroll(codes[part], lengths[part], behind[::-1], state, letters)
        pieces.append("".join(letters))
    end = accepted()
    while int(end[state]) == INSERT + int(end[spoken(state)]):
        pieces.append("I")
        state = spoken(state)
    return int(to_go[NOTHING]), "".join(pieces)


_remembered = lru_cache(maxsize=1 << 16)(_solve)


def cheapest_edits(codes: Sequence[int], lengths: Sequence[int]) -> tuple[int, str]:
    """Least cost, and the ASCII-least audit of that cost, of runs of equal symbols."""
    if len(codes) <= 64 and sum(lengths) <= 256:
        return _remembered(tuple(codes), tuple(lengths))
    return _solve(codes, lengths)


class _Conversation:
    """What is known of one conversation while its rows stream by."""

    def __init__(self):
        self.codes, self.lengths = array("B"), array("q")
        self.faults = {SOUND: 0, CUT: 0, DUPLICATE: 0, EMPTY: 0}
        self.illegal = 0
        self.turns, self.first, self.last = 0, None, None
        self.mark = None
        self.edits: Iterator[str] | None = None

    def _symbol(self, initial: str, fault: int, rows: int) -> None:
        self.faults[fault] += rows
        self.illegal += rows - 1 if initial * 2 not in LEGAL else 0
        if self.codes:
            self.illegal += INITIALS[self.codes[-1] // 4] + initial not in LEGAL
        symbol = symbol_of(initial, fault)
        if self.codes and self.codes[-1] == symbol:
            self.lengths[-1] += rows
        else:
            self.codes.append(symbol)
            self.lengths.append(rows)

    def row(self, turn: int | None, initial: str, fault: int, copies: int, mark: tuple) -> None:
        """``copies`` equal rows; a row equal to the one before it is a duplicate of it."""
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        again = DUPLICATE if fault != EMPTY else EMPTY
        if mark == self.mark:
            self._symbol(initial, again, copies)
            return
        self.mark = mark
        self._symbol(initial, fault, 1)
        if copies > 1:
            self._symbol(initial, again, copies - 1)

    def solve(self) -> None:
        if self.edits is None:
            self.cost, self.audit = cheapest_edits(self.codes, self.lengths)
            self.edits = iter(self.audit)
            self.state, self.hash, self.turns_out = NOTHING, hashlib.sha256(), 0

    def _say(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.turns_out else "") + f"{role}:{text}").encode())
        self.turns_out += 1

    def text(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            for letter in self.edits:
                if letter == "I":
                    self.state = spoken(self.state)
                    self._say(NAMES[self.state], "")
                    continue
                if letter == "R":
                    self.state = spoken(self.state)
                    self._say(NAMES[self.state], text)
                elif letter == "K":
                    self.state = SYSTEM if self.state == NOTHING and role[:1] == "s" else spoken(self.state)
                    self._say(role, text)
                break

    def result(self) -> tuple:
        self.solve()
        for _ in self.edits:
            self.state = spoken(self.state)
            self._say(NAMES[self.state], "")
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        blank, duplicate, cut = (self.faults[x] for x in (EMPTY, DUPLICATE, CUT))
        return gaps, blank, duplicate, cut, self.illegal, self.cost, self.audit, self.hash.hexdigest()


REPAIRED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
KINDS = [pa.int64()] * 7 + [pa.string()] * 2
NAMES_OUT = [x.split()[0] for x in REPAIRED.split(", ")]
ABSENT, AS_SYMBOL, AS_TEXT = range(3)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns), strict=True) for batch in batches)
    out: list[tuple] = []
    for conv_id, own in groupby(rows, key=lambda row: row[0]):
        talk = _Conversation()
        for _, kind, turn, mark, initial, fault, copies, role, text in own:
            if kind == AS_SYMBOL:
                talk.row(turn, initial, fault, copies, (turn, mark))
            elif kind == AS_TEXT:
                talk.solve()
                talk.text(role, text, copies)
        out.append((conv_id, *talk.result()))
        if len(out) >= 1000 or len(out[-1][7]) > 1 << 20:
            yield _batch(out)
            out = []
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in KINDS]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, KINDS, strict=True)], names=NAMES_OUT)


def _last_mark(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(BLANK)), F.lit(1))


def repair_turns(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per ``conv_id`` with its faults and the cheapest repair of its turns.

    ``rows`` has ``conv_id, turn, role, text``; a null role or text is one space, a null turn
    stands first. ``copies`` names a column with how often a row occurs next to itself, 0
    for a row that is not there but whose conversation is. Rows of one turn stand in the order
    of a digest of role and text; equal rows are one original and its duplicates. Null ids are
    a conversation. Other columns are not looked at; an empty table gives an empty result.

    Faults, the first of a row: blank, duplicate (same role and text before), truncated (the
    last character that is no blank is not one of ``.!?``). ``illegal`` counts neighbours whose
    role initials are not su, ua or au. An edit keeps a row (0), gives it the role user or
    assistant (1), deletes it (2, the only one for blank and duplicate rows) or inserts an
    empty turn (5); a truncated row that stays costs 5 more. ``audit`` has the initials of the
    cheapest edits that leave ``(s?(ua)+)?``, the least of equals.

    The first turn of each role and text is found by an aggregate that combines before its
    shuffle, so a phrase that a conversation repeats forever loads no task. A conversation goes
    to one task, as its SHA-256 can only be taken in order; that task keeps no texts.
    """
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    times = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    base = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        times.alias("copies"),
    ).withColumn("mark", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    there = base.where("copies > 0")
    last = _last_mark(F.col("text"))
    fault = F.when(last == "", EMPTY).when(last.isin(".", "!", "?"), SOUND).otherwise(CUT)
    initial = F.left("role", F.lit(1))
    symbols = there.select(
        "conv_id", "turn", "mark", "copies", fault.alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
    )
    first = (
        there.groupBy("conv_id", "mark")
        .agg(F.min(order).alias("first"))
        .select(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("mark") == F.col("_mark"))
    later = (F.col("fault") != EMPTY) & (order > F.col("first"))
    symbols = symbols.join(first, same).withColumn("fault", F.when(later, DUPLICATE).otherwise(F.col("fault")))
    nothing = F.lit(None).cast("string")
    shown = symbols.select(
        "conv_id", F.lit(AS_SYMBOL).alias("kind"), "turn", "mark", "initial", "fault", "copies",
        nothing.alias("role"), nothing.alias("text"),
    )
    # Rows that are not there only name their conversation.
    texts = base.select(
        "conv_id", F.when(F.col("copies") > 0, AS_TEXT).otherwise(ABSENT).alias("kind"), "turn", "mark",
        nothing.alias("initial"), F.lit(SOUND).alias("fault"), "copies", "role",
        F.when(F.col("copies") > 0, F.col("text")).alias("text"),
    )
    streamed = shown.unionByName(texts).repartition("conv_id")
    return streamed.sortWithinPartitions("conv_id", "kind", "turn", "mark").mapInArrow(_repair, REPAIRED)


def damage_turns(rows: DataFrame) -> DataFrame:
    """``rows`` with faults picked by CRC-32 of ``conv_id:turn`` modulo 20, and ``copies``.

    0 drops the row (no copy), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 gives it
    the role user. Nulls are one space.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(pick == 1, "").when(pick == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(pick == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"),
        F.when(pick == 0, 0).when(pick == 3, 2).otherwise(1).alias("copies"),
    )
