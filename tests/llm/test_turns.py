"""Repair of conversations against a search over all edits."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import turn_repair
from tillwright.llm.queries import QUERIES
from tillwright.llm.turn_repair import CUT, DUPLICATE, EMPTY, SOUND, cheapest_edits, damage_turns, repair_turns, symbol_of

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
WORD = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\v\f\r"


def search(rows):
    """Cheapest cost and least audit with the turns said, over every edit of every row.

    ``rows`` are (role, text, fault); states are the last initial said. From the last row back,
    so that whole endings are compared.
    """
    ends = {"": (0, "", ()), "s": (10, "II", ("user:", "assistant:")), "u": (5, "I", ("assistant:",)), "a": (0, "", ())}
    for role, text, fault in reversed(rows):
        found = {}
        for state in ends:
            options = [(2 + ends[state][0], "D" + ends[state][1], ends[state][2])]
            if fault in (SOUND, CUT):
                extra = 5 if fault == CUT else 0
                for to in NEXT[state]:
                    cost, audit, said = ends[to]
                    if role[:1] == to:
                        options.append((extra + cost, "K" + audit, (f"{role}:{text}", *said)))
                    if to in WORD:
                        options.append((extra + 1 + cost, "R" + audit, (f"{WORD[to]}:{text}", *said)))
            found[state] = min(options)
        for _ in range(4):
            for state in found:
                to = NEXT[state][-1]
                cost, audit, said = found[to]
                found[state] = min(found[state], (cost + 5, "I" + audit, (f"{WORD[to]}:", *said)))
        ends = found
    return ends[""]


def brute(rows):
    """The expected row of each conversation from (conv_id, turn, role, text) after damage."""
    talks = {}
    for conv, turn, role, text, copies in rows:
        talks.setdefault(conv, []).extend([(turn, role, " " if text is None else text)] * copies)
    out = {}
    for conv, talk in talks.items():
        digest = lambda x: hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).hexdigest()
        talk.sort(key=lambda x: (x[0] is not None, x[0] or 0, digest(x)))
        seen, judged = set(), []
        for _, role, text in talk:
            mark = text.rstrip(BLANKS)[-1:]
            fault = EMPTY if not mark else DUPLICATE if (role, text) in seen else SOUND if mark in ".!?" else CUT
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, said = search(judged) if judged else (0, "", ())
        turns = [t for t, _, _ in talk if t is not None]
        faults = [x[2] for x in judged]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count(EMPTY), faults.count(DUPLICATE), faults.count(CUT),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


def found(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in df.collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suao"), st.integers(0, 3), st.integers(1, 4)), max_size=8))
def test_runs_equal_a_search_row_by_row(runs):
    rows = [(i + "x", "t", fault) for i, fault, n in runs for _ in range(n)]
    cost, audit, _ = search(rows)
    codes = bytes(symbol_of(i, fault) for i, fault, _ in runs)
    assert cheapest_edits(codes, [n for *_, n in runs]) == (cost, audit)


def test_parts_of_runs_and_rows_give_what_the_whole_gives(monkeypatch):
    rng = random.Random(5)
    runs = [(rng.choice("suao"), rng.randrange(4), rng.choice([1, 2, 60])) for _ in range(90)]
    codes, lengths = bytes(symbol_of(i, f) for i, f, _ in runs), [n for *_, n in runs]
    monkeypatch.setattr(turn_repair, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(turn_repair, "RUNS_AT_ONCE", 4)
    cost, audit, _ = search([(i, "t", f) for i, f, n in runs for _ in range(n)])
    assert cheapest_edits(codes, lengths) == (cost, audit)


def test_a_long_run_costs_what_it_should():
    cost, audit = cheapest_edits(bytes([symbol_of("u", SOUND)]), [1_000_001])
    # Every second user turn becomes the assistant's, and one goes or gets an answer.
    assert (cost, len(audit)) == (500_002, 1_000_001)
    assert audit.count("R") == 500_000 and audit.count("D") == 1


SCHEMA = "conv_id long, turn long, role string, text string, copies int, kind string, mark int"


def test_repair_equals_brute_force(spark):
    rng = random.Random(3)
    texts = ["Yes.", "no", "", " \n", "Ja!", "ça", None, "a.b", "x" * 5000 + "?", " ", ". \t"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "aside"]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts), rng.choice([1, 1, 2, 0]), "k", 1)
        for _ in range(400)
    ]
    rows += rows[:20]
    # A role that is empty stays so; only null is a space.
    given_rows = [(c, t, " " if r is None else r, x, n) for c, t, r, x, n, *_ in rows]
    expected = {}
    for conv in {r[0] for r in given_rows}:
        expected |= _brute_conv(conv, [r for r in given_rows if r[0] == conv])
    assert found(repair_turns(spark.createDataFrame(rows, SCHEMA), copies="copies")) == expected


def _brute_conv(conv, rows):
    return brute([(conv, t, r, x, n) for _, t, r, x, n in rows]) if rows else {}


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, r, x) for c in (None, 1, 25, 907) for t in (None, 0, 1, 2, 3, 4, 5, 44) for r in ("assistant", None) for x in ("a.b!", None)]
    expected = []
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        pick = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: text.translate({ord(x): None for x in ".!?"})}.get(pick, text)
        expected.append((conv, turn, "user" if pick == 4 else role, text, {0: 0, 3: 2}.get(pick, 1)))
    damaged = damage_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, damaged.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("rows, expected", [([], {}), ([(7, 1, "user", "Hi.", 0, "", 0)], {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())})])
def test_nothing_left(spark, rows, expected):
    assert found(repair_turns(spark.createDataFrame(rows, SCHEMA), copies="copies")) == expected


def test_a_conversation_with_most_rows(spark):
    rows = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, id, -1) AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
        "IF(id % 5 = 0, 'ok', concat(id, '.')) AS text",
    )
    hot = found(repair_turns(rows.where("conv_id = -1")))[-1]
    assert hot[:4] == (59_999 - 40_000, 0, 7_998, 2) and hot == found(repair_turns(rows))[-1]


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = damage_turns(spark.read.parquet(f"{folder}/conversations.parquet")).collect()
    assert found(QUERIES["op13_turn_repair"](spark, folder)) == brute([tuple(r) for r in rows])
