"""Conversation repair against a search from the end of each conversation."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telesift.llm import conversation_repair as cr
from telesift.llm import derivation as dv
from telesift.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
VISIBLE = re.compile("[^\x20\x09-\x0d]")


def cheapest(rows):
    """(cost, audit) of [(initial, must go, truncated)], worked out backwards; the state is the letters so far that matter."""

    @functools.cache
    def best(i, state, inserted):
        options = []
        if i == len(rows):
            if state in "^a":
                options.append((0, ""))
        else:
            initial, must_go, truncated = rows[i]
            options.append(step(2, "D", best(i + 1, state, 0)))
            if not must_go:
                extra = 5 * truncated
                if initial and {"^": "su", "s": "u", "u": "a", "a": "u"}[state].find(initial) >= 0:
                    options.append(step(extra, "K", best(i + 1, initial, 0)))
                options.append(step(1 + extra, "R", best(i + 1, "a" if state == "u" else "u", 0)))
        if inserted < 2:
            options.append(step(5, "I", best(i, "a" if state == "u" else "u", inserted + 1)))
        return min((o for o in options if o), default=None)

    def step(cost, letter, rest):
        return rest and (cost + rest[0], letter + rest[1])

    # From the end, so that no call goes deep.
    for i in reversed(range(len(rows) + 1)):
        for state in "^sua":
            best(i, state, 0)
    return best(0, "^", 0)


def expected(table, damaged=True):
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:256]))
        seen, faults = set(), []
        for _, role, text in rows:
            shown = VISIBLE.findall(text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit = cheapest(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)))
        lines, i, last = [], 0, "a"
        for edit in audit:
            if edit == "K":
                last = rows[i][1][0]
                lines.append(f"{rows[i][1]}:{rows[i][2]}")
            elif edit in "RI":
                last = "a" if last == "u" else "u"
                lines.append(("assistant:" if last == "a" else "user:") + (rows[i][2] if edit == "R" else ""))
            i += edit != "I"
        turns = {r[0] for r in rows if r[0] is not None}
        first = [r[1][:1] for r in rows]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(frame, damaged=True):
    frame = cr.damage(frame) if damaged else frame
    made = cr.repair(frame, gone=F.col("gone") if damaged else None).conversations
    rows = made.select("conv_id", *cr.COUNTS, "audit", "sha256").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def drawn(seed, convs, turns, roles=("user", "assistant", "system", "tool", ""), texts=12):
    r = random.Random(seed)
    words = [f"w{i}" + r.choice([".", "!", "", " ", "? \n"]) for i in range(texts)] + ["", " \t", "é"]
    return [(c, t, r.choice(roles), r.choice(words)) for c in range(convs) for t in range(r.randrange(turns))]


def test_drawn_conversations(spark):
    table = drawn(1, 300, 12) + [(900 + c, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for c in range(50) for t in range(8)]
    frame = spark.createDataFrame(table, SCHEMA).repartition(7)
    assert got(frame) == expected(table)
    assert got(frame, False) == expected(table, False)


@pytest.mark.parametrize("rows, size, fan", [(3, 1 << 16, 1), (5, 40, 6), (256, 1 << 16, 6)])
def test_conversations_of_many_parts(spark, monkeypatch, rows, size, fan):
    # Settings of the driver, and below those of the functions that run in worker processes.
    monkeypatch.setattr(cr, "FAN_BITS", fan)
    table = drawn(2, 3, 120) + [(7, t, r, x) for _, t, r, x in drawn(3, 1, 900, texts=300)] + drawn(4, 40, 6)
    frame = spark.createDataFrame(table, SCHEMA)
    cut, joined = cr._cut, cr._joined

    def small(batches):
        cr.PART_ROWS, cr.PART_BYTES = rows, size
        return cut(batches)

    def few(node):
        cr.FAN_BITS = fan
        return joined(node)

    monkeypatch.setattr(cr, "_cut", small)
    monkeypatch.setattr(cr, "_joined", few)
    assert got(frame) == expected(table)


def test_awkward_rows(spark):
    long = "word " * 40_000 + "."
    table = [
        (None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "x."), (1, None, "user", "x."), (1, None, "assistant", "y."),
        (2, 5, "user", None), (3, 0, None, "z."), (4, 1, "user", long), (4, 2, "assistant", long + "!"), (4, 3, "assistant", long), (4, 9, "user", "q"),
        (5, -4, "system", "s."), (6, 10**12, "system", "s."), (6, 1, "user", "u."),
    ]
    frame = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 AS gone", "'x' AS c", "2 AS part", "3 AS seq", "'y' AS audit", "4 AS __fault")
    assert got(frame) == expected(table)
    assert got(spark.createDataFrame(table, SCHEMA), False) == expected(table, False)
    assert got(spark.createDataFrame([], SCHEMA)) == {}


def test_a_conversation_that_holds_most_rows(spark):
    table = [(1, t, "user" if t % 2 else "assistant", f"text {t % 700}.") for t in range(3000)] + [(1, 5, "user", "same.")] * 500 + drawn(5, 200, 5)
    frame = spark.createDataFrame(table, SCHEMA).repartition(6)
    made = got(frame)
    assert made == expected(table)


def test_repaired_turns(spark):
    table = drawn(8, 60, 9)
    repaired = cr.repair(spark.createDataFrame(table, SCHEMA))
    rows = sorted(repaired.turns.collect(), key=lambda r: (r["conv_id"], r["part"], r["place"]))
    digests = {r["conv_id"]: r["sha256"] for r in repaired.conversations.collect()}
    for conv, turns in itertools.groupby(rows, key=lambda r: r["conv_id"]):
        turns = list(turns)
        assert re.fullmatch("s?(ua)+", "".join(t["role"][0] for t in turns))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest() == digests[conv]


ROWS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans()), max_size=9)


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_lightest_derivation(rows):
    assert dv.repair([dv.Row(*r) for r in rows]) == cheapest(tuple(rows))


@settings(max_examples=400, deadline=None)
@given(st.lists(ROWS, min_size=1, max_size=5))
def test_parts_joined_give_the_whole(parts):
    parts = [[dv.Row(*r) for r in rows] for rows in parts]
    through = [[dv.through(rows, p) for p in range(dv.STATES)] for rows in parts]
    ways = dv.joined([[dv.ranked(w) for w in t] for t in through], dv.BEGIN)
    q, cost, closing = dv.closed(dv.ranked(ways))
    states = ways[q][2]
    audit = "".join(t[a][b][1] for t, a, b in zip(through, states, states[1:])) + closing
    assert (cost, audit) == dv.repair([r for rows in parts for r in rows])


def test_agenda_finalises_in_order_of_weight():
    popped = list(dv.lightest([((0, ""), (0, dv.BEGIN))], dv.edits([dv.Row("u", False, True), dv.Row("a", True, False)], True)).values())
    assert popped == sorted(popped)


def test_query_against_expected(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op13_conversation_repair"](spark, folder).collect()
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r["conv_id"]: tuple(r[c] for c in (*cr.COUNTS, "audit", "repaired_sha256")) for r in rows} == expected(table)
