"""Packing: every piece has one place, and few sequences are used."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from telesift.llm import packing, quality_classifier, token_ids
from telesift.llm.queries import QUERIES
from telesift.llm.token_ids import vocabulary_path
from tests.llm.cases import AWKWARD, docs, prose


def check_places(length, sequence, offset, capacity):
    order = np.lexsort((offset, sequence))
    length, sequence, offset = length[order], sequence[order], offset[order]
    first = np.append(True, sequence[1:] != sequence[:-1]) if len(length) else np.zeros(0, bool)
    assert (offset[first] == 0).all()
    assert ((offset[1:] == (offset + length)[:-1]) | first[1:]).all()
    assert (offset + length <= capacity).all()
    return int(first.sum())


def planned(lengths, capacity, rounds=40):
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.plan(counts, capacity, rounds)
    length = np.repeat(np.arange(capacity + 1), counts)
    number = np.concatenate([np.arange(n) for n in counts]).astype(np.int64)
    used = check_places(length, *plan.place(length, number), capacity) if len(length) else 0
    assert used == plan.sequences
    return used


def first_fit(lengths, capacity):
    """Sequences that first fit in decreasing length takes."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        k = next((i for i, room in enumerate(rooms) if room >= x), None)
        if k is None:
            rooms.append(capacity - x)
        else:
            rooms[k] -= x
    return len(rooms)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200))
def test_plans_place_all_pieces_as_well_as_first_fit(lengths):
    used = planned(np.array(lengths, int), 40)
    assert used >= -(-sum(lengths) // 40)
    assert used <= first_fit(lengths, 40) + 1


def brute_force(items, capacity):
    items = sorted(items, reverse=True)

    def fits(rooms, k):
        if k == len(items):
            return True
        tried = set()
        for i, room in enumerate(rooms):
            if room >= items[k] and room not in tried:
                tried.add(room)
                rooms[i] -= items[k]
                if fits(rooms, k + 1):
                    rooms[i] += items[k]
                    return True
                rooms[i] += items[k]
        return False

    n = -(-sum(items) // capacity)
    while not fits([capacity] * n, 0):
        n += 1
    return n


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(3, 20), min_size=1, max_size=9))
def test_plans_are_near_the_best(lengths):
    assert planned(np.array(lengths), 20) <= brute_force(lengths, 20) + 1


def test_pricing_is_a_knapsack():
    rng = np.random.default_rng(3)
    values = np.where(rng.random(31) < 0.4, rng.random(31), 0.0)
    values[0] = 0
    best = [0.0] * 31
    for room in range(1, 31):
        best[room] = max([best[room - 1]] + [best[room - k] + values[k] for k in range(1, room + 1) if values[k]])
    chosen = packing.price(values, 30)
    assert chosen.sum() <= 30 and values[chosen].sum() == pytest.approx(best[30])


def test_work_does_not_grow_with_the_counts():
    counts = np.zeros(101, np.int64)
    counts[[7, 31, 52, 100]] = [10**12, 10**11, 10**10, 10**9]
    plan = packing.plan(counts, 100, 30)
    # Whatever stands beside them, sevens fill at most 98 of what is left.
    rest = counts[31] * 31 + counts[52] * 52
    assert len(plan.length) < 500 and plan.sequences < 1.01 * (counts[100] + (counts[7] * 7 + rest) / 98)


def test_awkward_documents(spark):
    frame = docs(spark, length=9, sequence_id="mine")
    pieces = packing.token_pieces(frame, 1, capacity=64)
    rows = packing.pack(pieces, 64, 40).collect()
    check_places(*(np.array([r[c] for r in rows]) for c in ("length", "sequence_id", "offset")), 64)
    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = []
    for key, text in AWKWARD:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(key, k // 64, k, len(ids[k : k + 64]), zlib.crc32(np.array(ids[k : k + 64], "<u4").tobytes())) for k in range(0, len(ids), 64)]
    key = lambda row: tuple(-1 if x is None else x for x in row)
    assert sorted((tuple(r[c] for c in packing.PIECES.names) for r in rows), key=key) == sorted(want, key=key)


def test_extra_columns_and_empty_tables(spark):
    frame = spark.createDataFrame([(5, "a"), (60, "b"), (5, "c")], "length int, `odd name` string").selectExpr("*", "7 AS OFFSET")
    rows = packing.pack(frame, 64, 10).collect()
    assert sorted(r["odd name"] for r in rows) == ["a", "b", "c"] and set(rows[0].asDict()) == {"length", "odd name", "sequence_id", "offset"}
    assert packing.pack(packing.token_pieces(docs(spark, []), 1)).count() == 0


def test_a_hot_length(spark):
    frame = docs(spark, [(i, "") for i in range(5000)] + [(i, prose(i, 90)) for i in range(60)])
    rows = packing.pack(packing.token_pieces(frame, 1, capacity=512), 512, 20).toPandas()
    used = check_places(rows.length.values, rows.sequence_id.values, rows.offset.values, 512)
    assert used == max(-(-rows.length.sum() // 512), first_fit(rows.length.tolist(), 512))


def test_query_is_close_to_the_bound(spark):
    rows = QUERIES["op8_packing"](spark, "/root/testdata/sf0.001").toPandas()
    used = check_places(rows.length.values, rows.sequence_id.values, rows.offset.values, 4096)
    assert used <= 1 + -(-rows.length.sum() // 4096)


def test_configurations_cover_every_length():
    """However many lengths there are: no fixed number of rounds ends the program before."""
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(rng.lognormal(4, 0.8, 20_000).astype(int) + 1, 500), minlength=513)
    covered = np.zeros(513)
    for lengths, amount in packing.fractional(counts, 512, 20)[0]:
        assert lengths.sum() <= 512 and (np.bincount(lengths, minlength=513) <= counts).all()
        np.add.at(covered, lengths, amount)
    assert (covered >= counts * (1 - 1e-6)).all() and (counts > 0).sum() > 300
    plan = packing.plan(counts, 512, 20)
    assert plan.sequences <= 1.01 * (counts * np.arange(513)).sum() / 512


@pytest.mark.parametrize("shape", ["halves", "lognormal", "few", "short", "long"])
def test_never_more_sequences_than_best_fit_and_no_fewer_than_the_bound(shape):
    r = np.random.default_rng(3)
    capacity = 512
    lengths = {
        "halves": lambda: r.integers(160, 350, 20_000), "lognormal": lambda: r.lognormal(4, 1, 20_000).astype(int), "few": lambda: r.choice([100, 171, 256, 300], 3000),
        "short": lambda: r.integers(1, 30, 5000), "long": lambda: r.integers(300, 513, 2000),
    }[shape]()
    counts = np.bincount(np.clip(lengths, 1, capacity), minlength=capacity + 1)
    made, alone = packing.plan(counts, capacity, 60), packing._rounded(counts, capacity, [])
    assert made.least <= made.sequences <= alone.sequences
    assert made.sequences <= made.least * 1.1 + 1


def test_tasks_have_one_python_worker_at_a_time(spark, monkeypatch):
    """What feeds a Python step is read from files: two workers in a task would hold their memory side by side."""
    kind, fed = type(spark.range(1)), []
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **k: fed.append(self._jdf.queryExecution().analyzed().toString()) or real(self, *a, **k))
    assert packing.pack(packing.token_pieces(docs(spark), 1)).count() >= len(AWKWARD)
    assert len(fed) == 3 and not any("MapInArrow" in plan for plan in fed)


def test_a_worker_forgets_words_when_it_goes_on_to_quality():
    """Python workers serve one stage after another: what packing kept is not held beside the features."""
    token_ids.encoder(vocabulary_path()).encode(pa.array(["some words to keep"]), 1)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a text"])], names=["doc_id", "__text"])
    assert len(list(quality_classifier._featured(["doc_id"])(iter([batch])))) == 1
    assert token_ids.encoder.cache_info().currsize == 0
