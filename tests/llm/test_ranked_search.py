"""Ranked search against scores of all documents."""

import collections
import math
import re

import duckdb
import numpy as np
import pytest

from telesift.llm import ball_tree, ranked_search as rs
from telesift.llm.queries import ORACLES, QUERIES
from tests.llm.cases import AWKWARD, LONG, docs, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items, k=20):
    held = [(i, collections.Counter(terms(t))) for i, t in documents]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    count, length = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = set()
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * count) // length
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            scores.append((-s, i is None, i or 0))
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out |= {(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(best)}
    return out


def search(spark, documents, items, k=20):
    frame = spark.createDataFrame(items, "item_id long, text string")
    return {tuple(r) for r in rs.rank(docs(spark, documents), frame, k).collect()}


ITEMS = [(1, "The river of copper, light light."), (2, ""), (3, None), (4, "nowhere found"), (None, "Stone 7"), (6, "über STRASSE été"), (7, LONG[:4000]), (7, "one word")]


def test_awkward_documents_against_all_scores(spark):
    assert search(spark, AWKWARD, ITEMS) == brute(AWKWARD, ITEMS)
    assert search(spark, [], ITEMS) == set() and search(spark, AWKWARD, []) == set()
    assert search(spark, [(1, None), (2, "...")], ITEMS) == set()


@pytest.mark.parametrize("block, leaf", [(4096, 32), (50, 4)])
def test_many_documents_with_copies(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(rs, "BLOCK", block)
    monkeypatch.setattr(ball_tree, "LEAF", leaf)
    rows = [(i, prose(i, 5 + i % 60)) for i in range(900)] + [(i, prose(3, 40)) for i in range(900, 1500)]
    items = [(i, prose(i * 7, 12)) for i in range(30)] + [(30, prose(3, 40)), (30, prose(3, 40)), (31, "the the the of")]
    assert search(spark, rows, items, 7) == brute(rows, items, 7)


def test_items_in_several_passes_score_alike(spark, monkeypatch):
    rows = [(i, prose(i, 30)) for i in range(200)]
    items = [(i, prose(i, 20)) for i in range(40)]
    whole = search(spark, rows, items)
    monkeypatch.setattr(rs, "ITEM_BYTES", 1500)
    assert search(spark, rows, items) == whole == brute(rows, items)


def test_clashing_names(spark):
    frame = docs(spark, AWKWARD, item_id=5, rank=6, score=7, terms="x", n=1, item=2, part=3)
    items = spark.createDataFrame([(1, "river stone", 3)], "item_id long, text string, doc_id long")
    assert {tuple(r) for r in rs.rank(frame, items).collect()} == brute(AWKWARD, [(1, "river stone")])


def test_balls_bound_and_spare_leaves():
    r = np.random.default_rng(5)
    groups, dims = 40, 400
    rows = []
    for g in range(groups):
        base = r.choice(dims, 10, replace=False)
        rows += [np.sort(np.concatenate([base, r.choice(np.setdiff1d(np.arange(dims), base), 2, replace=False)])) for _ in range(50)]
    first = np.arange(0, 12 * len(rows) + 1, 12)
    given = ball_tree.Sparse(first, np.concatenate(rows), r.integers(1, 10**6, first[-1]))
    weight = r.integers(0, 12_000, dims)
    term = np.concatenate([rows[i * 50][:10] for i in range(groups)])
    q = ball_tree.Queries(np.arange(0, 10 * groups + 1, 10), term, np.ones(len(term), np.int64), weight[term])
    root = ball_tree.grow(given, [(False, i) for i in range(len(rows))], weight, q, 5)
    for leaf in ball_tree.leaves(root):
        start, t, impact, _ = leaf.leaf
        for k in range(groups):
            dense = np.zeros(dims, np.int64)
            dense[q.term[10 * k : 10 * k + 10]] = q.scored[10 * k : 10 * k + 10]
            assert np.add.reduceat(dense[t] * impact, start).max() <= leaf.bounds[k]
    best = [ball_tree.Best(5) for _ in range(groups)]
    opened = ball_tree.search(root, q, best)
    assert opened < groups * sum(1 for _ in ball_tree.leaves(root))


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    got = sorted(tuple(r) for r in QUERIES["op12_ranked_search"](spark, folder).collect())
    want = con.execute(ORACLES["op12_ranked_search"]).fetchall()
    assert got == sorted(want) and len(got) == 40 * 20
