"""Nearest vectors against all distances."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from telesift.llm import nearest_vectors as nv
from telesift.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, asks, k):
    """Every query's k nearest by (distance, id), over all pairs."""
    take = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = set()
    for i, v in {(i, tuple(v)) for i, v in take if asks(i)}:
        others = [(j, tuple(w)) for j, w in take if len(w) == len(v)]
        others.remove((i, v))
        x = np.array(v, np.float32).astype(np.float64)
        near = sorted((float(np.sqrt(((np.array(w, np.float32).astype(np.float64) - x) ** 2).sum())), j) for j, w in others)
        out |= {(i, r + 1, j, round(d, 9)) for r, (d, j) in enumerate(near[:k])}
    return out


def search(frame, k=10, every=10):
    return {(a, b, c, round(d, 9)) for a, b, c, d in nv.nearest(frame, F.col("vec_id") % every == 0, k).collect()}


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows], SCHEMA)


def drawn(n, d, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, d))
    return [(i, [float(c) for c in np.float32(centres[i % 12] + r.normal(size=d) * 0.2)]) for i in range(n)]


@pytest.mark.parametrize("cell", [1 << 12, 16 << 20])
def test_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(nv, "CELL_BYTES", cell)
    rows = drawn(700, 24)
    assert search(table(spark, rows)) == brute(rows, lambda i: i % 10 == 0, 10)


def test_copies_ties_and_near_copies(spark):
    r = np.random.default_rng(1)
    one = np.float32(r.normal(size=16))
    rows = [(i, one.tolist()) for i in range(200)]
    rows += [(i, np.float32(one + r.normal(size=16) * 1e-4).tolist()) for i in range(200, 400)]
    rows += [(5, [1.0] * 16)] * 3 + [(10, one.tolist())] * 2 + [(20, [2.0] * 16)]
    frame = table(spark, rows).repartition(5)
    got = [tuple(x) for x in nv.nearest(frame, F.col("vec_id") % 10 == 0, 10).collect()]
    assert {(a, b, c, round(d, 9)) for a, b, c, d in got} == brute(rows, lambda i: i % 10 == 0, 10)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2]), (1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [nan, 1]), (6, [inf, 1]), (None, [1, 2]), (7, [1, 2, 3]), (8, [1e-30, 0]), (9, [3e38, -3e38]), (10, None), (20, [nan, 2])]
    assert search(table(spark, rows)) == brute(rows, lambda i: i % 10 == 0, 10)
    assert search(table(spark, [])) == set()
    assert search(table(spark, [(0, [1.0, 2.0])])) == set()


def test_clashing_names_and_other_kinds(spark):
    rows = [(i, [i % 7, i % 5, 1]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<int>").selectExpr("*", "'x' AS id", "1 AS v", "2 AS c", "3 AS q", "4 AS `key`", "5 AS rank")
    assert search(frame) == brute(rows, lambda i: i % 10 == 0, 10)


def test_bounds_hold_every_distance():
    r = np.random.default_rng(2)
    q, c = nv._Codes(r.normal(size=(30, 2000)) * 10.0 ** r.integers(-9, 9, (30, 1))), nv._Codes(r.normal(size=(50, 2000)))
    least, most = nv.squared_bounds(q, c, slice(0, 30), slice(0, 50))
    exact = ((q.x[:, None] - c.x[None]) ** 2).sum(2)
    assert (least <= exact).all() and (exact <= most).all()


def test_query_against_all_distances(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = QUERIES["op11_nearest_vectors"](spark, folder)
    want = con.execute(ORACLES["op11_nearest_vectors"]).fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) == 50
