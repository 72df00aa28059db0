"""Quality and toxicity: held-out accuracy on the given tables, exact neighbours, defined results."""

import bisect
import math
import pickle
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telesift.llm import gam, nearest, quality_classifier, toxicity
from telesift.llm.queries import QUERIES
from tests.llm.cases import AWKWARD, docs, prose

SF = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    got = QUERIES[query](spark, SF).toPandas()
    assert got.score.between(0, 1).all() and len(got) == 10_000
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().drop_duplicates("doc_id")
    both = got.merge(labels, on="doc_id")
    both = both[both.held_out]
    return both.score.to_numpy(), both.predicted.to_numpy(), both[label].to_numpy()


def test_quality_on_held_out_rows(spark):
    score, predicted, label = held_out(spark, "op6_quality_classifier", "quality")
    assert (predicted == (score >= 0.3)).all()
    assert (predicted == label).mean() > 0.98 and predicted[label == 1].mean() > 0.995
    assert np.mean((score - label) ** 2) < 0.02


def test_toxicity_on_held_out_rows(spark):
    score, predicted, label = held_out(spark, "op3_toxicity", "toxic")
    assert (predicted == (score >= 0.5)).all()
    assert predicted[label == 1].mean() > 0.85 and predicted[label == 0].mean() < 0.03
    assert np.mean((score - label) ** 2) < 0.03


LABELS = [(4, 1, 0), (8, 0, 1), (8, 1, 0), (9, None, None), (99, 0, 1), (None, 0, 1), (12, 0, 1)]


@pytest.mark.parametrize("operator", [quality_classifier.classify, toxicity.score])
def test_awkward_rows(spark, operator):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    frame = docs(spark, score="mine", key=7, label=0, text_="x")
    rows = operator(frame, labels, carry=("key", "score", "label")).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 and r["key"] == 7 for r in rows)
    bare = [r["score"] for r in rows if r["doc_id"] in (1, 2, 3)]
    assert len(set(bare)) == 1
    assert operator(docs(spark, []), labels).count() == 0
    no_labels = operator(docs(spark), labels.filter("false")).collect()
    assert {r["score"] for r in no_labels} == {0.5}


def test_drop_rejected_keeps_columns_and_rows_one_by_one(spark):
    rows = [(i, prose(i, 80)) for i in range(150)] + [(i, "### ".join(f"w{k}" for k in range(60))) for i in range(150, 200)]
    frame = docs(spark, rows + rows[:3], score=1, lang="en")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 200, 2)], "doc_id long, quality int")
    kept = quality_classifier.drop_rejected(frame, labels)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([*range(150), 0, 1, 2])


def test_model_learns_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95


def test_model_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(800, 4)).round(1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    model = gam.fit(x, y)
    for row in x[:20]:
        total = model.intercept
        for k, table in enumerate(model.tables):
            total += table[sum(row[k] >= e for e in model.edges[k])]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(row[a] >= e for e in model.pair_edges[a]), sum(row[b] >= e for e in model.pair_edges[b])]
        assert model.margin(row[None])[0] == pytest.approx(total)


def test_features_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = [t for _, t in AWKWARD if t is None or len(t) < 20_000]
    whole = quality_classifier.features(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert quality_classifier.features(pa.array([text], pa.string()))[0].tolist() == pytest.approx(whole[i].tolist())


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 30))
def test_nearest_equals_brute_force(seed, rows, k):
    rng = np.random.default_rng(seed)
    dense = np.where(rng.random((rows, 12)) < 0.3, rng.integers(1, 3, (rows, 12)), 0).astype(float)
    dense[dense.sum(1) == 0, 0] = 1
    dense /= np.sqrt((dense**2).sum(1))[:, None]
    row, term = np.nonzero(dense)
    index = nearest.Index(row, term, dense[row, term], rows, 12)
    query = np.where(rng.random(12) < 0.4, rng.random(12), 0)
    query[0] += 0.1
    query /= np.sqrt((query**2).sum())
    terms = np.flatnonzero(query)
    got, cosines = index.nearest(terms, query[terms], k)
    full = (dense @ query).round(9)
    want = [i for i in np.lexsort((np.arange(rows), -full)) if full[i] > 0][:k]
    assert got.tolist() == want and cosines == pytest.approx(full[want])


def test_isotonic_is_monotone():
    rng = np.random.default_rng(2)
    x = rng.random(500).round(2)
    knots, values = nearest.isotonic(x, (rng.random(500) < x).astype(float))
    assert (np.diff(knots) > 0).all() and values[0] < 0.2 and values[-1] > 0.8


def test_toxicity_compares_whole_texts(spark):
    """An exact copy of an example is like it, whatever its words say of the label; words of no example count in the norm."""
    rows = [(i, prose(i, 40)) for i in range(60)] + [(100, prose(7, 40)), (101, prose(7, 40) + " unheard unseen unsaid")]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs(spark, rows), labels).collect()}
    assert got[100]["neighbours"][0] == 7 and got[100]["cosines"][0] == pytest.approx(1)
    assert got[101]["neighbours"][0] == 7 and 0.5 < got[101]["cosines"][0] < 0.9999


def test_likely_smallest_holds_the_smallest_hashes(spark):
    from telesift.llm.quality_classifier import likely_smallest

    rows = spark.range(40_000).withColumnRenamed("id", "key")
    some = likely_smallest(rows, "key", 3000)
    assert 3000 <= some.count() < 5000
    first = lambda df: [r[0] for r in df.orderBy(F.xxhash64("key"), "key").limit(3000).collect()]
    assert first(some) == first(rows) and likely_smallest(rows, "key", 50_000).count() == 40_000


def plain_score(model, x):
    """The additive model read entry by entry."""
    out = []
    for row in x:
        total = model.intercept
        for j, table in enumerate(model.tables):
            total += table[bisect.bisect_right(model.edges[j].tolist(), row[j])]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[bisect.bisect_right(model.pair_edges[a].tolist(), row[a])][bisect.bisect_right(model.pair_edges[b].tolist(), row[b])]
        out.append(1 / (1 + math.exp(-total)))
    return out


def test_scores_are_sums_of_table_entries():
    r = np.random.default_rng(4)
    x = r.normal(size=(400, 3))
    y = ((x[:, 0] + x[:, 1] * x[:, 2]) > 0).astype(float)
    model = gam.fit(x, y)
    assert model.pairs and np.allclose(model.score(x), plain_score(model, x), atol=1e-12)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.85


def test_quality_query_against_plain_scoring(spark):
    """Every score of the query from the model learned anew on the driver, and the tables read entry by entry."""
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: (r["score"], r["predicted"], r["held_out"]) for r in QUERIES["op6_quality_classifier"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    labels = {}
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["quality"] is not None:
            labels[r["doc_id"]] = max(r["quality"], labels.get(r["doc_id"], 0))
    features = {r["doc_id"]: quality_classifier.features(pa.array([r["text"]], pa.string()))[0] for r in rows}
    hashes = {r["id"]: r["h"] for r in spark.createDataFrame([(i,) for i in labels], "id long").select("id", F.xxhash64("id").alias("h")).collect()}
    taught = sorted((i for i in labels if i in features), key=lambda i: (hashes[i], i))
    model = gam.fit(np.array([features[i] for i in taught]), np.array([labels[i] for i in taught], float))
    want = dict(zip(features, plain_score(model, features.values())))
    assert got.keys() == want.keys()
    for i, (score, predicted, out) in got.items():
        assert score == pytest.approx(want[i], abs=1e-9) and predicted == (score >= 0.3) and out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_an_index_is_built_without_second_copies(monkeypatch):
    """A worker holds its examples' entries once, as counts, and their postings: no arrays of doubles over all entries."""
    monkeypatch.setattr(nearest, "TABLE", 1 << 16)
    monkeypatch.setattr(nearest, "STEP", 1 << 12)
    rng, rows, terms, own = np.random.default_rng(3), 2000, 5000, 200
    term = np.sort(np.array([rng.choice(terms, own, replace=False) for _ in range(rows)], np.int32), axis=1).ravel()
    count, first = rng.integers(1, 9, rows * own).astype(np.uint8), np.arange(rows + 1) * own
    model = toxicity.Model(np.arange(rows), (np.arange(rows) % 5 == 0).astype(float), first, term, count, rng.random(terms).astype(np.float32), 0.3)
    weights = model.units(first, term, count, np.zeros(rows))
    model = pickle.loads(pickle.dumps(model))
    tracemalloc.start()
    index = model.index
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 25 * rows * own
    plain = nearest.Index(np.repeat(np.arange(rows), own), term, weights, rows, terms)
    some = np.arange(0, rows, 90)
    cut = (some[:, None] * own + np.arange(own)).ravel()
    want = plain.nearest_of(np.arange(len(some) + 1) * own, term[cut], weights[cut], 10, some)
    got = index.nearest_of(*index.entries(some), 10, some)
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(got, want))
