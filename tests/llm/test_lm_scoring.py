"""Context-tree weighting against a plain recursion, and the query against counts in plain Python."""

import collections
import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telesift.llm import context_tree as tree
from telesift.llm import lm_scoring
from telesift.llm.queries import QUERIES
from tests.llm.cases import AWKWARD, docs, prose


def model_of(texts, depth):
    key, _ = lm_scoring._runs(pa.array(texts, pa.string()), depth)
    return tree.build(*np.unique(key, return_counts=True), depth)


def scores(model, texts):
    key, row = lm_scoring._runs(pa.array(texts, pa.string()), model.depth)
    value, missing = model.table().look_up(key)
    value = value.astype(float)
    value[missing] = model.unseen(key[missing])
    return np.bincount(row, value, len(texts))


class Plain:
    """The definition, one bit at a time."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, collections.defaultdict(lambda: [0, 0])
        for context, path, bit in (x for t in texts for x in self.decisions(t)):
            for d in range(depth + 1):
                self.counts[context[depth - d :], path][bit] += 1
        self.children = collections.defaultdict(set)
        for context, path in list(self.counts):
            if context:
                self.children[context[1:], path].add(context)
        self.weighted = lru_cache(None)(self._weighted)

    def decisions(self, text):
        data = b"\n" * self.depth + b" ".join((text or "").encode().lower().split()) + b"\n"
        for i in range(self.depth, len(data)):
            for j in range(8):
                yield data[i - self.depth : i], (1 << j) | (data[i] >> (8 - j)), data[i] >> (7 - j) & 1

    def alone(self, context, path):
        a, b = self.counts[context, path]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def below(self, context, path):
        return sum(self.weighted(c, path) for c in self.children[context, path])

    def _weighted(self, context, path):
        if len(context) == self.depth:
            return self.alone(context, path)
        return float(np.logaddexp(self.alone(context, path), self.below(context, path))) - math.log(2)

    def one(self, context, path):
        seen = [d for d in range(self.depth + 1) if (context[self.depth - d :], path) in self.counts]
        if not seen:
            return 0.5
        p = None
        for d in reversed(seen):
            c = context[self.depth - d :]
            a, b = self.counts[c, path]
            own = (b + 0.5) / (a + b + 1)
            if p is None:
                p = own
            else:
                w = 1 / (1 + math.exp(min(700, self.below(c, path) - self.alone(c, path))))
                p = w * own + (1 - w) * p
        return p

    def score(self, text):
        return sum(math.log10(p if bit else 1 - p) for context, path, bit in self.decisions(text) for p in [self.one(context, path)])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("abAé \n", max_size=30), min_size=1, max_size=8), st.integers(2, 4))
def test_scores_equal_the_definition(texts, depth):
    plain, model = Plain(texts, depth), model_of(texts, depth)
    asked = [*texts, "zebra b", "", "ab ab ab", "éé"]
    assert scores(model, asked) == pytest.approx([plain.score(t) for t in asked], rel=2e-3, abs=1e-3)


def test_probabilities_of_bytes_add_up_to_one():
    model = model_of([prose(k, 60) for k in range(20)], 3)
    for context in (b"the", b"zzz", b"e s", b"\n\n\n", bytes([255, 0, 7])):
        key = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        value, missing = model.table().look_up(key)
        value = value.astype(float)
        value[missing] = model.unseen(key[missing])
        assert (10**value).sum() == pytest.approx(1, abs=1e-4)


def test_estimates_and_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.25, 100.5, 1e9])
    assert tree.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)
    # 0 then 1: one half, then a quarter.
    assert math.exp(tree.log_estimate(np.array([1.0]), np.array([1.0]))[0]) == pytest.approx(1 / 8)


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_hash_table(keys, others):
    keys = np.array(sorted(keys), np.uint64)
    table = tree.HashTable(keys, np.arange(len(keys), dtype=np.int32))
    asked = np.concatenate([keys, np.array(others, np.uint64), np.zeros(1, np.uint64)])
    value, missing = table.look_up(asked)
    known = {int(k): i for i, k in enumerate(keys)}
    assert sorted(missing.tolist()) == [i for i, k in enumerate(asked) if int(k) not in known]
    assert all(value[i] == known[int(k)] for i, k in enumerate(asked) if int(k) in known)


def test_query_against_plain_counts(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op4_lm_scoring"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = lambda key: zlib.crc32(str(key).encode()) % 5 == 1
    split = {r["doc_id"]: [*r["text"].encode().lower().split(), None] for r in rows}
    counts = collections.Counter(w for key, words in split.items() if not out(key) for w in words)
    total, distinct = sum(counts.values()), len(counts)
    model = model_of([r["text"] for r in rows if not out(r["doc_id"])], tree.DEPTH)
    want = dict(zip([r["doc_id"] for r in rows], scores(model, [r["text"] for r in rows])))
    assert len(got) == len(rows)
    for key, words in split.items():
        r = got[key]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(key), len(words), sum(counts[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(want[key], rel=1e-6)


def test_passes_and_known_words_change_nothing(spark):
    rows = [(i, prose(i, 50)) for i in range(60)] + AWKWARD[:6]
    frame = docs(spark, rows, n_tokens="mine", more=1)
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    key = lambda r: (r["doc_id"], round(r["score"], 3), round(r["base_score"], 3), r["n_known"])
    one = sorted(map(key, lm_scoring.score(frame, learn).collect()))
    assert sorted(map(key, lm_scoring.score(frame, learn, runs_in_pass=300, known_words=20).collect())) == one
    assert len(one) == len(rows)


def test_awkward_rows_and_empty_tables(spark):
    frame = docs(spark, score="mine", number=5)
    rows = lm_scoring.score(frame, F.lit(True), carry=("doc_id", "score", "number")).collect()
    assert len(rows) == len(AWKWARD) and all(r["score"] < 0 and r["number"] == 5 for r in rows)
    bare = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {(r["n_tokens"], r["n_known"]) for r in bare} == {(1, 1)} and len({r["score"] for r in bare}) == 1
    nothing = lm_scoring.score(docs(spark, [(1, "ab"), (2, None)]), F.lit(False)).collect()
    assert {(r["doc_id"], r["n_known"], r["train_tokens"], round(r["score"], 6)) for r in nothing} == {(1, 0, 0, round(24 * math.log10(0.5), 6)), (2, 0, 0, round(8 * math.log10(0.5), 6))}
    assert lm_scoring.score(docs(spark, []), F.lit(True)).count() == 0
