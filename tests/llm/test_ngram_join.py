"""Near copies against all pairs."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.readwriter import DataFrameWriter

from telesift.llm import ngram_join
from telesift.llm.components import components
from telesift.llm.queries import QUERIES
from tests.llm.cases import AWKWARD, docs, prose


def plain_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(smallest.get(find(i), key), key)
    return [(key, len(sets[i]), smallest.get(find(i))) for i, (key, _) in enumerate(rows)]


def check(spark, rows):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.link(docs(spark, rows)).collect()]
    key = lambda row: tuple(-1 if x is None else x for x in row)
    assert sorted(got, key=key) == sorted(plain_components(rows), key=key)


def edited(text, r, share):
    return " ".join(w if r.random() > share else f"new{r.randrange(10**6)}" for w in text.split())


def family(seed, size, words, share):
    r = random.Random(seed)
    base = prose(seed, words)
    return [edited(base, r, r.uniform(0, share)) for _ in range(size)]


def test_awkward_rows(spark):
    check(spark, [*AWKWARD, (30, "A b\tC d"), (31, "x " * 9), (32, "x " * 90), (33, prose(4, 120).upper())])


def test_empty_and_lone_tables(spark):
    assert ngram_join.link(docs(spark, [])).count() == 0
    check(spark, [(7, prose(1, 30))])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_families_around_the_threshold(spark, seed):
    r = random.Random(seed)
    texts = [t for k in range(12) for t in family(100 * seed + k, r.randrange(2, 14), r.randrange(5, 160), 0.06)]
    # Chains: each a little further from the first.
    chain = [prose(seed + 7000, 60)]
    for _ in range(10):
        chain.append(edited(chain[-1], r, 0.02))
    # A passage that many otherwise unlike texts share, and texts that are hardly more than it.
    passage = prose(seed + 8000, 60)
    texts += chain + [prose(seed + 9000 + k, 80) + " " + passage for k in range(25)] + [passage + " " + prose(seed + 9500 + k, 8) for k in range(12)]
    r.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_against_all_pairs_of_a_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: r["component_id"] for r in QUERIES["op9_ngram_join"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {key: component for key, _, component in plain_components(rows)}


def test_frequent_shingles_only_change_the_order(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "KNOWN_FREQUENT", 10)
    monkeypatch.setattr(ngram_join, "AGREE", 9)
    check(spark, list(enumerate(family(5, 20, 100, 0.05) + family(6, 20, 100, 0.05) + [prose(k, 70) for k in range(20)])))


def test_keep_one(spark):
    rows = [(3, prose(1, 80)), (2, prose(1, 80)), (2, prose(1, 80)), (9, prose(2, 80)), (None, prose(1, 80)), (5, None), (6, ""), (5, None)]
    frame = docs(spark, rows, component_id=1, node="x", __row=4)
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    texts = [r["text"] for r in kept.collect()]
    assert sorted(t or "" for t in texts) == sorted([prose(1, 80), prose(2, 80), "", "", ""])


def test_keep_one_holds_to_its_numbers(spark, tmp_path):
    """Files that are dealt to tasks in another way when they are read again change nothing."""
    rows = [(i, prose(i // 3, 80)) for i in range(60)]
    docs(spark, rows).repartition(12, "doc_id").write.parquet(str(tmp_path / "in"))
    frame = spark.read.parquet(str(tmp_path / "in"))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        kept = ngram_join.keep_one(frame)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        spark.conf.set("spark.sql.files.minPartitionNum", "60")
        assert sorted(r["doc_id"] // 3 for r in kept.collect()) == list(range(20))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_against_plain_python(spark, links):
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    frame = spark.createDataFrame(links, "a long, b long")
    assert {tuple(r) for r in components(frame).collect()} == {(x, find(x)) for x in linked}


def test_a_long_chain_and_a_hub(spark):
    chain = [(k, k + 1) for k in range(300)]
    hub = [(1000, 1000 + k) for k in range(1, 2000)]
    got = dict(components(spark.createDataFrame(chain + hub, "a long, b long")).collect())
    assert {got[k] for k in range(301)} == {0} and {got[1000 + k] for k in range(2000)} == {1000}


def test_a_large_family_does_not_meet_pair_by_pair(spark, monkeypatch):
    """Texts that are near some members of a large group only: they join it before candidates are made, and links are whole."""
    r, base = random.Random(11), prose(77, 100).split()

    def made(k, at=(), other=False):
        words = list(base)
        if other:
            words[50] = "else"
        for place in at:
            words[place] = f"new{k}x{place}"
        return " ".join([*words, f"tail{k}"])

    texts = [made(k, other=k % 4 == 0) for k in range(80)]
    texts += [made(k, (r.randrange(8, 40), r.randrange(60, 90)), True) for k in range(80, 160)]
    seen, real = [], ngram_join._open
    monkeypatch.setattr(ngram_join, "_open", lambda *args: seen.append(args[4].count()) or real(*args))
    check(spark, list(enumerate(texts)))
    assert sum(seen) < 1000  # 80 texts have 3,160 pairs


@pytest.mark.parametrize("seed", [4, 5])
def test_crowds_of_any_size(spark, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "CROWD", 1)
    r = random.Random(seed)
    texts = [t for k in range(8) for t in family(300 * seed + k, r.randrange(2, 20), r.randrange(5, 160), 0.08)]
    passage = prose(seed + 8000, 60)
    texts += [prose(seed + 9000 + k, 30) + " " + passage for k in range(25)] + [passage + " " + prose(seed + 9500 + k, 8) for k in range(12)]
    r.shuffle(texts)
    check(spark, [*AWKWARD, *enumerate(texts + texts[:9], 1000)])


def test_frequent_shingles_of_a_chunk():
    rows = [(1, "a b c d e f g"), (2, "a b c d e f"), (3, "c d e f g"), (4, "x y z"), (5, "a b c d e")]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array([t for _, t in rows])], names=["key", "text"])
    got = {}
    for out in ngram_join._first_pass(iter([batch])):
        got.update((t, n) for t, n in zip(out.column("shingle").to_pylist(), out.column("times").to_pylist()) if t is not None)
    counts = {}
    for _, text in rows:
        for x in ngram_join.shingle_sets(pa.array([text]))[1][0].view("int64").tolist():
            counts[x] = counts.get(x, 0) + 1
    assert got == {x: n for x, n in counts.items() if n > 1} and sorted(got.values()) == [2, 2, 3]


def test_components_of_stars_need_no_round(spark, monkeypatch):
    """Links that are stars around their smallest node, copies and turned ones too, are written once and grouped once."""
    written, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: written.append(path) or real(self, path, *a, **k))
    links = [(1, 5), (5, 1), (1, 6), (1, 6), (2, 9), (3, 3), (None, 4)]
    assert dict(components(spark.createDataFrame(links, "a long, b long")).collect()) == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2}
    assert len(written) == 1


def test_few_shuffles(spark, monkeypatch):
    """Sizes come along with sketch values, and filters that are needed together are made in one job."""
    jobs, real = [], ngram_join._filled
    monkeypatch.setattr(ngram_join, "_filled", lambda *tables: jobs.append(len(tables)) or real(*tables))
    check(spark, list(enumerate(family(5, 20, 100, 0.05) + family(6, 20, 100, 0.05))))
    assert sum(jobs) > len(jobs)
