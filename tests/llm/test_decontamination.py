"""Benchmark items in documents, against a search for their words."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from telesift.llm import decontamination as dc
from telesift.llm.queries import QUERIES
from telesift.llm.words import NOT_ALPHANUMERIC, find_words
from tests.llm.cases import AWKWARD, docs, prose

ITEM_ROWS = [(1, "Which metal does the quiet harbour lantern hold?\nCopper of the seven stones."), (2, None), (3, ""), (4, "..."), (5, "Lone"), (1, prose(77, 30)), (None, prose(78, 20))]


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def items(spark, rows=ITEM_ROWS):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_all_verbatim_items_are_found_and_nothing_else(spark):
    folder = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op2_decontamination"](spark, folder).collect()}
    marked = {r["item_id"]: " " + " ".join(words(r["text"])) + " " for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        text = " " + " ".join(words(r["text"])) + " "
        want |= {(r["doc_id"], i) for i, x in marked.items() if x in text}
    assert got == want and len(want) > 10


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.floats(0.2, 0.9))
def test_retrieval_equals_brute_force(seed, bound):
    rng = np.random.default_rng(seed)
    word = lambda: "w%d" % min(rng.zipf(1.3), 400)
    rows = [(i, " ".join(word() for _ in range(rng.integers(3, 20)))) for i in range(30)]
    texts = [" ".join(word() for _ in range(rng.integers(1, 400))) for _ in range(6)]
    texts[0] += " " + rows[3][1]
    index = dc.Items.build(rows)
    found = find_words(pa.array(texts), NOT_ALPHANUMERIC)
    key = found.hashes().view(np.int64)
    at = np.minimum(np.searchsorted(index.vocabulary, key), len(index.vocabulary) - 1)
    hit = np.flatnonzero(index.vocabulary[at] == key)
    got = {(r, p, i): s for r, p, i, s in zip(*(x.tolist() for x in dc._retrieve(index, bound, found.doc[hit], (hit - found.first[found.doc[hit]]), at[hit])))}
    weight, term_of = {}, {}
    for t in range(len(index.vocabulary)):
        for p in range(index.post_first[index.term_first[t]], index.post_first[index.term_first[t + 1]]):
            weight[t, int(index.item[p])] = index.weight[p]
        term_of[int(index.vocabulary[t])] = t
    for r, text in enumerate(texts):
        terms = [term_of.get(int(x)) for x in key[found.first[r] : found.first[r + 1]]]
        for p in range(-(-len(terms) // index.stride)):
            inside = {t for t in terms[p * index.stride : (p + 2) * index.stride] if t is not None}
            for i in range(30):
                score = sum(weight.get((t, i), 0.0) for t in inside)
                if abs(score - bound) > 1e-3:
                    assert ((r, p, i) in got) == (score >= bound)


def test_awkward_rows_and_clashing_names(spark):
    text = words(ITEM_ROWS[0][1])
    rows = [*AWKWARD, (20, prose(1, 40) + " " + " ".join(text).upper() + " " + prose(2, 300)), (21, " ".join(text[: len(text) // 2])), (22, "lone"), (20, ITEM_ROWS[0][1])]
    frame = docs(spark, rows, item_id=9, score="x", clean=True)
    got = dc.find(frame, items(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(20, 1), (22, 5)}
    assert sum(r["doc_id"] == 20 for r in got) == 2
    first = max((r for r in got if r["doc_id"] == 20), key=lambda r: r["last_word"])
    assert first["first_word"] <= 40 and first["score"] > 0.99 and first["answer_overlap"] == 1.0
    kept = dc.drop_contaminated(frame, items(spark))
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(i or 0 for i, _ in [*AWKWARD, (21, "")])


def test_empty_tables(spark):
    assert dc.find(docs(spark, []), items(spark)).count() == 0
    assert dc.find(docs(spark), items(spark, [])).count() == 0
    assert dc.drop_contaminated(docs(spark), items(spark, [(1, None)])).count() == len(AWKWARD)


def test_items_in_several_passes(spark, monkeypatch):
    rows = [(i, prose(100 + i, 25)) for i in range(40)]
    frame = docs(spark, [(i, prose(500 + i, 100) + " " + t + " " + prose(900 + i, 100)) for i, t in rows])
    one = {(r["doc_id"], r["item_id"]) for r in dc.find(frame, items(spark, rows)).collect()}
    monkeypatch.setattr(dc, "ITEM_BYTES", 2000)
    several = {(r["doc_id"], r["item_id"]) for r in dc.find(frame, items(spark, rows)).collect()}
    assert one == several == {(i, i) for i in range(40)}
    assert dc.drop_contaminated(frame, items(spark, rows)).count() == 0


def test_a_long_item_changes_no_other_items_passages(spark):
    """The halves of a short item far apart are no find, whatever else is in the benchmark."""
    item = prose(40, 20).split()
    apart = " ".join(item[:10]) + " " + prose(41, 3000) + " " + " ".join(item[10:])
    frame = docs(spark, [(1, apart), (2, prose(42, 50) + " " + " ".join(item) + " " + prose(43, 50))])
    short, long = (7, " ".join(item)), (8, prose(44, 5000))
    for rows in ([short], [short, long]):
        assert {(r["doc_id"], r["item_id"]) for r in dc.find(frame, items(spark, rows)).collect()} == {(2, 7)}
    assert [r["doc_id"] for r in dc.drop_contaminated(frame, items(spark, [short, long])).collect()] == [1]


def test_passes_give_equal_rows(spark, monkeypatch):
    rows = [(i, prose(100 + i, 12 + 30 * (i % 7))) for i in range(40)]
    frame = docs(spark, [(i, prose(500 + i, 80) + " " + " ".join(t.split()[3:]) + " " + prose(900 + i, 100)) for i, t in rows])
    found = lambda: sorted(tuple(r) for r in dc.find(frame, items(spark, rows), min_score=0.3, min_overlap=0.1).collect())
    one = found()
    monkeypatch.setattr(dc, "ITEM_BYTES", 6000)
    assert found() == one and len(one) > 20
