"""The pipeline against plain Python on the smallest tables, and its stages on awkward documents."""

import re

import pytest

import corpus_pipeline
from tests.llm.cases import AWKWARD, docs, prose
from tests.llm.test_ngram_join import plain_components
from tests.llm.test_packing import check_places

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{folder}/{k}")
        frames.append(spark.read.parquet(f"{folder}/{k}"))
    return frames


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(stages):
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns


def test_quality_rules_take_effect_and_keep_clean_documents(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert all(len(t.split()) >= 15 for t in after.values())
    for key, text in before.items():
        lines = [line for line in text.split("\n") if line.strip()]
        plain = all(re.fullmatch(r"[^#*$%&|<>!]*[.,]", line) and "rights reserved" not in line for line in lines)
        words = text.split()
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        if plain and len(words) >= 20 and len(set(windows)) == len(windows):
            assert after.get(key) == text
    assert all(r["n_chars"] == len(r["text"]) for r in stages[1].collect())


def test_classifier_drops_only_what_labels_speak_against(spark, stages):
    gone = set(texts(stages[1])) - set(texts(stages[2]))
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert not gone & good


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[2]), texts(stages[3])
    component = {key: c for key, _, c in plain_components(list(before.items()))}
    assert sorted(component[key] for key in after) == sorted(set(component.values()))
    assert all(before[key] == text for key, text in after.items())


def test_no_benchmark_item_is_left(spark, stages):
    plain = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())) + " "
    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {key for key, text in texts(stages[3]).items() if any(i in plain(text) for i in items)}
    assert set(texts(stages[3])) - held == set(texts(stages[4]))


def test_packing_holds_every_document(spark, stages):
    rows = stages[5].toPandas()
    check_places(rows.length.values, rows.sequence_id.values, rows.offset.values, 4096)
    assert set(rows.doc_id) == set(texts(stages[4]))
    again = corpus_pipeline.run(spark, SF).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again[key].values.tolist())) == sorted(map(tuple, rows[key].values.tolist()))


def test_stages_on_awkward_documents(spark, tmp_path):
    extra = {"kept": "x", "score": 1, "component_id": 2, "node": 3, "shard": 4, "n_chars": 5}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for rows in ([*AWKWARD, (40, prose(40, 100) + "\nAll rights reserved.")], []):
            path = f"{tmp_path}/{k}-{len(rows)}"
            docs(spark, rows, **extra).write.parquet(path)
            frame = spark.read.parquet(path)
            out = stage(spark, frame, SF)
            found = out.collect()
            if name != "packing":
                assert out.columns == frame.columns
            assert rows or not found
            assert len(found) <= len(rows) or name == "packing"
