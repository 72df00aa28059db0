"""Token ids and their blocks: exact against the tokenizer on whole texts, and round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from telesift.llm import rans, token_output
from telesift.llm.token_ids import encoder, vocabulary_path
from telesift.session import scratch_path
from tests.llm.cases import AWKWARD, docs


def whole_ids(texts):
    tokenizer = Tokenizer.from_file(vocabulary_path())
    return [tokenizer.encode(text or "", add_special_tokens=False).ids + [1] for text in texts]


def check_texts(texts):
    ids, n = encoder(vocabulary_path()).encode(pa.array(texts, pa.string()), 1)
    want = whole_ids(texts)
    assert n.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])


MARKS = st.text(st.sampled_from("aB'sTé́.,!?<|>İςΣßK 　\t\n\x85中9_-"), max_size=25)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(MARKS, st.text(max_size=25)), min_size=1, max_size=8))
def test_ids_of_words_are_ids_of_whole_texts(texts):
    check_texts([t.encode("utf-8", "ignore").decode() for t in texts])


def test_ids_of_awkward_and_given_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    check_texts([t for _, t in AWKWARD] + [r[0] for r in rows])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=3000), max_size=5), st.integers(1, 50_000))
def test_blocks_round_trip(documents, top):
    lengths = np.array([len(x) for x in documents], np.int64)
    ids = np.array([i * top for x in documents for i in x], np.uint32)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    block = rans.Block.parse(rans.encode_block(ids, lengths, table))
    assert block.ids(table, table.places()).tolist() == ids.tolist() and block.lengths.tolist() == lengths.tolist()


def test_segments_decode_alone_and_damage_is_seen():
    ids = np.random.default_rng(1).zipf(1.3, 600_000).clip(0, 40_000).astype(np.uint32)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    data = rans.encode_block(ids, np.array([len(ids)]), table)
    block = rans.Block.parse(data)
    assert len(block.segments) == 3
    assert (block.segment(1, table, table.places()) == ids[rans.SEGMENT_IDS : 2 * rans.SEGMENT_IDS]).all()
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert len(data) < 1.05 * len(ids) * -(p * np.log2(p)).sum() / 8
    damaged = bytearray(data)
    damaged[-5] ^= 4
    with pytest.raises(ValueError):
        rans.Block.parse(bytes(damaged)).ids(table, table.places())
    with pytest.raises(ValueError):
        rans.Block.parse(data[:-4])


def test_every_id_has_a_place_in_a_skewed_table():
    table = rans.Table.of_counts(np.arange(30_000), np.concatenate([[10**12], np.ones(29_999)]))
    assert int(table.freq.sum()) == 1 << table.bits and table.freq.min() >= 1


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_IDS", 500)
    rows = [(k, t) for k, t in AWKWARD if k != 7]
    folder = scratch_path(spark, "token-output-test")
    token_output.write(docs(spark, rows, start=5, key="mine"), folder, "doc_id", "text", 1)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    ids = whole_ids([rows[i][1] for i in order])
    got = sorted(token_output.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in got] == [rows[i][0] for i in order]
    assert [list(r["ids"]) for r in got] == ids
    digests = sorted(token_output.read_digests(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["ids_crc32"] for r in digests] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [r["start"] for r in digests] == (np.cumsum([len(x) for x in ids]) - [len(x) for x in ids]).tolist()


def test_empty_table(spark):
    folder = scratch_path(spark, "token-output-test")
    token_output.write(docs(spark, []), folder, "doc_id", "text", 1)
    assert token_output.read_digests(spark, folder).count() == 0
