"""Shards against SQL and against what the law asks."""

import zlib

import duckdb
import pytest

from telesift.llm import sharding
from telesift.llm.queries import QUERIES
from tests.llm.cases import AWKWARD, docs

SQL = """
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size, coalesce(text, '') AS text FROM '{0}/documents.parquet'
), placed AS (
  SELECT *, row_number() OVER w - 1 AS row_no, sum(size) OVER w - size AS before, sum(size) OVER () AS total
  FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, size)
), cut AS (
  SELECT *, CAST(((2 * before + size) * 24) // (2 * total) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, shard, row_no - min(row_no) OVER (PARTITION BY shard) AS slot, text FROM cut
"""


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = {(r["doc_id"], r["size"], r["shard"], r["slot"], r["text_crc32"]) for r in QUERIES["op7_sharding"](spark, folder).collect()}
    want = {(a, b, c, d, zlib.crc32(text.encode())) for a, b, c, d, text in duckdb.sql(SQL.format(folder)).fetchall()}
    assert got == want


def placed(frame, shards=4):
    sized = frame.selectExpr("*", "octet_length(text) AS size")
    return sharding.assign(sized, ["doc_id", "size"], "size", shards).collect()


def test_awkward_rows_and_clashing_names(spark):
    rows = placed(docs(spark, shard="mine", Slot=3, source="x"))
    assert len(rows) == len(AWKWARD) and rows[0].asDict().keys() == {"doc_id", "text", "source", "size", "shard", "slot", "row_no", "bytes_before"}
    rows.sort(key=lambda r: r["row_no"])
    assert rows[0]["doc_id"] is None
    assert [r["row_no"] for r in rows] == list(range(len(rows)))
    for shard in {r["shard"] for r in rows}:
        assert [r["slot"] for r in rows if r["shard"] == shard] == list(range(sum(r["shard"] == shard for r in rows)))


def test_sizes_are_near_equal_and_runs_are_contiguous(spark):
    rows = sorted(placed(docs(spark, [(i, "x" * (i * 37 % 91)) for i in range(3000)]), 7), key=lambda r: r["doc_id"])
    assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
    sums = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(7)]
    assert max(sums) - min(sums) <= 2 * 91


def test_empty_and_weightless_tables(spark):
    assert placed(docs(spark, [])) == []
    rows = placed(docs(spark, [(i, "") for i in range(8)]))
    assert sorted(r["shard"] for r in rows) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_written_shards_read_back_in_order(spark, tmp_path):
    sized = docs(spark, [(i, "x" * (i % 50)) for i in range(500)]).selectExpr("*", "octet_length(text) AS size")
    sharding.write(sharding.assign(sized, ["doc_id"], "size", 3), str(tmp_path / "out"), rows_per_file=40)
    back = spark.read.parquet(str(tmp_path / "out")).orderBy("shard", "slot").select("doc_id").collect()
    assert [r[0] for r in back] == list(range(500))
