"""Documents as binary token ids: written in ascending key order as rANS blocks, and read back in parallel.

A folder holds
    table   id, freq: the shared frequency table, made of the counts of all ids of the corpus (a row for each id in use)
    blocks  part, block, start, keys, data: a block of about BLOCK_IDS ids (see rans.py), the keys of its documents in
            order, and how many ids come before it; Parquet files, so that Spark's writers commit them to any store and
            a lost executor costs its tasks only

Defined results
    A null or empty text is its end id alone. Null keys come first. Repeated rows are written as often as they come.
    A document is never split between blocks, so one of very many ids makes a block of its own. An empty table writes an
    empty folder, which reads back as no rows. Other columns are not written, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telesift.llm import rans
from telesift.llm.arrow import batch_of, record
from telesift.llm.token_ids import encoder, vocabulary_path
from telesift.llm.words import slices
from telesift.session import scratch_path

BLOCK_IDS = 1 << 20

#: `totals` is only in a task's last block: how often the task met each id, by id, as 64-bit numbers.
_RAW = record(part="int", block="int", before="long", keys="[long]", lengths="[int]", ids="binary", totals="binary")
_BLOCKS = record(part="int", block="int", start="long", keys="[long]", data="binary")
_COUNTS = record(id="int", n="long")
_IDS = record(key="long", start="long", ids="[int]")
_DOCS = record(key="long", start="long", n_tokens="long", ids_crc32="long")


def _tokenised(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(path).encode
        block, before, held = 0, 0, 0
        keys, lengths, ids = [], [], []
        totals = np.zeros(0, np.int64)

        def flush(last: bool = False) -> pa.RecordBatch:
            nonlocal block, before, held, totals
            whole = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            n = np.bincount(whole, minlength=len(totals))
            n[: len(totals)] += totals
            totals = n
            row = [[part], [block], [before], [sum(keys, [])], [np.concatenate(lengths) if lengths else []], [whole.astype("<u4").tobytes()]]
            row.append([totals.astype("<i8").tobytes() if last else None])
            block, before, held = block + 1, before + held, 0
            for x in (keys, lengths, ids):
                x.clear()
            return batch_of(_RAW, row)

        for batch in batches:
            for some in slices(batch, "text"):
                got, n = encode(some.column("text"), end_id)
                key, upto, a = some.column("key").to_pylist(), np.concatenate([[0], np.cumsum(n)]), 0
                while a < len(n):
                    # As many documents as fit, but one at least.
                    b = int(np.searchsorted(upto, upto[a] + BLOCK_IDS - held, "right")) - 1
                    if b <= a and held:
                        yield flush()
                        continue
                    b = max(a + 1, b)
                    keys.append(key[a:b])
                    lengths.append(n[a:b].astype(np.int32))
                    ids.append(got[upto[a] : upto[b]])
                    held, a = held + int(upto[b] - upto[a]), b
                    if held >= BLOCK_IDS:
                        yield flush()
        if held or block:
            yield flush(last=True)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for totals in batch.column("totals"):
            n = np.frombuffer(totals.as_buffer(), "<i8").copy()
            n, total = (n, total) if len(n) >= len(total) else (total.copy(), n)
            n[: len(total)] += total
            total = n
    seen = np.flatnonzero(total)
    yield batch_of(_COUNTS, [seen, total[seen]])


def _encoded(ids: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.of_counts(ids, counts)
        for batch in batches:
            for row in range(batch.num_rows):
                raw = np.frombuffer(batch.column("ids")[row].as_buffer(), "<u4")
                lengths = batch.column("lengths")[row].values.to_numpy()
                same = [batch.column(c).slice(row, 1) for c in ("part", "block", "start", "keys")]
                data = pa.array([rans.encode_block(raw, lengths, shared)], pa.binary())
                yield pa.RecordBatch.from_arrays([*same, data], names=_BLOCKS.names)

    return run


def write(docs: DataFrame, folder: str, key: str, text: str, end_id: int, tokenizer: str | None = None) -> None:
    """Encode every whole text and write all ids below `folder`."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    ordered = picked.repartitionByRange(parts, "key").sortWithinPartitions("key")
    raw_path = scratch_path(spark, "token-ids")
    # Encoded once and written: coding reads the ids, not the texts; counting reads a row a task.
    tokenised = ordered.mapInArrow(_tokenised(tokenizer or vocabulary_path(), end_id), _RAW)
    tokenised.write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.schema(_RAW).parquet(raw_path)

    # A row for each id in use: bounded by the vocabulary.
    counts = raw.filter("totals IS NOT NULL").select("totals").mapInArrow(_count, _COUNTS).groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()
    table = rans.Table.of_counts(counts["id"].to_numpy(), counts["n"].to_numpy())
    rows = list(zip(table.ids.tolist(), table.freq.astype(np.int64).tolist()))
    spark.createDataFrame(rows, "id int, freq long").coalesce(1).write.parquet(f"{folder}/table")

    sizes = raw.select("part", (F.col("before") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("upto"))
    parts_of = sizes.groupBy("part").agg(F.max("upto").alias("n"))  # a row for each range partition
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts_of.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    # A task's last block may hold its totals only.
    placed = raw.filter(F.size("keys") > 0).join(F.broadcast(offsets), "part").select(
        "part", "block", (F.col("offset") + F.col("before")).alias("start"), "keys", "lengths", "ids"
    )
    coded = placed.mapInArrow(_encoded(counts["id"].to_numpy(), counts["n"].to_numpy()), _BLOCKS)
    coded.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _table(spark: SparkSession, folder: str) -> rans.Table:
    rows = spark.read.schema("id int, freq long").parquet(f"{folder}/table").orderBy("id").toPandas()
    freq = rows["freq"].to_numpy().astype(np.uint64)
    bits = int(freq.sum()).bit_length() - 1 if len(freq) else 0
    return rans.Table(rows["id"].to_numpy().astype(np.uint32), freq, np.cumsum(freq) - freq, bits)


def _documents(table: rans.Table):
    """(key, start, ids) of each document of each block."""

    def run(batch: pa.RecordBatch, places: np.ndarray):
        for row in range(batch.num_rows):
            block = rans.Block.parse(batch.column("data")[row].as_py())
            ids, at = block.ids(table, places), 0
            start = batch.column("start")[row].as_py()
            for key, n in zip(batch.column("keys")[row].as_py(), block.lengths.tolist()):
                yield key, start + at, ids[at : at + n]
                at += n

    return run


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Of each document, from its decoded ids: key, start, n_tokens, ids_crc32."""
    table = _table(spark, folder)
    documents = _documents(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = table.places()
        for batch in batches:
            rows = [(key, start, len(ids), zlib.crc32(ids)) for key, start, ids in documents(batch, places)]
            yield batch_of(_DOCS, list(zip(*rows)) if rows else [[]] * 4)

    return spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("start", "keys", "data").mapInArrow(run, _DOCS)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Of each document: key, start, ids."""
    table = _table(spark, folder)
    documents = _documents(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = table.places()
        for batch in batches:
            for key, start, ids in documents(batch, places):
                yield batch_of(_IDS, [[key], [start], [ids.astype(np.int32)]])

    return spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("start", "keys", "data").mapInArrow(run, _IDS)
