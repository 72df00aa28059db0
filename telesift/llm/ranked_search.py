"""Ranked lexical search: every document scored exactly against each item, the best few kept.

Texts are cut into terms once; of each, the length and the counts of the items' terms are written. Document frequencies, the
number of documents and their total length come from that table. Each task then grows ball trees over blocks of documents and
searches them for all items, carrying the best scores from block to block, so that later balls are passed over. The best of all
tasks meet per item, at most k from each.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document's impact of a term is (10^9 tf) div (1000 tf + 12 m) with
m = 75 + (25 n N) div L; a score is the sum of weight times impact over the item's terms, repeats included. Terms are runs of
letters, digits and non-ASCII characters, A-Z lower-cased, compared by 64-bit hashes.

Items are taken ITEM_BYTES at a time, by a hash; weights don't depend on the items, so the cut changes no score. A task holds
BLOCK documents, or fewer of many terms.

Defined results
    A null or empty text has no terms: such documents don't count, such items find nothing. Items that agree in id and text are
    one; items of one id and unlike texts are searched apart, and their ranks are told apart by no column. Equal scores come by
    ascending document id, null ids last; repeated documents are ranked row by row. An item meets fewer than k documents if
    fewer score above 0. Texts may be of any length. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telesift.llm import ball_tree
from telesift.llm.arrow import batch_of, record
from telesift.llm.ball_tree import Best, Queries, Sparse
from telesift.llm.words import NOT_ALPHANUMERIC, find_words, slices
from telesift.session import scratch_path

K = 20
#: Item texts that one pass holds on the driver and in every task.
ITEM_BYTES = 8 << 20
#: Documents of a tree, and entries of them.
BLOCK = 4096
BLOCK_ENTRIES = 1 << 20

RESULT = record(item_id="long", rank="int", doc_id="long", score="long")
_COUNTED = record(doc_id="long", n="long", terms="[int]", counts="[int]")
_HELD = record(term="int", held="long")
_FOUND = record(item="int", doc_id="long", score="long")


def _runs(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, how often), sorted."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])])) if len(key) else np.zeros(0, np.int64)
    return row[start], key[start], np.diff(np.append(start, len(key)))


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = find_words(texts, NOT_ALPHANUMERIC)
    return words.doc, words.hashes().view(np.int64)


def _count(shared):
    """Length of each text, and how often it holds the items' terms; texts without a term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for some in slices(batch, "__text"):
                doc, key = _hashes(some.column("__text"))
                n = np.bincount(doc, minlength=some.num_rows)
                at = np.minimum(np.searchsorted(vocabulary, key), len(vocabulary) - 1)
                hit = vocabulary[at] == key
                row, term, count = _runs(doc[hit], at[hit])
                there = np.flatnonzero(n)
                offsets = pa.array(np.append(np.searchsorted(row, there), len(row)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (term, count)]
                yield batch_of(_COUNTED, [some.column("__id").take(pa.array(there)), n[there], *lists])

    return run


def _held(terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
        there = np.flatnonzero(held)
        yield batch_of(_HELD, [there.astype(np.int32), held[there]])

    return run


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each term adds for a document, n and tf given entry by entry."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        m = np.array([75 + 25 * int(v) * documents // length for v in n], np.int64)
    else:
        m = 75 + 25 * n * documents // max(length, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weights(held: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * h + 1))) for h in held.tolist()], np.int64)


def _search(shared, documents: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries = shared.value
        best = [Best(k) for _ in range(len(queries.first) - 1)]
        held: list[tuple] = []
        entries = 0

        def flush():
            keys = [key for part in held for key in part[0]]
            n = np.concatenate([part[1] for part in held])
            sizes = np.concatenate([part[2] for part in held])
            term, tf = (np.concatenate([part[c] for part in held]) for c in (3, 4))
            first = np.concatenate([[0], np.cumsum(sizes)])
            value = impacts(tf.astype(np.int64), np.repeat(n, sizes), documents, length)
            root = ball_tree.grow(Sparse(first, term.astype(np.int64), value), keys, weight, queries, k)
            ball_tree.search(root, queries, best)

        for batch in batches:
            sizes = np.asarray(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False), np.int64)
            some = batch.filter(pa.array(sizes > 0))
            sizes = sizes[sizes > 0]
            cut = np.concatenate([[0], np.cumsum(sizes)])
            term, tf = (some.column(c).flatten().to_numpy() for c in ("terms", "counts"))
            n = some.column("n").to_numpy()
            # Ids as (is null, id), so that nulls come last.
            keys = [(i is None, i or 0) for i in some.column("doc_id").to_pylist()]
            a = 0
            while a < len(sizes):
                room = BLOCK - sum(len(part[0]) for part in held)
                b = min(a + room, max(a + 1, int(np.searchsorted(cut, cut[a] + BLOCK_ENTRIES - entries, side="right")) - 1))
                held.append((keys[a:b], n[a:b], sizes[a:b], term[cut[a] : cut[b]], tf[cut[a] : cut[b]]))
                entries += int(cut[b] - cut[a])
                if entries >= BLOCK_ENTRIES or b < len(sizes) or sum(len(part[0]) for part in held) >= BLOCK:
                    flush()
                    held.clear()
                    entries = 0
                a = b
        if held:
            flush()
        rows = [(item, None if null else id, score) for item, mine in enumerate(best) for score, (null, id) in mine.rows]
        yield batch_of(_FOUND, [list(c) for c in zip(*rows)] if rows else [[]] * 3)

    return run


def _pass(spark: SparkSession, docs: DataFrame, items: list[tuple], k: int, text: str, id: str) -> DataFrame:
    row, key = _hashes(pa.array([t for _, t in items], pa.string()))
    row, key, count = _runs(row, key)
    vocabulary, term = np.unique(key, return_inverse=True)
    path = scratch_path(spark, "counted")
    plain = docs.select(F.col(id).cast("long").alias("__id"), F.col(text).alias("__text"))
    shared = spark.sparkContext.broadcast(vocabulary)
    if not len(vocabulary):
        return spark.createDataFrame([], "item_id long, item int, doc_id long, score long")
    plain.mapInArrow(_count(shared), _COUNTED).write.parquet(path)
    counted = spark.read.parquet(path)
    documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(vocabulary), np.int64)
    for r in counted.select("terms").mapInArrow(_held(len(vocabulary)), _HELD).groupBy("term").agg(F.sum("held").alias("held")).collect():
        held[r["term"]] = r["held"]
    weight = weights(held, documents)
    first = np.searchsorted(row, np.arange(len(items) + 1))
    queries = Queries(first, term, count.astype(np.int64), count * weight[term])
    tree = spark.sparkContext.broadcast((weight, queries))
    found = counted.mapInArrow(_search(tree, documents, length, k), _FOUND)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return found.join(names, "item").select("item_id", "item", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = K, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    plain = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter("t <> ''").distinct()
    total = plain.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    passes = max(1, math.ceil(total / ITEM_BYTES))
    out = None
    for p in range(passes):
        some = plain.filter(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == p).orderBy("i", "t").collect()
        one = _pass(spark, docs, [tuple(r) for r in some], k, text, id).withColumn("part", F.lit(p))
        out = one if out is None else out.unionByName(one)
    order = Window.partitionBy("part", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*RESULT.names)
