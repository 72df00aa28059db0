"""Nearest vectors of a set of queries among all rows, by a block matrix join.

Candidates are dealt into blocks by a hash of the row, queries likewise; every pair of a query block and a candidate block is one
cell, and a cell is one group of a co-grouped shuffle. Within a cell, tiles of the product of int8 codes give every distance with
a bound on what the codes left out. Pairs whose least possible distance is above the k-th smallest of the greatest possible ones
are out; the others are worked out in double precision from the vectors themselves and merged by heaps. The bounds are safe, so
the answer is exact; no pair is skipped for want of room.

A cell holds CELL_BYTES of candidates and as many of queries, and a tile of TILE pairs, whatever the tables' size: more rows make
more cells. Equal vectors of a batch are cut to those of the k + 1 smallest ids before the shuffle: of candidates at one distance
no others can be among k, so a vector that a third of all rows share is a few rows a task.

Defined results
    Vectors that are null, empty, zero, or hold null, NaN or infinite components take no part, nor do rows without an id.
    Vectors of unlike length have no distance and don't meet. Queries that agree in id and vector ask once; every row but one
    that agrees with the query in both is a candidate, so a repeated row finds its copy. Ties go to the smaller id. With fewer
    candidates than k all come. An empty table gives no rows. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.llm.arrow import batch_of, record

K = 10
#: Vectors of one side that a cell holds, in bytes.
CELL_BYTES = 16 << 20
#: Rows that are worth a cell of their own while cells are fewer than cores.
LEAST_ROWS = 1024
#: Queries and candidates of a tile.
TILE = (256, 4096)
#: Products of so many codes of -127 to 127 add up exactly in 32-bit floats.
EXACT_DIMS = 1024

RESULT = record(query_id="long", rank="int", vec_id="long", score="double")
_FOUND = record(query_id="long", query_key="long", vec_id="long", score="double")


def usable(id: str, vector: str) -> Column:
    """Rows that take part."""
    x = F.col(vector)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return F.col(id).isNotNull() & x.isNotNull() & F.forall(x, finite) & F.exists(x, lambda v: v != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all rows in one run, and where rows begin."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(lengths)])


def _by_length(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for each length of vectors."""
    flat, first = _matrix(column)
    length = np.diff(first)
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, flat[first[rows][:, None] + np.arange(d)]


def _fewer_copies(k: int):
    """Of equal vectors in a batch, the rows of the k + 1 smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keep = batch.column(0).to_numpy(zero_copy_only=False), []
            for rows, x in _by_length(batch.column(1)):
                # -0.0 and 0.0 are one number.
                _, group = np.unique((x + 0.0).view(f"V{8 * x.shape[1]}").ravel(), return_inverse=True)
                order = np.lexsort((ids[rows], group))
                g = group[order]
                place = np.arange(len(g)) - np.searchsorted(g, g)
                keep.append(rows[order[place <= k]])
            if keep:
                yield batch.take(pa.array(np.sort(np.concatenate(keep))))

    return run


class _Codes:
    """int8 codes of vectors, with what they leave out."""

    def __init__(self, x: np.ndarray):
        self.x = x
        top = np.abs(x).max(1)
        scale = top / 127
        scale[scale == 0] = 1.0
        self.code = np.rint(x / scale[:, None]).astype(np.int8)
        self.scale = scale
        self.norm2 = np.einsum("ij,ij->i", x, x)
        coded = self.code * scale[:, None]
        left = x - coded
        self.coded = np.sqrt(np.einsum("ij,ij->i", coded, coded)) * (1 + 1e-9)
        self.left = np.sqrt(np.einsum("ij,ij->i", left, left)) * (1 + 1e-9) + 1e-300


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows; 32-bit floats hold each partial sum exactly."""
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_DIMS):
        total += a[:, k : k + EXACT_DIMS].astype(np.float32) @ b[:, k : k + EXACT_DIMS].astype(np.float32).T
    return total


def squared_bounds(q: _Codes, c: _Codes, qs: slice, cs: slice) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible squared distance of every pair of a tile."""
    inner = _products(q.code[qs], c.code[cs]) * q.scale[qs, None] * c.scale[None, cs]
    size = q.norm2[qs, None] + c.norm2[None, cs]
    middle = size - 2 * inner
    off = q.coded[qs, None] * c.left[None, cs] + q.left[qs, None] * (c.coded + c.left)[None, cs]
    # The second term covers rounding of all sums above.
    off = 2 * off + size * (1e-15 * (q.x.shape[1] + 16))
    return middle - off, middle + off


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed in the order of the components."""
    d = x - q
    return np.sqrt(np.cumsum(d * d, axis=1)[:, -1])


def _cell(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and candidates.num_rows:
            of_length = {x.shape[1]: (rows, x) for rows, x in _by_length(candidates.column("v"))}
            for rows, x in _by_length(queries.column("v")):
                if x.shape[1] in of_length:
                    at, y = of_length[x.shape[1]]
                    ids = candidates.column("id").to_numpy()[at]
                    _search(queries.column("id").to_numpy()[rows], queries.column("key").to_numpy()[rows], x, ids, y, k, out)
        return pa.Table.from_batches([batch_of(_FOUND, [list(c) for c in zip(*out)] if out else [[]] * 4)])

    return run


def _search(query_ids, query_keys, x, ids, y, k, out) -> None:
    q, c = _Codes(x), _Codes(y)
    by_id = np.argsort(ids, kind="stable")
    own = {}
    for i, (a, b) in enumerate(zip(np.searchsorted(ids[by_id], query_ids), np.searchsorted(ids[by_id], query_ids, side="right"))):
        same = [j for j in by_id[a:b] if np.array_equal(y[j], x[i])]
        if same:
            own[i] = same[0]
    for qa in range(0, len(x), TILE[0]):
        qs = slice(qa, min(qa + TILE[0], len(x)))
        # The k nearest so far of each query, farthest on top.
        heaps: list[list[tuple[float, int]]] = [[] for _ in range(qs.stop - qa)]
        for ca in range(0, len(y), TILE[1]):
            cs = slice(ca, min(ca + TILE[1], len(y)))
            least, most = squared_bounds(q, c, qs, cs)
            for i, j in ((i, own[qa + i] - ca) for i in range(len(heaps)) if qa + i in own):
                if 0 <= j < cs.stop - ca:
                    least[i, j] = most[i, j] = np.inf
            kth = np.partition(most, k - 1, axis=1)[:, k - 1] if most.shape[1] > k else np.full(len(heaps), np.inf)
            reached = np.array([h[0][0] ** 2 * (1 + 1e-12) if len(h) == k else np.inf for h in heaps])
            # Not "least <= bound", so that bounds beyond the range of doubles keep a pair.
            open_ = ~(least > np.minimum(kth, reached)[:, None]) & ~np.isposinf(least)
            for i in np.flatnonzero(open_.any(1)):
                near = np.flatnonzero(open_[i]) + ca
                d = distances(y[near], x[qa + i])
                if len(near) > k:
                    first = np.lexsort((ids[near], d))[:k]
                    near, d = near[first], d[first]
                for distance, candidate in zip(d.tolist(), ids[near].tolist()):
                    entry = (-distance, -candidate)
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], entry)
                    elif entry > heaps[i][0]:
                        heapq.heapreplace(heaps[i], entry)
        for i, heap in enumerate(heaps):
            out.extend((query_ids[qa + i], query_keys[qa + i], -b, -a) for a, b in heap)


def nearest(vectors: DataFrame, asks: Column, k: int = K, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row for which `asks` holds.

    Rows and bytes are counted first; they set the number of blocks. A vector is shuffled once for each block of the other side.
    """
    kind = vectors.schema[vector].dataType.elementType
    cast = vector if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(vector).cast("array<double>").alias(vector)
    taking = vectors.select(id, cast, asks.alias("__asks")).filter(usable(id, vector))
    width = 4 if isinstance(kind, T.FloatType) else 8
    size = F.coalesce(F.sum(F.size(vector).cast("long") * width), F.lit(0))
    rows, total, queries, query_total = taking.agg(
        F.count("*"), size, F.count_if("__asks"), F.coalesce(F.sum(F.when(F.col("__asks"), F.size(vector).cast("long") * width)), F.lit(0))
    ).first()
    spread = vectors.sparkSession.sparkContext.defaultParallelism
    across = max(1, math.ceil(total / CELL_BYTES), min(spread, rows // LEAST_ROWS))
    down = max(1, math.ceil(query_total / CELL_BYTES))
    block = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    plain = lambda df: df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
    asking = plain(taking.filter("__asks")).dropDuplicates().select("id", "v", F.xxhash64("v").alias("key"))
    asking = asking.select("*", F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("c"), block(down).alias("q"))
    given = plain(taking)
    given = given.mapInArrow(_fewer_copies(k), given.schema)
    given = given.select("*", block(across).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("q"))
    found = asking.groupBy("c", "q").cogroup(given.groupBy("c", "q")).applyInArrow(_cell(k), _FOUND)
    order = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*RESULT.names)
