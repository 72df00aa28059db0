"""Documents linked by the Jaccard similarity of their word n-grams, through a token-group matrix.

1. Every text becomes a set of 64-bit hashes of its shingles. Texts with the same words (A-Z as a-z) are one node, so that
   any number of copies is one node from here on. Eight smallest-hash values of each set are its sketch.
2. Groups: for every sketch value the most central node that has it (whose values are shared most) is its head; nodes that
   share enough values with a head are tried against it. Links that hold make stars, whose components are the groups. A family of thousands of near copies becomes one
   group, or few, at one comparison for each member and sketch value.
3. Token-group matrix: with shingles in one global order, a set and one it is linked with, at least as large, share at least
   L of the smaller one's first |set| - ceil(2t / (1 + t) |set|) + L and the larger one's first |set| - ceil(t |set|) + L
   shingles; L is a fiftieth of the smaller, and 1 more. The matrix has a row for each shingle that is among these of some
   member of a group, with the group: the union of its members' shingles. Shingles that many sets hold come last in the
   order, so that shared passages hardly enter it. Where more than CROWD groups hold a shingle, a member of each is first
   tried against a few members of the largest; links that hold join the groups, and their rows of the matrix fall together.
   So a large family doesn't meet pair by pair, whose number would grow with its square.
4. Two groups that share at least L such matrix shingles are a candidate pair: each member of the smaller group is a query. Its
   overlap with the union of all shingles of the other group bounds its overlap with any member; only where the bound
   reaches the threshold the group is opened and the query compared with its members exactly.
5. Components of all links. Links inside a group change nothing, and every link between groups is found in step 4.

Which shingles count as frequent, and which groups steps 2 and 3 make, decides how fast it is, never what is linked.

Defined results
    Null and empty texts, and those without a word, have 0 shingles and are linked with nothing, not even each other. Fewer
    words than the shingle's size make one shingle of all. Keys may repeat; null keys are never the smallest. An empty table
    gives no rows. Words and shingles are compared by 64-bit hashes: n distinct ones hold a false match with a chance of
    about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.llm.arrow import batch_of, record
from telesift.llm.components import components
from telesift.llm.words import find_words, mix, slices
from telesift.session import scratch_path

SHINGLE = 5
PERCENT = 75
SKETCH = 8
#: Sketch values that a node must share with a head, to be tried with it while groups are made.
AGREE = 3
#: Groups that hold a matrix shingle, beyond which they are tried with the largest; its members are the first ones in so many orders.
CROWD = 64
ORDERS = 8
#: Shingles looked at together for frequent ones: in a full chunk one must come four times to be counted, in a small one twice;
#: in all of them FREQUENT times.
CHUNK = 1 << 22
FREQUENT = 8
#: Frequent shingles known to every task: beyond these, the order treats a shingle as any other.
KNOWN_FREQUENT = 1 << 20
#: Bits of the filter that says which sets are wanted; what it lets through too much is dropped by a join.
FILTER_BITS = 1 << 27
#: Bits of a shingle that say which bucket it is met in; 31 more are compared there.
BUCKET_BITS = 14
#: Bits of a shingle that a group's union keeps; so no union has more than 2^SHORT_BITS entries.
SHORT_BITS = 16

_SKETCHES = record(key="long", node="long", n="int", sketch="[long]", shingle="long", times="long")
_PREFIXES = record(node="long", n="int", least="int", inner="int", tokens="[long]", whole="[long]")
_RUNS = record(bucket="int", low="binary")
_SET_BITS = record(word="long", bit="long")
_CELLS = record(token="long", node="long", n="int", inner="bool")
_MATRIX = record(token="long", grp="long", node="long", members="long", least_n="int", most_n="int", inner="bool", times="long")
_SETS = record(node="long", n="int", short="[short]", whole="[long]")


def _constant(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_PLACE, _SKETCH = _constant(64)[:SHINGLE], _constant(128)[64 : 64 + SKETCH]


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(node of each text: a hash of its words in order; its distinct shingles in ascending order)."""
    words = find_words(texts)
    h, n = words.hashes(), np.diff(words.first)
    place = np.arange(len(h)) - words.first[words.doc]
    # Each place has an odd factor of its own.
    factor = mix(place.astype(np.uint64) + np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * factor, dtype=np.uint64)])
    node = mix(total[words.first[1:]] - total[words.first[:-1]] + n.astype(np.uint64))
    run = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        run += h[k : k + len(run)] * _PLACE[k]
    run = mix(run)
    sets = []
    for row, (a, m) in enumerate(zip(words.first[:-1].tolist(), n.tolist())):
        if m >= SHINGLE:
            x = np.sort(run[a : a + m - SHINGLE + 1])
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        else:
            x = mix(node[row : row + 1] + np.uint64(m)) if m else node[:0]
        sets.append(x)
    return node, sets


def _sketch(x: np.ndarray) -> np.ndarray:
    # High bits of products are the well mixed ones.
    return np.array([(x * c).min() for c in _SKETCH]) if len(x) else np.zeros(0, np.uint64)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, and rows of shingles that come often in a chunk of the task's distinct texts."""
    seen: set[int] = set()
    chunk, held = [], 0

    def frequent() -> pa.RecordBatch:
        x = np.concatenate(chunk)
        chunk.clear()
        x.sort()
        least = 2 + 2 * len(x) // CHUNK
        often = x[least - 1 :] == x[: len(x) - least + 1]
        often[1:] &= x[1 : len(often)] != x[: len(often) - 1]  # where each begins
        token = x[: len(often)][often]
        n = np.searchsorted(x, token, "right") - np.flatnonzero(often)
        token = token.view(np.int64)
        none = pa.nulls(len(n))
        return batch_of(_SKETCHES, [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.list_(pa.int64())), token, n])

    for batch in batches:
        for some in slices(batch, "text"):
            node, sets = shingle_sets(some.column("text"))
            rows = len(sets)
            sketches = [_sketch(x).view(np.int64) for x in sets]
            none = pa.nulls(rows, pa.int64())
            yield batch_of(_SKETCHES, [some.column("key"), node.view(np.int64), np.array([len(x) for x in sets], np.int32), sketches, none, none])
            for name, x in zip(node.tolist(), sets):
                if len(x) and name not in seen:
                    seen.add(name)
                    chunk.append(x)
                    held += len(x)
            if len(seen) > 1_000_000:
                seen.clear()
            if held >= CHUNK:
                yield frequent()
                held = 0
    if held:
        yield frequent()


def _filled(*tables: DataFrame) -> list[np.ndarray]:
    """A filter of FILTER_BITS bits from each table of (word, bit), all in one job."""
    n = FILTER_BITS // 64
    filled = np.zeros(n * len(tables), np.int64)
    words = reduce(DataFrame.unionByName, [table.withColumn("word", F.col("word") + k * n) for k, table in enumerate(tables)])
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER_BITS / 64 rows a table
    filled[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return np.split(filled.view(np.uint64), len(tables))


def _bits_of(key: np.ndarray) -> pa.RecordBatch:
    place = np.unique(_filter_places(key))
    word, bit = place >> 6, np.left_shift(np.uint64(1), (place & 63).astype(np.uint64))
    start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    bits = np.bitwise_or.reduceat(bit, start) if len(start) else bit
    return batch_of(_SET_BITS, [word[start], bits.view(np.int64)])


def _wanted(nodes: DataFrame) -> np.ndarray:
    """A filter of the values of a column `node`."""
    return _filled(_wanted_bits(nodes))[0]


def _wanted_bits(nodes: DataFrame) -> DataFrame:
    """(word, bit) of that filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _bits_of(batch.column("node").to_numpy().view(np.uint64))

    return nodes.select("node").mapInArrow(run, _SET_BITS)


def _filter_places(key: np.ndarray) -> np.ndarray:
    return (mix(key) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _in_filter(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = _filter_places(key)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _owned(node: np.ndarray, key: pa.Array) -> np.ndarray:
    """One value for a node and a key, null included."""
    low = key.fill_null(0).to_numpy().view(np.uint64)
    missing = np.asarray(key.is_null().to_numpy(zero_copy_only=False)).astype(np.uint64)
    return mix(node ^ mix(low * np.uint64(2) + missing + np.uint64(0x632BE59BD9B4E019)))


def _owner_bits(nodes: DataFrame) -> DataFrame:
    """(word, bit) of a filter of (node, smallest key): copies of a text that pass it by need not be looked at again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _bits_of(_owned(batch.column("node").to_numpy().view(np.uint64), batch.column("key")))

    return nodes.select("node", "key").mapInArrow(run, _SET_BITS)


def _cut_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top bits of all shingles of a task: a bucket, in it 31 bits more, and whether a set needs it as the smaller of two."""
    held, size = [], 0

    def runs() -> pa.RecordBatch:
        key = np.concatenate(held)
        held.clear()
        key.sort()
        # Two of a kind say it all, however many sets of the task hold the shingle.
        key = key[np.concatenate([np.ones(min(2, len(key)), bool), key[2:] != key[:-2]])]
        bucket = (key >> np.uint64(32)).astype(np.int32)
        start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        low = key.astype(np.uint32)
        offsets = np.append(start, len(key)).astype(np.int32) * 4
        data = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(low)])
        return batch_of(_RUNS, [bucket[start], data])

    for batch in batches:
        tokens = batch.column("tokens")
        inner = _inner(batch, np.diff(tokens.offsets.to_numpy())).astype(np.uint64)
        held.append(tokens.flatten().to_numpy().view(np.uint64) >> np.uint64(64 - 31 - BUCKET_BITS) << np.uint64(1) | inner)
        size += len(inner)
        if size >= CHUNK:
            yield runs()
            size = 0
    if size:
        yield runs()


def _met_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filter bits of the cut keys that come twice or more, needed by one set at least; all runs of a bucket are in one task."""
    runs: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("low").to_pylist()):
            runs.setdefault(bucket, []).append(np.frombuffer(data, np.uint32))
    for bucket, parts in runs.items():
        low = np.sort(np.concatenate(parts))
        # The last of a kind says whether any is needed.
        twice = low[1:][(low[1:] >> 1 == low[:-1] >> 1) & (low[1:] & 1 == 1)] >> 1
        if len(twice):
            yield _bits_of((np.uint64(bucket) << np.uint64(31)) | np.unique(twice).astype(np.uint64))


def _second_pass(shared, percent: int):
    """For each distinct text of a task: the shingles of its matrix rows, and the whole set where it is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, times, bits, owners = shared.value
        marks = np.zeros(1 << 22, bool)
        marks[frequent >> np.uint64(42)] = True
        seen: set[int] = set()
        for batch in batches:
            for some in slices(batch, "text"):
                node, sets = shingle_sets(some.column("text"))
                wanted, rows = _in_filter(bits, node), []
                owner = _in_filter(owners, _owned(node, some.column("key")))
                for row, name in enumerate(node.tolist()):
                    x = sets[row]
                    if not len(x) or not owner[row] or name in seen:
                        continue
                    seen.add(name)
                    n = len(x)
                    least = 1 + n // 50
                    inner = n - -(-2 * percent * n // (100 + percent)) + least
                    first = n - -(-percent * n // 100) + least
                    # Frequent ones go behind the others, the most frequent last.
                    maybe = np.flatnonzero(marks[x >> np.uint64(42)])
                    if len(maybe):
                        at = np.minimum(np.searchsorted(frequent, x[maybe]), len(frequent) - 1)
                        hit = frequent[at] == x[maybe]
                        maybe, count = maybe[hit], times[at[hit]]
                    if len(maybe):
                        rare = np.ones(n, bool)
                        rare[maybe] = False
                        order = np.concatenate([np.flatnonzero(rare), maybe[np.lexsort((x[maybe], count))]])[:first]
                        tokens = x[order]
                    else:
                        tokens = x[:first]
                    rows.append((node[row].view(np.int64), n, least, inner, tokens.view(np.int64), x.view(np.int64) if wanted[row] else None))
                if len(seen) > 1_000_000:
                    seen.clear()
                if rows:
                    yield batch_of(_PREFIXES, [list(c) for c in zip(*rows)])

    return run


def _inner(batch: pa.RecordBatch, per_row: np.ndarray) -> np.ndarray:
    """Which of the batch's shingles are among the first ones that a set needs as the smaller of two."""
    place = np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return place < np.repeat(batch.column("inner").to_numpy(), per_row)


def _cells(shared, grouped: bool):
    """(token, node, size) for the first shingles that the filter lets through, of nodes that the other filter has, or of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, groups = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(_in_filter(groups, batch.column("node").to_numpy().view(np.uint64)) == grouped))
            tokens = batch.column("tokens")
            flat, per_row = tokens.flatten().to_numpy(), np.diff(tokens.offsets.to_numpy())
            use = _in_filter(met, flat.view(np.uint64) >> np.uint64(64 - 31 - BUCKET_BITS))
            inner = _inner(batch, per_row)[use]
            row = np.repeat(np.arange(batch.num_rows), per_row)[use]
            yield batch_of(_CELLS, [flat[use], *[batch.column(c).to_numpy()[row] for c in ("node", "n")], inner])

    return run


def _whole_sets(shared):
    """The sets that the filter asks for, whole and cut to SHORT_BITS a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bits, owners), seen = shared.value, set()
        for batch in batches:
            for some in slices(batch, "text"):
                node, sets = shingle_sets(some.column("text"))
                rows = []
                for row in np.flatnonzero(_in_filter(bits, node) & _in_filter(owners, _owned(node, some.column("key")))).tolist():
                    name, x = int(node[row]), sets[row]
                    if len(x) and name not in seen:
                        seen.add(name)
                        short = np.unique(x >> np.uint64(64 - SHORT_BITS)).astype(np.uint16).view(np.int16)
                        rows.append((node[row].view(np.int64), len(x), short, x.view(np.int64)))
                if len(seen) > 1_000_000:
                    seen.clear()
                if rows:
                    yield batch_of(_SETS, [list(c) for c in zip(*rows)])

    return run


def _only(shared, column: str = "node", inside: bool = True):
    """Rows whose node the filter lets through, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_filter(shared.value, batch.column(column).to_numpy().view(np.uint64)) == inside))

    return run


def _linked(x, y, percent: int):
    """Whether two arrays of distinct shingles are as similar as asked."""
    shared = F.size(F.array_intersect(x, y))
    return shared * 100 >= percent * (F.size(x) + F.size(y) - shared)


def _near_size(n, m, percent: int):
    return F.least(n, m) * 100 >= percent * F.greatest(n, m)


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Of each row: its key, n_shingles, class_id (smallest key of its exact copies) and component_id (of all linked)."""
    spark = docs.sparkSession
    spark_context = spark.sparkContext
    folder = scratch_path(spark, "ngram-join")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    texts = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    first = stored(texts.mapInArrow(_first_pass, _SKETCHES), "sketches")
    rows = first.filter("node IS NOT NULL")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("key").alias("key"))
    nodes = stored(nodes, "nodes")

    # Groups: stars around the most central nodes of sketch values.
    keyed = nodes.select("node", "n", F.explode(F.array_distinct("sketch")).alias("value"))
    shared_values = keyed.groupBy("value").agg(F.count("*").alias("times")).filter("times > 1")
    keyed = stored(keyed.join(shared_values, "value"), "values")
    central = keyed.groupBy("node").agg(F.sum("times").alias("central"))
    best = F.max(F.struct("central", (-F.col("node").cast("decimal(20,0)")).alias("minus"), "node", "n")).alias("best")
    heads = keyed.join(central, "node").groupBy("value").agg(best).select("value", F.col("best.node").alias("head"), F.col("best.n").alias("m"))
    agreed = keyed.join(heads, "value").filter((F.col("node") != F.col("head")) & _near_size(F.col("n"), F.col("m"), percent))
    agreed = agreed.groupBy("node", "head").agg(F.count("*").alias("agree"))
    tried = stored(agreed.filter(F.col("agree") >= AGREE).select("node", "head"), "tried")

    counted = first.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times")).filter(F.col("times") >= FREQUENT)
    often = counted.orderBy(F.desc("times"), "shingle").limit(KNOWN_FREQUENT).toArrow()
    frequent = often.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(frequent)
    ends = tried.select("node").unionByName(tried.select(F.col("head").alias("node")))
    wanted, owners = _filled(_wanted_bits(ends), _owner_bits(nodes))
    # KNOWN_FREQUENT pairs and twice FILTER_BITS bits at most; copies on the executors go as soon as the rows are stored.
    shared = spark_context.broadcast((frequent[order], often.column("times").to_numpy()[order], wanted, owners))
    second = stored(texts.mapInArrow(_second_pass(shared, percent), _PREFIXES), "prefixes")
    shared.destroy()

    sets = second.filter("whole IS NOT NULL").select("node", "whole")
    stars = stored(_tried(sets, tried, percent), "stars")
    groups = stored(components(stars), "groups")

    # Shingles that two nodes or more have among their first ones; no other can be in two groups' rows of the matrix.
    # They meet as sorted runs of cut keys, four bytes a shingle; what the cut confuses, the exact keys below part again.
    packed = second.select("tokens", "inner").mapInArrow(_cut_keys, _RUNS)
    met = packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket").mapInArrow(_met_twice, _SET_BITS)
    bits = spark_context.broadcast(tuple(_filled(met, _wanted_bits(groups))))
    one = second.select("node", "n", "inner", "tokens")
    # Only rows of nodes in groups look for their group.
    some = one.mapInArrow(_cells(bits, grouped=True), _CELLS).join(groups, "node", "left").withColumn("grp", F.coalesce("label", "node"))
    some = some.select("token", "grp", "node", "n", "inner").unionByName(one.mapInArrow(_cells(bits, grouped=False), _CELLS).withColumn("grp", F.col("node")))
    # The matrix itself. Copies that several tasks saw fall together here, and so do the members of a group.
    order = F.xxhash64("node", F.pmod("token", F.lit(ORDERS)))
    cells = some.repartition("token").groupBy("token", "grp").agg(
        F.min_by("node", order).alias("node"), F.count("*").alias("members"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max("inner").alias("inner")
    )
    cells = stored(cells.withColumn("times", F.count("*").over(Window.partitionBy("token"))).filter("times > 1").select(*_MATRIX.names), "cells")
    bits.destroy()
    near_copies = _crowds(texts, cells, owners, percent, stored)
    if near_copies is not None:
        groups = stored(components(_stars(groups).unionByName(near_copies)), "joined")
        cells = _joined(cells, near_copies, groups, stored)
    other = cells.select("token", *[F.col(c).alias(f"{c}2") for c in ("grp", "least_n", "most_n")])
    # The group of the smaller set on the left. Sizes must be able to come near.
    near = (F.col("most_n2") >= F.col("least_n")) & (F.col("least_n2") * percent <= F.col("most_n") * 100)
    met = cells.filter("inner").join(other, "token").filter((F.col("grp") != F.col("grp2")) & near)
    met = met.groupBy("grp", "grp2").agg(F.count("*").alias("n"), F.min("least_n").alias("least_n")).filter("n >= 1 + least_n div 50")
    candidates = met.select(F.least("grp", "grp2").alias("grp"), F.greatest("grp", "grp2").alias("grp2")).distinct()
    candidates = stored(candidates, "candidates")

    labels = groups
    if not candidates.isEmpty():
        labels = components(_stars(groups).unionByName(_open(spark, texts, nodes, groups, candidates, owners, percent, stored)))

    # Smallest key of every component.
    of_node = nodes.select("node", "key").join(labels, "node", "left").select("node", F.col("key").alias("class_id"), F.coalesce("label", "node").alias("label"))
    smallest = of_node.groupBy("label").agg(F.min("class_id").alias("component_id"))
    of_node = of_node.join(smallest, "label").select("node", "class_id", "component_id")
    result = rows.select("key", F.when(F.col("n") > 0, F.col("node")).alias("node"), F.col("n").cast("long").alias("n_shingles"))
    result = result.join(of_node, "node", "left")
    return result.select(
        F.col("key").alias(key), "n_shingles", F.coalesce("component_id", "key").alias("component_id"), F.coalesce("class_id", "key").alias("class_id")
    )


def _stars(groups: DataFrame) -> DataFrame:
    """Links (a, b) that make the same groups again: of each member to the node that names it."""
    return groups.select(F.col("node").alias("a"), F.col("label").alias("b"))


def _tried(sets: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the pairs (node, head) tried, by the whole sets of both; `sets` has hardly more than their ends."""
    broadcast, kind = sets.sparkSession.sparkContext.broadcast, record(node="long", whole="[long]")
    of_heads = sets.mapInArrow(_only(broadcast(_wanted(tried.select(F.col("head").alias("node"))))), kind)
    pairs = tried.join(sets.withColumnRenamed("whole", "x"), "node")
    pairs = pairs.join(of_heads.select(F.col("node").alias("head"), F.col("whole").alias("y")), "head")
    return pairs.filter(_linked(F.col("x"), F.col("y"), percent)).select(F.col("node").alias("a"), F.col("head").alias("b"))


def _crowds(texts: DataFrame, cells: DataFrame, owners: np.ndarray, percent: int, stored) -> DataFrame | None:
    """Links of groups that hold a shingle with more than CROWD others to the largest of these. None without a crowd.

    A node tries one member for each crowded shingle, the first that has it in one of ORDERS orders, which the shingle's bits name:
    a member of a family that is not near its centre is near some others.
    """
    crowded = cells.filter(F.col("times") > CROWD)
    largest = F.max(F.struct("members", F.col("grp").alias("of"), F.col("node").alias("head"))).alias("most")
    heads = crowded.groupBy("token").agg(largest).filter("most.members > 1").select("token", "most.of", "most.head")
    met = crowded.join(heads, "token").filter("grp <> of").select("grp", "node", "of", "head", "least_n")
    met = stored(met, "crowds")
    enough = met.groupBy("grp", "of").agg(F.count("*").alias("n"), F.min("least_n").alias("least_n")).filter("n >= 1 + least_n div 50")
    tried = met.join(enough.select("grp", "of"), ["grp", "of"]).select("node", "head").distinct()
    tried = stored(tried, "crowds-tried")
    if tried.isEmpty():
        return None
    ends = _wanted(tried.select("node").unionByName(tried.select(F.col("head").alias("node"))))
    shared = tried.sparkSession.sparkContext.broadcast((ends, owners))
    sets = stored(texts.mapInArrow(_whole_sets(shared), _SETS).select("node", "n", "whole").dropDuplicates(["node"]), "crowd-sets")
    shared.destroy()
    sizes = sets.select("node", "n")
    near = tried.join(sizes, "node").join(sizes.select(F.col("node").alias("head"), F.col("n").alias("m")), "head")
    near = near.filter(_near_size(F.col("n"), F.col("m"), percent)).select("node", "head")
    return stored(_tried(sets.select("node", "whole"), near, percent), "near-copies")


def _joined(cells: DataFrame, near_copies: DataFrame, after: DataFrame, stored) -> DataFrame:
    """Cells with the groups that links of near copies joined; rows of other groups are not shuffled.

    A group is named by a member, so that what this is in now is what the group is in.
    """
    some = after.join(near_copies.select(F.col("a").alias("node")).distinct(), "node").select("label").distinct()
    moved = stored(after.join(some, "label").select(F.col("node").alias("grp"), "label"), "moved")
    bits = cells.sparkSession.sparkContext.broadcast(_wanted(moved.select(F.col("grp").alias("node"))))
    rest = cells.mapInArrow(_only(bits, "grp", inside=False), _MATRIX)
    there = cells.mapInArrow(_only(bits, "grp"), _MATRIX).join(moved, "grp", "left").withColumn("grp", F.coalesce("label", "grp"))
    there = there.groupBy("token", "grp").agg(F.min("least_n").alias("least_n"), F.max("most_n").alias("most_n"), F.max("inner").alias("inner"))
    return there.unionByName(rest.select(*there.columns))


def _open(
    spark, texts: DataFrame, nodes: DataFrame, groups: DataFrame, candidates: DataFrame, owners: np.ndarray, percent: int, stored
) -> DataFrame:
    """Links (a, b) between members of candidate groups."""
    broadcast = spark.sparkContext.broadcast
    members = nodes.select("node", "n").join(groups, "node", "left").select("node", "n", F.coalesce("label", "node").alias("grp"))
    chosen = candidates.select("grp").unionByName(candidates.select(F.col("grp2").alias("grp"))).distinct()
    members = stored(members.join(chosen, "grp"), "members")
    sizes = members.groupBy("grp").agg(F.count("*").alias("members"), F.min("n").alias("least_n"), F.max("n").alias("most_n"))
    other = sizes.select(*[F.col(c).alias(f"{c}2") for c in sizes.columns])
    sized = candidates.join(sizes, "grp").join(other, "grp2")
    # No member of one can be near in size to one of the other if not even the ranges come near.
    apart = (F.col("most_n") * 100 < percent * F.col("least_n2")) | (F.col("most_n2") * 100 < percent * F.col("least_n"))
    fewer = F.col("members") <= F.col("members2")
    asked = sized.filter(~apart).select(
        F.when(fewer, F.col("grp")).otherwise(F.col("grp2")).alias("grp"), F.when(fewer, F.col("grp2")).otherwise(F.col("grp")).alias("other")
    )
    asked = stored(asked, "asked")
    sides = members.join(asked.select("grp").unionByName(asked.select(F.col("other").alias("grp"))).distinct(), "grp")
    shared = broadcast((_wanted(sides), owners))
    sets = stored(texts.mapInArrow(_whole_sets(shared), _SETS), "sets")
    shared.destroy()

    # Overlap of each query with the union of the other group's shingles, both cut short: what the cut confuses adds to it.
    counted = members.join(sizes.select("grp", "members"), "grp")
    short = stored(sets.select("node", "short").join(counted, "node").dropDuplicates(["node"]), "short")
    one = short.filter("members = 1").select(F.col("grp").alias("other"), F.col("short").alias("union"))
    many = short.filter("members > 1").select(F.col("grp").alias("other"), F.explode("short").alias("t"))
    many = many.distinct().groupBy("other").agg(F.collect_set("t").alias("union"))  # at most 2^SHORT_BITS
    bound = asked.join(short.select("node", "grp", "n", "short"), "grp").join(one.unionByName(many), "other")
    overlap = lambda other: F.size(F.array_intersect("short", other)) + F.col("n") - F.size("short")
    opened = bound.filter(overlap("union") * 100 >= percent * F.col("n")).select("node", "n", "short", "other")

    # Each query against the members of the groups opened for it: their short sets first, what is left exactly.
    inside = short.select(F.col("grp").alias("other"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("short").alias("short2"))
    near = _near_size(F.col("n"), F.col("m"), percent) & (overlap("short2") * (100 + percent) >= percent * (F.col("n") + F.col("m")))
    pairs = stored(opened.join(inside, "other").filter(near).select("node", "b"), "pairs")
    bits = _wanted(pairs.select("node").unionByName(pairs.select(F.col("b").alias("node"))))
    whole = sets.select("node", "whole").mapInArrow(_only(broadcast(bits)), record(node="long", whole="[long]")).dropDuplicates(["node"])
    compared = pairs.join(whole.withColumnRenamed("whole", "x"), "node")
    compared = compared.join(whole.select(F.col("node").alias("b"), F.col("whole").alias("y")), "b")
    return stored(compared.filter(_linked(F.col("x"), F.col("y"), percent)).select(F.col("node").alias("a"), "b"), "links")


def keep_one(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` without near copies: of each component the first row stays. Rows without a word all stay.

    Rows are numbered and written once: a second reading might deal files, and so numbers, to the tasks in another way.
    """
    spark, row = docs.sparkSession, "__row"
    while row in docs.columns:
        row += "_"
    path = scratch_path(spark, "ngram-rows")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    stays = link(numbered, row, text, percent).filter(F.col(row) == F.col("component_id")).select(row)
    return numbered.join(stays, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
