"""Documents scored by a context-tree model of the corpus's bytes, beside a word-count baseline.

A text is its words (A-Z as a-z), one blank between two, and an end: the model gives the probability of these bytes, and with
it the code length per byte. At a text's start the bytes before it count as ends.

Learning is a pass over the learning texts that counts words and runs of DEPTH + 1 bytes, merged in each task before they are
shuffled by key. The runs of one family (the same newest two bytes of context) are brought together, and each family's trees
are weighed by themselves (see context_tree.py); the few trees above, of the 65,536 families at most, join them on the driver.

Scoring is a pass over all texts with the model at hand. RUNS_IN_PASS bounds what a pass takes along: a larger model is cut by
families, and each pass scores the bytes whose context is in its families. Of the words' counts, too, only the KNOWN_WORDS most
frequent go along; counts of the others are joined.

Defined results
    A null text is empty: its end alone. Without learning texts every bit has probability one half and no word is known.
    Repeated rows teach and are scored each. An empty table gives no rows. Words are compared by 64-bit hashes. Columns to
    carry that are named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.llm import context_tree as tree
from telesift.llm.arrow import batch_of, record
from telesift.llm.words import find_words, slices
from telesift.session import scratch_path

RUNS_IN_PASS = 3_000_000
KNOWN_WORDS = 1 << 19
#: Runs and words that a task holds before it hands them on.
HELD = 1 << 19
#: Bytes of text taken at once.
SLICE = 1 << 20
#: The end of a text, counted as a word. It is no hash of a word that could be told from any other.
END_WORD = -0x0E2D
RESULT = record(n_tokens="long", n_known="long", train_tokens="long", base_score="double", score="double", bits_per_byte="double")

_COUNTS = record(word="bool", key="long", n="long")
_FAMILY = record(grams="binary", counts="binary", nodes="binary", weights="binary")
_MODEL = record(depth="int", grams="binary", finals="binary")
_MODEL_PART = record(grams="binary", finals="binary")
_SCORED = record(__n="long", __known="long", __base="double", __score="double", __bytes="long", __rare="[long]", __times="[int]")


def _runs(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(run of each byte with the `depth` bytes before it, row of each)."""
    pad = b"\n" * depth
    parts = [pad + b" ".join(text.lower().split()) + b"\n" if text else pad + b"\n" for text in texts.cast(pa.large_binary()).to_pylist()]
    data = np.frombuffer(b"".join(parts), np.uint8)
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    if not len(parts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.zeros(len(data) - depth, np.uint64)
    for k in range(depth + 1):
        key <<= np.uint64(8)
        key |= data[k : len(data) - depth + k]
    # What begins in one text's padding and ends in it, or reaches into the next text, is no run.
    use = np.ones(len(data), bool)
    starts = np.cumsum(n) - n
    for k in range(depth):
        use[starts + k] = False
    return key[use[depth:]], np.repeat(np.arange(len(n)), n - depth)


class _Held:
    """Counts by key, merged as they come."""

    def __init__(self) -> None:
        self.keys, self.counts, self._new = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray) -> None:
        self._new.append(np.unique(keys, return_counts=True))
        if sum(len(x[0]) for x in self._new) > HELD // 2:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[x[0] for x in self._new]])
        counts = np.concatenate([self.counts, *[x[1] for x in self._new]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[start], np.add.reduceat(counts, start) if len(start) else counts
        self._new = []

    def take(self, word: bool) -> pa.RecordBatch:
        self.merge()
        out = batch_of(_COUNTS, [np.full(len(self.keys), word), self.keys, self.counts])
        self.__init__()
        return out


def _counted(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = _Held(), _Held()
        for batch in batches:
            for some in slices(batch, "text", SLICE):
                column = some.column("text")
                grams.add(_runs(column, depth)[0].view(np.int64))
                words.add(np.append(find_words(column).hashes().view(np.int64), np.full(len(column), END_WORD)))
                for held, word in ((words, True), (grams, False)):
                    if len(held.keys) > HELD:
                        yield held.take(word)
        yield words.take(True)
        yield grams.take(False)

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """All runs of a task's families, in order."""
    got = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
    key = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in got]]).view(np.uint64)
    n = np.concatenate([np.zeros(0, np.int64), *[n for _, n in got]])
    order = np.argsort(key)
    return key[order], n[order]


def _weighed(key: np.ndarray, n: np.ndarray, depth: int):
    grams = {d: tree.grams_of_depth(key, n, d) for d in range(tree.TOP, depth + 1)}
    levels = {d: tree.levels_of_depth(*grams[d]) for d in grams}
    tree.weigh(levels, range(tree.TOP, depth + 1), depth)
    return grams, levels


def _families(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = _gather(batches)
        if len(key):
            grams, levels = _weighed(key, n, depth)
            top = levels[tree.TOP]
            nodes, weights = np.concatenate([x.key for x in top]), np.concatenate([x.log_weighted for x in top])
            yield batch_of(_FAMILY, [[x.tobytes()] for x in (*grams[tree.TOP], nodes, weights)])

    return run


def _finished(depth: int, shared):
    """The finals of all runs, given what the trees above leave to each family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = _gather(batches)
        if not len(key):
            return
        grams, levels = _weighed(key, n, depth)
        nodes, settled, rest = shared.value
        for level in levels[tree.TOP]:
            at = np.searchsorted(nodes, level.key)
            level.settled, level.rest = settled[at], rest[at]
        tree.settle(levels, range(tree.TOP + 1, depth + 1))
        for d in range(tree.TOP, depth + 1):
            for a in range(0, len(grams[d][0]), 1 << 19):
                some = grams[d][0][a : a + (1 << 19)]
                yield batch_of(_MODEL, [[d], [some.tobytes()], [tree.finals(some, levels[d]).tobytes()]])

    return run


def _unpacked(rows, *kinds) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, kind), *[np.frombuffer(x, kind) for x in rows.column(k).to_pylist()]]) for k, kind in kinds]


def _learn(spark: SparkSession, grams: DataFrame, depth: int) -> tuple[DataFrame, list[tuple[np.ndarray, np.ndarray]]]:
    """(stored model of depths from TOP on, the grams and finals of the depths above)."""
    family = F.col("key").bitwiseAND(F.lit(0xFFFF00))
    together = grams.select("key", "n").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), family)
    # Bounded by 65,536 contexts of TOP bytes.
    rows = together.mapInArrow(_families(depth), _FAMILY).toArrow()
    key, n, nodes, weights = _unpacked(rows, ("grams", np.uint64), ("counts", np.int64), ("nodes", np.uint64), ("weights", np.float64))
    order = np.argsort(key)
    above = {tree.TOP: (key[order], n[order])}
    for d in range(tree.TOP):
        above[d] = tree.grams_of_depth(key, n, d)
    levels = {d: tree.levels_of_depth(*above[d]) for d in above}
    order = np.argsort(nodes)
    nodes, weights = nodes[order], weights[order]
    for level in levels[tree.TOP]:
        level.log_weighted = weights[np.searchsorted(nodes, level.key)]
    tree.weigh(levels, range(tree.TOP), depth)
    tree.settle(levels, range(tree.TOP + 1))
    top = levels[tree.TOP]
    order = np.argsort(np.concatenate([x.key for x in top]))
    left = tuple(np.concatenate([getattr(x, name) for x in top])[order] for name in ("key", "settled", "rest"))
    path = scratch_path(spark, "context-tree")
    together.mapInArrow(_finished(depth, spark.sparkContext.broadcast(left)), _MODEL).write.parquet(path)
    return spark.read.schema(_MODEL).parquet(path), [(above[d][0], tree.finals(above[d][0], levels[d])) for d in range(tree.TOP)]


def _model_of_pass(stored: DataFrame, above: list, depth: int, k: int, passes: int) -> tree.Model:
    grams = list(above)
    for d in range(tree.TOP, depth + 1):
        rows = stored.filter(F.col("depth") == d).select("grams", "finals").mapInArrow(_of_pass(k, passes), _MODEL_PART).toArrow()
        key, final = _unpacked(rows, ("grams", np.uint64), ("finals", np.int16))
        del rows
        order = np.argsort(key)
        grams.append((key[order], final.reshape(-1, 8)[order]))
    return tree.Model(grams)


def _pass_of(key: np.ndarray, passes: int) -> np.ndarray:
    family = (key >> np.uint64(8)) & np.uint64(0xFFFF)
    return (family * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(passes)


def _of_pass(k: int, passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("grams").to_pylist(), batch.column("finals").to_pylist()):
                key, final = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int16).reshape(-1, 8)
                use = _pass_of(key, passes) == k
                yield batch_of(_MODEL_PART, [[key[use].tobytes()], [final[use].tobytes()]])

    return run


def _scored(shared, depth: int, keep: list[str], k: int, passes: int):
    """Of each row the sum over the bytes of this pass and, in the first, what its words give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, logs, floor, c_end = shared.value
        table, known = model.table(), tree.HashTable(words, np.arange(len(words), dtype=np.int32))
        for batch in batches:
            for some in slices(batch, "__text", SLICE):
                column, rows = some.column("__text"), some.num_rows
                runs, row = _runs(column, depth)
                mine = np.flatnonzero(_pass_of(runs, passes) == k) if passes > 1 else slice(None)
                value, missing = table.look_up(runs[mine])
                value = value.astype(np.float64)
                if len(missing):
                    odd, at = np.unique(runs[mine][missing], return_inverse=True)
                    value[missing] = model.unseen(odd)[at]
                score, size = np.bincount(row[mine], value, rows), np.bincount(row, minlength=rows)
                if k:
                    columns = [np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows), score, np.zeros(rows, np.int64), [[]] * rows, [[]] * rows]
                else:
                    found = find_words(column)
                    hashes, doc = found.hashes(), found.doc
                    place, rare = known.look_up(hashes)
                    there = np.ones(len(hashes), bool)
                    there[rare] = False
                    base = np.bincount(doc[there], logs[place[there]], rows) + np.log10(c_end + 0.5) - floor * (np.diff(found.first) + 1)
                    # The rows' other words, each with how often it comes; their counts are joined.
                    order = np.lexsort((hashes[rare], doc[rare]))
                    h, d = hashes[rare][order].view(np.int64), doc[rare][order]
                    start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, np.int64)
                    offsets = pa.array(np.searchsorted(d[start], np.arange(rows + 1)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (h[start], np.diff(np.append(start, len(h))).astype(np.int32))]
                    n_known = np.bincount(doc[there], minlength=rows) + (c_end > 0)
                    columns = [np.diff(found.first) + 1, n_known, base, score, size, *lists]
                result = batch_of(_SCORED, columns)
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in keep], *result.columns], names=[*keep, *_SCORED.names])

    return run


def score(docs: DataFrame, learn: Column, text: str = "text", carry: tuple[str, ...] = ("doc_id",), depth: int = tree.DEPTH, runs_in_pass: int = RUNS_IN_PASS, known_words: int = KNOWN_WORDS) -> DataFrame:
    """Of each document: the columns to carry and RESULT. `learn` says which rows are learned from."""
    spark = docs.sparkSession
    broadcast = spark.sparkContext.broadcast
    learned = docs.filter(learn).select(F.col(f"`{text}`").cast("string").alias("text"))
    path = scratch_path(spark, "lm-counts")
    counts = learned.mapInArrow(_counted(depth), _COUNTS).groupBy("word", "key").agg(F.sum("n").alias("n"))
    counts.write.partitionBy("word").parquet(path)
    counts = spark.read.schema(_COUNTS).parquet(path)
    words, grams = counts.filter("word"), counts.filter("NOT word")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("key") == END_WORD, F.col("n"))), F.lit(0)).alias("ends")).first()
    total, distinct, c_end = int(size["n"]), int(size["v"]), int(size["ends"])
    floor = float(np.log10(total + 0.5 * (distinct + 1)))

    # The count from which on words are few enough, by eighths of powers of two: some hundred rows.
    scale = F.floor(F.log2("n") * 8).cast("int")
    least, taken = None, 0
    for r in words.groupBy(scale.alias("s")).count().orderBy(F.desc("s")).collect():
        taken += r["count"]
        if taken > known_words:
            break
        least = r["s"]
    is_known = (scale >= least) & (F.col("key") != END_WORD) if least is not None else F.lit(False)
    known = words.filter(is_known).select("key", "n").toArrow()
    rare = words.filter(~is_known & (F.col("key") != END_WORD)).select("key", "n")
    word_keys, word_logs = known.column("key").to_numpy().view(np.uint64), np.log10(known.column("n").to_numpy() + 0.5)

    stored, above = _learn(spark, grams, depth)
    runs = grams.count()
    passes = max(1, -(-runs // runs_in_pass))
    keep = [c for c in carry if c.lower() not in RESULT.names]
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    if passes > 1:
        # Several passes are brought together by a number, which is written so that it stays the same.
        number = scratch_path(spark, "lm-numbered")
        picked.withColumn("__number", F.monotonically_increasing_id()).write.parquet(number)
        picked = spark.read.parquet(number)
        keep = [*keep, "__number"]
    fields = [f for f in picked.schema.fields if f.name in keep]
    keep = [f.name for f in fields]
    schema = T.StructType([*fields, *_SCORED.fields])
    part = scratch_path(spark, "lm-scores")
    for k in range(passes):
        shared = broadcast((_model_of_pass(stored, above, depth, k, passes), word_keys, word_logs, floor, c_end))
        picked.mapInArrow(_scored(shared, depth, keep, k, passes), schema).write.parquet(f"{part}/pass={k}")
        shared.unpersist()
    scored = spark.read.schema(schema).parquet(f"{part}/pass=0")
    if passes > 1:
        others = [spark.read.schema(schema).parquet(f"{part}/pass={k}").select("__number", F.col("__score").alias("more")) for k in range(1, passes)]
        rest = others[0]
        for other in others[1:]:
            rest = rest.unionByName(other)
        rest = rest.groupBy("__number").agg(F.sum("more").alias("more"))
        scored = scored.join(rest, "__number").withColumn("__score", F.col("__score") + F.col("more")).drop("more")
    else:
        scored = scored.withColumn("__number", F.monotonically_increasing_id())
    numbered = scratch_path(spark, "lm-numbers")
    scored.write.parquet(numbered)
    scored = spark.read.parquet(numbered)

    each = scored.select("__number", F.explode(F.arrays_zip("__rare", "__times")).alias("w")).select("__number", F.col("w.__rare").alias("key"), F.col("w.__times").alias("times"))
    joined = each.join(rare, "key", "left").groupBy("__number").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("more"),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("times"))), F.lit(0)).alias("also"),
    )
    both = scored.join(joined, "__number", "left")
    return both.select(
        *[F.col(f"`{c}`") for c in keep if c != "__number"],
        F.col("__n").alias("n_tokens"),
        (F.col("__known") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("__base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        F.col("__score").alias("score"),
        (-F.col("__score") / F.lit(float(np.log10(2))) / F.col("__bytes")).alias("bits_per_byte"),
    )
