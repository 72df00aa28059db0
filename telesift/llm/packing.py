"""Packing of token runs into as few sequences as possible, by a configuration linear program over the length histogram.

The histogram of piece lengths (at most as many lengths as a sequence has tokens, whatever the corpus) is all that the
program needs. A configuration is a multiset of lengths that fits a sequence. Multiplicative weights solve the covering
program: lengths that are short of their counts weigh more, and a knapsack dynamic program over 1..capacity finds the
configuration of most weight, until every length is covered. The fractional solution is rounded; what is left is placed by best fit into the
rooms that configurations leave open and into new sequences, in decreasing length, on counts as well. The program starts from a
first solution, the configurations that best fit alone makes; what the rounds find takes its place unless it needs more sequences.
Every priced configuration also gives a bound from below: no packing needs fewer sequences than all weight by the most weight of
one. The plan carries the best of these bounds as `least`, so that the gap to the optimum is known.

The plan is a list of runs: pieces number a to b of one length go to as many neighbouring sequences at one offset. Spark
numbers the pieces of each length (in each task, then by offsets of the tasks' counts), and looks each up in the plan.

Defined results
    A null or empty text is its end id alone. A longer document than a sequence is cut into full pieces and a last one.
    Equal lengths are interchangeable; which of them goes where follows from the order of rows in the partitions, and
    every piece has exactly one place. Repeated rows are packed as often as they come. An empty table gives no pieces.
    `pack` carries all columns of its pieces (but for those named like one of ADDED, which the result takes).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.llm.arrow import batch_of, record
from telesift.llm.token_ids import encoder, vocabulary_path
from telesift.llm.words import slices
from telesift.session import scratch_path

CAPACITY = 4096
ADDED = ("sequence_id", "offset")
PIECES = record(doc_id="long", piece="int", start="long", length="long", ids_crc32="long")
_PLACE = record(sequence_id="long", offset="long")


# ---- the plan --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Runs sorted by (length, first): pieces first.. of that length go to sequences sequence.. at `offset`."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    #: No packing has fewer sequences.
    least: int = 0

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = np.int64(44)
        at = np.searchsorted((self.length.astype(np.int64) << bits) + self.first, (length.astype(np.int64) << bits) + number, "right") - 1
        return self.sequence[at] + number - self.first[at], self.offset[at]


def price(values: np.ndarray, capacity: int) -> np.ndarray:
    """The lengths (repeats allowed) of most value that fit the capacity; values[k] is that of length k, 0 if not for use."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    worth = values[1 : capacity + 1]
    for room in range(1, capacity + 1):
        options = worth[:room] + best[room - 1 :: -1]
        k = int(options.argmax())
        best[room] = best[room - 1]
        if worth[k] and options[k] > best[room]:
            best[room], pick[room] = options[k], k + 1
    found, room = [], capacity
    while room > 0:
        if pick[room]:
            found.append(pick[room])
            room -= pick[room]
        else:
            room -= 1
    return np.array(found, np.int64)


def price_counted(values: np.ndarray, counts: np.ndarray, room: int) -> tuple[np.ndarray, float]:
    """The same with no length more often than it is counted: what repeats beyond that leave open is priced again.

    Also the value of a configuration without that limit, which none can exceed.
    """
    values, left, found, most = values.copy(), counts.copy(), [], 0.0
    while room > 0:
        lengths, times = np.unique(price(values[: room + 1], room), return_counts=True)
        if not len(lengths):
            break
        most = most or float((values[lengths] * times).sum())
        times = np.minimum(times, left[lengths])
        found.append(np.repeat(lengths, times))
        left[lengths] -= times
        room -= int((lengths * times).sum())
        values[left <= 0] = 0
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), most


def fractional(counts: np.ndarray, capacity: int, rounds: int, step: float = 1.0) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Configurations and how often each is used, by multiplicative weights: `rounds`, and more until all lengths are covered;
    and the largest bound from below that the weights gave.

    Every round covers the scarcest length of its configuration whole, and one not covered yet is worth more than any that is,
    so that the rounds end after some for each length.
    """
    open_ = np.flatnonzero(counts)
    covered = np.zeros(len(counts))
    used: dict[bytes, float] = {}
    done, least = 0, 0.0
    while done < rounds or covered[open_].min() < 1 - 1e-9:
        # A length's worth is its tokens, less with its share covered so far.
        weight = np.zeros(len(counts))
        weight[open_] = open_ * np.exp(-step * (covered[open_] - covered[open_].min()))
        if done >= rounds:
            # The longest that is uncovered opens the configuration; the room beside it is priced.
            longest = int(open_[covered[open_] < 1 - 1e-9].max())
            beside = counts.copy()
            beside[longest] -= 1
            weight[beside <= 0] = 0
            chosen = np.append(longest, price_counted(weight, beside, capacity - longest)[0])
        else:
            chosen, most = price_counted(weight, counts, capacity)
            least = max(least, float((weight * counts).sum()) / most)
        chosen = np.sort(chosen)[::-1]
        lengths, times = np.unique(chosen, return_counts=True)
        # As often as until the scarcest of its lengths is covered by one unit more.
        amount = float((counts[lengths] / times).min())
        covered[lengths] += amount * times / counts[lengths]
        key = chosen.astype(np.int32).tobytes()
        used[key] = used.get(key, 0.0) + amount
        done += 1
    return [(np.frombuffer(key, np.int32).astype(np.int64), amount) for key, amount in used.items()], least


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = 240) -> Plan:
    """counts[k] pieces of length k. Its work depends on the capacity, not on how many pieces there are; `rounds` are the least."""
    program = np.asarray(counts, np.int64).copy()
    full = int(program[capacity])
    program[capacity] = 0
    first = _rounded(counts, capacity, [])
    used, least = fractional(program, capacity, rounds) if program.any() else ([], 0.0)
    made = _rounded(counts, capacity, used) if used else first
    tokens = int((program * np.arange(len(program))).sum())
    # The bound is a quotient of sums; a little of it goes to their rounding.
    # Of pieces longer than half a sequence no two share one.
    least = full + max(-(-tokens // capacity), int(program[capacity // 2 + 1 :].sum()), int(np.ceil(least * (1 - 1e-9) - 1e-6)))
    return replace(made if made.sequences <= first.sequences else first, least=least)


def _rounded(counts: np.ndarray, capacity: int, used: list[tuple[np.ndarray, float]]) -> Plan:
    """Whole pieces placed by configurations, as far as these go, and the rest by best fit."""
    left = np.asarray(counts, np.int64).copy()
    runs: list[tuple[int, int, int, int]] = []
    done = np.zeros(capacity + 1, np.int64)
    sequences = 0
    #: By room left: runs of neighbouring sequences, (first sequence, how many).
    rooms: dict[int, list[tuple[int, int]]] = {}

    def put(length: int, sequence: int, n: int, offset: int) -> None:
        runs.append((length, int(done[length]), sequence, offset))
        done[length] += n
        left[length] -= n

    def new_sequences(n: int) -> int:
        nonlocal sequences
        sequences += n
        return sequences - n

    if left[capacity]:
        n = int(left[capacity])
        put(capacity, new_sequences(n), n, 0)
    program = left.copy()
    program[capacity] = 0
    if used:
        total = np.zeros(capacity + 1)
        for lengths, amount in used:
            np.add.at(total, lengths, amount)
        scale = np.divide(program, total, out=np.full(capacity + 1, np.inf), where=total > 0)
        # Fullest first, of these the ones of few pieces, as short pieces fit anywhere later; as far as all lengths are left.
        # Full ones are rounded up, others down.
        for lengths, amount in sorted(used, key=lambda x: (-int(x[0].sum()), len(x[0]))):
            kinds, times = np.unique(lengths, return_counts=True)
            often = amount * scale[kinds].min()
            n = int(min(np.ceil(often) if lengths.sum() == capacity else np.floor(often), (left[kinds] // times).min()))
            if n:
                first, offset = new_sequences(n), 0
                for length in lengths.tolist():
                    put(length, first, n, offset)
                    offset += length
                if offset < capacity:
                    rooms.setdefault(capacity - offset, []).append((first, n))
    # Best fit in decreasing length, a run of sequences at a time.
    for length in range(capacity, 0, -1):
        while left[length]:
            room = min((r for r in rooms if r >= length), default=0)
            if room:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
            else:
                room = capacity
                n = -(-int(left[length]) // (capacity // length))
                first = new_sequences(n)
            take = min(n, int(left[length]))
            put(length, first, take, capacity - room)
            for at, m, r in ((first, take, room - length), (first + take, n - take, room)):
                if m and r:
                    rooms.setdefault(r, []).append((at, m))
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4).T
    return Plan(*columns, sequences)


# ---- over a corpus ---------------------------------------------------------------------------------


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for some in slices(batch, "text"):
                ids, n = encode(some.column("text"), end_id)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                per_doc = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), per_doc)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                begin = (np.cumsum(n) - n)[row] + start
                crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(begin.tolist(), length.tolist())]
                keys = some.column("doc_id").take(pa.array(row))
                yield batch_of(PIECES, [keys, piece.astype(np.int32), start, length, np.array(crc, np.int64)])

    return run


def token_pieces(docs: DataFrame, end_id: int, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Each document's ids with an end id, cut into pieces only where it is longer than the capacity."""
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return picked.mapInArrow(_pieces(tokenizer or vocabulary_path(), end_id, capacity), PIECES)


def _numbered(capacity: int):
    """Add the task's number and each row's number among the task's rows of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy()
            order = np.argsort(length, kind="stable")
            run_start = np.searchsorted(length[order], length[order])
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - run_start
            number += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            added = [pa.array(np.full(len(length), part, np.int32)), pa.array(number)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "__part", "__number"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = 240) -> DataFrame:
    """All pieces (a `length` column of 1 to capacity) with the sequence and the offset of each."""
    spark = pieces.sparkSession
    keep = pieces.select(*[F.col(f"`{c}`") for c in pieces.columns if c.lower() not in (*ADDED, "__part", "__number")])
    schema = T.StructType([*keep.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__number", T.LongType())])
    # Written before they are numbered, so that a task has one Python worker at a time: the one that makes the pieces keeps many words.
    path, names = scratch_path(spark, "packing"), keep.columns
    keep.write.parquet(f"{path}/pieces")
    keep = spark.read.schema(keep.schema).parquet(f"{path}/pieces")
    # Written once: numbers and counts must be of the same rows, even if executors are lost in between.
    keep.mapInArrow(_numbered(capacity), schema).write.parquet(f"{path}/numbered")
    stored = spark.read.schema(schema).parquet(f"{path}/numbered")

    by_part = stored.groupBy("length", "__part").agg(F.count("*").alias("n"))
    histogram = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["n"]
    runs = spark.sparkContext.broadcast(plan(counts, capacity, rounds))  # bounded by capacity and rounds

    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    numbered = stored.join(offsets, ["length", "__part"]).select(*[F.col(f"`{c}`") for c in names], (F.col("__before") + F.col("__number")).alias("__number"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("__number").to_numpy()
            sequence, offset = runs.value.place(length, number)
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, *ADDED])

    return numbered.mapInArrow(placed, T.StructType([*keep.schema.fields, *_PLACE.fields]))
