"""Quality of documents, scored by a generalised additive model of features of their whole texts.

Features are counted once per text and written; labelled rows are joined to them by key, not to texts. The model is fitted
on the driver on at most MAX_ROWS labelled rows, chosen by a hash of the key, and scoring adds up table entries.

Defined results
    A null text counts as empty; an empty text has all features 0 and a score like any other. Labels of null, or of keys
    without a document, don't count; a key labelled more than once has the larger label, and a document that comes more
    than once teaches once for each row. Without labelled rows every score is 0.5. An empty table gives no rows. Other
    columns come back unchanged, but for those named `score` or `predicted`, which the result takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.llm import gam
from telesift.llm.token_ids import forget_words
from telesift.llm.words import Words, find_words, raw_bytes, slices
from telesift.session import scratch_path

#: Labelled rows that a fit uses at most: the bound of what the driver gets, some 20,000 rows of FEATURES numbers.
MAX_ROWS = 20_000
THRESHOLD = 0.3

FEATURES = (
    "log_words", "bytes_per_word", "upper_share", "digit_share", "symbols_per_word", "exclamations_per_word", "stops_per_word",
    "distinct_share", "commonest_share", "same_as_previous", "words_per_line", "repeated_lines", "other_bytes", "one_byte_words",
)


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(mask), offsets)).astype(np.float64)


def _distinct(key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct keys in each row, and how often its commonest comes."""
    if not len(key):
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((key, row))
    k, r = key[order], row[order]
    start = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])]))
    n = np.diff(np.append(start, len(k)))
    most = np.zeros(rows)
    np.maximum.at(most, r[start], n)
    return np.bincount(r[start], minlength=rows).astype(np.float64), most


def _class(characters: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[[ord(c) for c in characters]] = True
    return mask


_SYMBOLS, _STOPS, _DIGITS = _class("#*$%&|<>=~^_{}[]\\@"), _class(".,;:?"), _class("0123456789")


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    raw, offsets = raw_bytes(texts)
    words: Words = find_words(texts)
    rows, n = len(texts), np.diff(words.first).astype(np.float64)
    over = lambda x, total: np.divide(x, total, out=np.zeros(rows), where=total > 0)
    size = np.bincount(words.doc, weights=words.end - words.start, minlength=rows)
    hashes = words.hashes()
    distinct, most = _distinct(hashes, words.doc, rows)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    # A line's key sums its words' hashes, each times an odd number of its place in the line.
    breaks = np.cumsum(raw == 0x0A)
    line = np.concatenate([[0], breaks])[words.start] if len(raw) else np.zeros(0, np.int64)
    fresh = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])])) if len(line) else np.zeros(0, np.int64)
    place = np.arange(len(hashes)) - np.repeat(fresh, np.diff(np.append(fresh, len(hashes))))
    keys = np.add.reduceat(hashes * (2 * place + 1).astype(np.uint64), fresh) if len(fresh) else np.zeros(0, np.uint64)
    lines = np.bincount(words.doc[fresh], minlength=rows).astype(np.float64)
    lines_distinct, _ = _distinct(keys, words.doc[fresh], rows)
    count = lambda mask: _per_row(mask, offsets)
    upper = count((raw >= 0x41) & (raw <= 0x5A))
    letters = upper + count((raw >= 0x61) & (raw <= 0x7A))
    return np.column_stack([
        np.log1p(n), over(size, n), over(upper, letters), over(count(_DIGITS[raw]), size), over(count(_SYMBOLS[raw]), n),
        over(count(raw == ord("!")), n), over(count(_STOPS[raw]), n), over(distinct, n), over(most, n),
        over(np.bincount(words.doc, weights=again, minlength=rows), n), over(n, lines), over(lines - lines_distinct, lines),
        over(count(raw >= 0x80), size), over(np.bincount(words.doc, weights=words.end - words.start == 1, minlength=rows), n),
    ])


def _featured(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in batches:
            for some in slices(batch, "__text"):
                x = features(some.column("__text"))
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in keep], values], names=[*keep, "__features"])

    return run


def in_fold(key: Column, folds: int = 5) -> Column:
    """Remainder of the crc32 of a key written as text; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def likely_smallest(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Rows among which are those of the `most` smallest hashes of the key: some more than that in all, not that many a partition."""
    n = rows.count()
    share = (1.05 * most + 1000) / max(n, 1)
    return rows if share >= 1 else rows.filter(F.xxhash64(key) <= F.lit(int(share * (1 << 64)) - (1 << 63)))


def _learned(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_rows: int, settings: gam.Settings, keep: list[str]):
    """(the model; keys and columns to keep with the features of each document, as written)."""
    spark = docs.sparkSession
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("__features", T.ArrayType(T.DoubleType()))])
    path = scratch_path(spark, "features")
    picked.mapInArrow(_featured(keep), schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)

    known = labels.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").cast("int").alias("__label")).filter("__label IN (0, 1) AND __key IS NOT NULL")
    known = known.groupBy("__key").agg(F.max("__label").alias("__label"))
    taught = stored.join(known, F.col(f"`{key}`") == F.col("__key")).select("__key", "__features", "__label")
    rows = likely_smallest(taught, "__key", max_rows).orderBy(F.xxhash64("__key"), "__key", "__features").limit(max_rows).collect()
    x = np.array([r["__features"] for r in rows]).reshape(-1, len(FEATURES))
    return gam.fit(x, np.array([r["__label"] for r in rows], np.float64), settings), stored


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    carry: tuple[str, ...] = (), threshold: float = THRESHOLD, max_rows: int = MAX_ROWS, settings: gam.Settings = gam.Settings(),
) -> DataFrame:
    """Of each document: its key, the columns to carry, `score` (probability of label 1) and `predicted`.

    `labels` (key, label) are all that may be learned from: leave held-out rows out of them.
    """
    keep = [key, *[c for c in carry if c != key and c.lower() not in ("score", "predicted")]]
    model, stored = _learned(docs, labels, key, text, label, max_rows, settings, keep)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column("__features").flatten().to_numpy().reshape(-1, len(FEATURES)))
            added = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *added], names=[*keep, "score", "predicted"])

    out = T.StructType([*stored.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return stored.mapInArrow(scored, out)


def drop_rejected(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    threshold: float = THRESHOLD, max_rows: int = MAX_ROWS, settings: gam.Settings = gam.Settings(),
) -> DataFrame:
    """The documents of a score of at least `threshold`, in their own columns; rows pass by one by one, so no join is needed."""
    model, _ = _learned(docs, labels, key, text, label, max_rows, settings, [key])

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in batches:
            for some in slices(batch, text):
                yield some.filter(pa.array(model.score(features(some.column(text))) >= threshold))

    return docs.mapInArrow(good, docs.schema)
