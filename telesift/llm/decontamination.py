"""Documents that hold benchmark items: BM25 over an inverted index of the items with block maxima, then a check of the words.

Every training passage is a query. A passage is two neighbouring runs of `stride` words, so runs overlap by half and an item
of up to `stride` words lies in one passage whole. Items are taken by length: those of up to MIN_STRIDE words share that stride,
longer ones the next power of two times it, so that a long item makes no passage longer for a short one. BM25 scores are divided by the item's score of itself: 1 means that all
of an item's words are there. All items of at least MIN_SCORE are retrieved, in three steps that lose none:
    the sum of its words' largest weights in any item must reach the bound (else the passage is done with);
    so must, for a block of items, the sum of the words' largest weights in the block; only blocks that qualify are opened;
    their items are scored exactly.
So blocks are passed over by their bounds, as in block-max WAND, but for all passages at once by matrix products instead of a
pivot for each. A retrieved item is verified if enough of its question's and enough of its answer's word triples stand in or near the
passage. The answer is an item's last sentence, or the last quarter of its words if it has one sentence only.

How many items hold a word, and how long items are, is counted over all items first. The index is built on the driver for some
ITEM_BYTES of items at a time, and sent to all tasks; more items take more passes over the documents, and each score is the same
in however many. Documents are never shuffled.

Words are runs of letters and digits, lower-cased (A-Z), compared by 64-bit hashes.

Defined results
    Null or empty texts match nothing, nor do items without a word. Items that are alike are found each. Repeated rows are
    searched each. An empty table on either side finds nothing, and nothing is dropped. Of a document's passages with the
    same item the best counts, the first of equals. Columns named like a result are only read, never replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.llm.arrow import batch_of, record
from telesift.llm.words import NOT_ALPHANUMERIC, Words, find_words, mix, slices
from telesift.session import scratch_path

MIN_SCORE = 0.6
MIN_OVERLAP = 0.5
MIN_STRIDE = 64
K1, B = 1.2, 0.75
BLOCK = 4
#: Words in more of the blocks than this share have a dense row of block maxima.
COMMON = 0.25
#: Bounds of passages and blocks worked out at once.
BOUNDS = 1 << 21
ITEM_BYTES = 16 << 20

MATCHES = record(doc_id="long", item_id="long", score="double", question_overlap="double", answer_overlap="double", first_word="long", last_word="long")


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n words in a row."""
    key = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n if len(key) else 0):
        key = mix(key + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : len(hashes) - n + 1 + k]
    return np.unique(key)


def _overlap(part: np.ndarray, near: np.ndarray) -> float:
    """Share of a part's word triples that stand in the words near a passage; a shorter part is one piece."""
    n = min(3, len(part))
    return float(np.isin(_grams(part, n), _grams(near, n)).mean()) if n else 1.0


def _parts(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    sentences = re.split(r"(?<=[.!?])\s+", text.strip())
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = max(0, len(words) - max(1, len(words) // 4))
    return " ".join(words[:cut] or words), " ".join(words[cut:])


def stride_of(words: int) -> int:
    """The stride of items of so many words."""
    stride = MIN_STRIDE
    while stride < words:
        stride *= 2
    return stride


@dataclass(frozen=True)
class Items:
    ids: list[int | None]
    question: list[np.ndarray]
    answer: list[np.ndarray]
    stride: int
    vocabulary: np.ndarray
    #: By term: its largest weight, and its row in `common_max` if it is common, else -1.
    most: np.ndarray
    common: np.ndarray
    #: Largest weights of common terms in each block.
    common_max: np.ndarray
    #: Postings by (term, block), and in these by item.
    term_first: np.ndarray
    post_block: np.ndarray
    post_max: np.ndarray
    post_first: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    blocks: int

    @staticmethod
    def build(rows: list[tuple[int, str]], held: dict[int, int] | None = None, n: int | None = None, mean: float | None = None) -> Items | None:
        """An index of some items: `held` says how many of all `n` items hold a word, `mean` how long these are on average."""
        words = find_words(pa.array([t for _, t in rows], pa.string()), NOT_ALPHANUMERIC)
        lengths = np.diff(words.first)
        if not len(words.doc):
            return None
        vocabulary, term = np.unique(words.hashes().view(np.int64), return_inverse=True)
        pair, tf = np.unique(term * np.int64(len(rows)) + words.doc, return_counts=True)
        term, item = pair // len(rows), pair % len(rows)
        if held is None:
            df, n, mean = np.bincount(term), int((lengths > 0).sum()), lengths[lengths > 0].mean()
        else:
            df = np.array([held[t] for t in vocabulary.tolist()])
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / mean))
        weight /= np.bincount(item, weight, len(rows))[item]
        blocks = -(-len(rows) // BLOCK)
        key = term * np.int64(blocks) + item // BLOCK
        keys, first = np.unique(key, return_index=True)
        most, block_most = np.zeros(len(vocabulary)), np.maximum.reduceat(weight, first)
        np.maximum.at(most, term, weight)
        in_blocks = np.bincount(keys // blocks, minlength=len(vocabulary))
        is_common = in_blocks > max(1, COMMON * blocks)
        common_max = np.zeros((int(is_common.sum()), blocks), np.float32)
        there = is_common[keys // blocks]
        common_max[(np.cumsum(is_common) - 1)[keys[there] // blocks], keys[there] % blocks] = block_most[there]
        parts = [_parts(t or "") for _, t in rows]
        hashed = [[find_words(pa.array([p[k]], pa.string()), NOT_ALPHANUMERIC).hashes() for p in parts] for k in (0, 1)]
        return Items(
            [i for i, _ in rows], *hashed, stride_of(int(lengths.max())), vocabulary, most,
            np.where(is_common, np.cumsum(is_common) - 1, -1), common_max, np.searchsorted(keys // blocks, np.arange(len(vocabulary) + 1)),
            keys % blocks, block_most, np.append(first, len(key)), item, weight, blocks,
        )


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from first to last of each range, and the range of each place."""
    n = last - first
    at = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n), at


def _retrieve(items: Items, bound: float, row: np.ndarray, place: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, passage, item, score) of all passages and items of at least `bound`; words in order of row and place."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)
    if not len(row):
        return none
    # Runs of `stride` words, numbered through all rows with a gap between rows; passage k is runs k and k + 1.
    run = place // items.stride
    base = np.zeros(int(row.max()) + 2, np.int64)
    np.maximum.at(base, row + 1, run + 2)
    base = np.cumsum(base)
    run = run + base[row]
    terms = len(items.vocabulary)
    pairs = np.unique(run * terms + term)
    run, term = pairs // terms, pairs % terms
    runs = int(run.max()) + 2
    total = np.bincount(run, items.most[term], runs)
    alive = total + np.append(total[1:], 0) >= bound - 1e-9
    # A word serves the passage that begins with its run and, but for a row's first run, the one that ends with it.
    later = run > base[np.searchsorted(base, run, "right") - 1]
    passage = np.concatenate([run, run[later] - 1])
    term = np.concatenate([term, term[later]])
    use = alive[passage]
    pairs = np.unique(passage[use] * terms + term[use])
    passage, term = pairs // terms, pairs % terms
    if not len(passage):
        return none
    names, at = np.unique(passage, return_inverse=True)
    begins = np.searchsorted(at, np.arange(len(names) + 1))
    # Bounds of all blocks for some passages at a time: common words by a matrix product, others along their postings.
    step, opened = max(1, BOUNDS // items.blocks), []
    for a in range(0, len(names), step):
        b = min(len(names), a + step)
        some = slice(begins[a], begins[b])
        column = items.common[term[some]]
        is_common = column >= 0
        has = np.zeros((b - a, len(items.common_max)), np.float32)
        has[at[some][is_common] - a, column[is_common]] = 1
        bounds = (has @ items.common_max).astype(np.float64).ravel()
        rare = np.flatnonzero(~is_common)
        posts, of = _spread(items.term_first[term[some][rare]], items.term_first[term[some][rare] + 1])
        bounds += np.bincount((at[some][rare[of]] - a) * items.blocks + items.post_block[posts], items.post_max[posts], len(bounds))
        opened.append(np.flatnonzero(bounds >= bound - 1e-4) + a * items.blocks)
    opened = np.concatenate(opened)
    if not len(opened):
        return none
    # Exact scores in the opened blocks: all words of their passages, the postings of these in the block.
    words, of = _spread(begins[opened // items.blocks], begins[opened // items.blocks + 1])
    block = opened[of] % items.blocks
    lookup = np.repeat(np.arange(terms), np.diff(items.term_first)) * np.int64(items.blocks) + items.post_block
    want = term[words] * np.int64(items.blocks) + block
    found = np.minimum(np.searchsorted(lookup, want), len(lookup) - 1)
    hit = lookup[found] == want
    posts, sub = _spread(items.post_first[found[hit]], items.post_first[found[hit] + 1])
    name = (opened[of[hit]] // items.blocks)[sub]
    key, sum_of = np.unique(name * np.int64(len(items.ids)) + items.item[posts], return_inverse=True)
    score = np.bincount(sum_of, items.weight[posts], len(key))
    good = np.flatnonzero(score >= bound - 1e-9)
    run = names[key[good] // len(items.ids)]
    row = np.searchsorted(base, run, "right") - 1
    return row, run - base[row], key[good] % len(items.ids), score[good]


def _matches(indexes: list[Items], texts: pa.Array, bound: float, overlap: float) -> list[tuple]:
    """(row, item id, score, question overlap, answer overlap, first word, last word) of the verified items of each text."""
    words = find_words(texts, NOT_ALPHANUMERIC)
    hashes = words.hashes()
    return sorted((m for items in indexes for m in _of_length(items, words, hashes, bound, overlap)), key=lambda m: m[0])


def _of_length(items: Items, words: Words, hashes: np.ndarray, bound: float, overlap: float) -> list[tuple]:
    marks = np.zeros(1 << 16, bool)
    marks[items.vocabulary.view(np.uint64) >> np.uint64(48)] = True
    maybe = np.flatnonzero(marks[hashes >> np.uint64(48)])
    key = hashes[maybe].view(np.int64)
    at = np.minimum(np.searchsorted(items.vocabulary, key), len(items.vocabulary) - 1)
    hit = items.vocabulary[at] == key
    maybe, term = maybe[hit], at[hit]
    row = words.doc[maybe]
    found = _retrieve(items, bound, row, maybe - words.first[row], term)
    best: dict[tuple[int, int], tuple] = {}
    for row, passage, item, score in zip(*(x.tolist() for x in found)):
        a, b = int(words.first[row]), int(words.first[row + 1])
        begin, end = a + passage * items.stride, min(b, a + (passage + 2) * items.stride)
        near = hashes[max(a, begin - items.stride) : min(b, end + items.stride)]
        share = [_overlap(part, near) for part in (items.question[item], items.answer[item])]
        if min(share) >= overlap and (score, min(share)) > best.get((row, item), ((-1.0, -1.0),))[0]:
            best[row, item] = ((score, min(share)), row, item, min(score, 1.0), *share, begin - a, end - a - 1)
    return [(row, items.ids[item], *rest) for _, (_, row, item, *rest) in sorted(best.items())]


_COUNTED = record(id="long", text="string", words="long", terms="[long]")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with their number of words, and each of these once."""
    for batch in batches:
        for some in slices(batch, "text"):
            words = find_words(some.column("text"), NOT_ALPHANUMERIC)
            lengths, hashes = np.diff(words.first), words.hashes().view(np.int64)
            terms = [np.unique(hashes[a:b]) for a, b in zip(words.first, words.first[1:])]
            yield batch_of(_COUNTED, [some.column("id"), some.column("text"), lengths, pa.array(terms, pa.list_(pa.int64()))])


def _indexes(items: DataFrame, key: str, text: str) -> Iterator[list[Items]]:
    """Indexes of about ITEM_BYTES of items each time, one for each stride."""
    spark, path = items.sparkSession, scratch_path(items.sparkSession, "items")
    picked = items.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).filter("text IS NOT NULL")
    picked.mapInArrow(_counted, _COUNTED).write.parquet(path)
    counted = spark.read.schema(_COUNTED).parquet(path).filter("words > 0")
    total, n, mean = counted.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)), F.count("*"), F.avg("words")).first()
    passes = max(1, -(-total // ITEM_BYTES))
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("held"))
    for k in range(passes):
        mine = counted.filter(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k)
        known = {r["term"]: r["held"] for r in held.join(mine.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi").collect()}
        by_stride: dict[int, list] = {}
        for r in mine.select("id", "text", "words").orderBy("id", "text").collect():
            by_stride.setdefault(stride_of(r["words"]), []).append((r["id"], r["text"]))
        if by_stride:
            yield [Items.build(rows, known, n, mean) for _, rows in sorted(by_stride.items())]


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """A row for each document and verified item in it; words are counted from 0 and bound the best passage."""
    spark = docs.sparkSession
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = spark.createDataFrame([], MATCHES)
    for indexes in _indexes(items, item_key, item_text):
        shared = spark.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some in slices(batch, "text"):
                    rows = _matches(shared.value, some.column("text"), min_score, min_overlap)
                    ids = some.column("id").to_pylist()
                    named = [(ids[r], *rest) for r, *rest in rows]
                    yield batch_of(MATCHES, [list(c) for c in zip(*named)] if named else [[]] * len(MATCHES))

        out = out.union(picked.mapInArrow(run, MATCHES))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """The rows in which no item is found, in their own columns; rows pass by one by one, so no key is needed."""
    spark = docs.sparkSession
    kinds = docs.schema
    for indexes in _indexes(items, item_key, item_text):
        shared = spark.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some in slices(batch, text):
                    clean = np.ones(some.num_rows, bool)
                    clean[[m[0] for m in _matches(shared.value, some.column(text), min_score, min_overlap)]] = False
                    yield some.filter(pa.array(clean))

        docs = docs.mapInArrow(run, T.StructType(kinds.fields))
    return docs
