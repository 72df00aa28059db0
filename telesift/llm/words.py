"""Words of whole Arrow batches at once, as positions and 64-bit hashes.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return; A-Z count as a-z.
A null text has no words. All of it is array arithmetic over the batch's bytes, so that a text of any length costs the same per byte.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: For words without the marks around them: all of ASCII but letters and digits.
NOT_ALPHANUMERIC = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Odd, so that it has an inverse modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: A value for each byte, so that hashes depend on more than sums of codes.
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """doc: the row of each word; start, end: its bytes in `data`; first: where each row's words begin, one more than rows."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """Equal for equal words whatever the batch; words that differ share one with a chance of about 2^-64."""
        return self.span_hashes(self.start, self.end)

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of any runs of bytes: differences of one running sum, cut loose of their place by an inverse power."""
        if not len(start):
            return np.zeros(0, np.uint64)
        total, back = self._sums
        return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))

    @cached_property
    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.data)
        power = np.full(n, _BASE, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power, out=total[1:])
        back = np.full(n, _INVERSE, np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        return total, back


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of a string column, and offsets of its rows in them."""
    data, offsets = raw_bytes(column)
    return _LOWER[data], offsets


def find_words(column: pa.Array, apart: np.ndarray = _SPACE) -> Words:
    """Words of each row; `apart` says which bytes are between words."""
    data, offsets = text_bytes(column)
    n, rows = len(data), len(offsets) - 1
    inside = ~apart[data]
    # A row's first byte starts a word, and its end ends one, whatever its neighbours hold.
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1])) if n else np.zeros(0, np.int64)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1 if n else np.zeros(0, np.int64)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(rows), np.diff(first))
    return Words(data, doc, start, end, first)


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Cuts of a batch with about `most` bytes of text each, so that memory doesn't follow the batch; rows stay whole."""
    lengths = batch.column(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(lengths), 0).to_numpy(zero_copy_only=False), np.int64)
    cut = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=0)) if len(sizes) else []
    edges = [0, *[int(i) for i in cut if i > 0], batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
