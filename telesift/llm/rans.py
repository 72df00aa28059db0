"""Token ids in binary blocks, coded by a static range asymmetric numeral system.

One frequency table, of all ids of the corpus, serves every block. A block holds the ids of some documents in order and
decodes without any other block; it is cut into segments that start from a checkpoint (place in the words and coder states)
and so decode without each other, each under a checksum of its ids.

Coding is interleaved: LANES coders take ids in turn and write 32-bit words into one run, so that each step is array
arithmetic over all lanes. Decoding reads the words in the order in which the lanes need them.

Block, all numbers little-endian:
    magic "TSR1" | documents u32 | ids u64 | segments u32 | table bits u8, 3 zero bytes
    per document: number of ids u32
    per segment: ids u32 | words u32 | crc32 of its ids as u32 | lanes u32 | lane states u64 each
    the segments' words, u32 each
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"TSR1"
LANES = 1024
SEGMENT_IDS = 1 << 18
_HEAD = struct.Struct("<4sIQIBxxx")
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Ids that occur, their frequencies (which add up to 2^bits) and the sums before each."""

    ids: np.ndarray
    freq: np.ndarray
    before: np.ndarray
    bits: int

    @staticmethod
    def of_counts(ids: np.ndarray, counts: np.ndarray) -> Table:
        """Every id that occurs gets 1 at least; what rounding leaves over goes to or comes from the most frequent."""
        order = np.argsort(ids)
        ids, counts = np.asarray(ids, np.uint32)[order], np.asarray(counts, np.float64)[order]
        if not len(ids):
            return Table(ids, np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0)
        bits = max(20, int(len(ids)).bit_length() + 4)
        freq = np.maximum(1, np.floor(counts / counts.sum() * (1 << bits))).astype(np.int64)
        over = int(freq.sum()) - (1 << bits)
        for i in np.argsort(-freq, kind="stable"):
            if over == 0:
                break
            # Down to half of a frequency at most at once; up as far as need be.
            change = min(over, int(freq[i]) // 2) if over > 0 else over
            freq[i] -= change
            over -= change
        freq = freq.astype(np.uint64)
        return Table(ids, freq, np.cumsum(freq) - freq, bits)

    def place_of(self) -> np.ndarray:
        """For every id up to the largest its place in the table, or -1."""
        out = np.full(int(self.ids.max()) + 1 if len(self.ids) else 0, -1, np.int32)
        out[self.ids] = np.arange(len(self.ids), dtype=np.int32)
        return out

    def places(self) -> np.ndarray:
        """For every slot the place of its id in the table."""
        return np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(np.int64))


def _encode_segment(symbols: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """(lane states, words in reading order) of ids given as places in the table."""
    lanes = min(LANES, len(symbols))
    states = np.full(lanes, _LOW, np.uint64)
    bits, out = np.uint64(table.bits), []
    freq, before = table.freq[symbols], table.before[symbols]
    for a in range((len(symbols) - 1) // lanes * lanes, -1, -lanes):
        f, c = freq[a : a + lanes], before[a : a + lanes]
        x = states[: len(f)]
        full = np.flatnonzero(x >= f << (np.uint64(63) - bits))
        if len(full):
            # The decoder comes back to these words lane by lane.
            out.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            x[full] >>= _WORD
        whole = x // f
        states[: len(f)] = (whole << bits) + (x - whole * f) + c
    return states, np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)


def _decode_segment(states: np.ndarray, words: np.ndarray, n: int, table: Table, places: np.ndarray) -> np.ndarray:
    states, lanes, at = states.copy(), len(states), 0
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    symbols = np.empty(n, np.uint32)
    for a in range(0, n, lanes):
        x = states[: min(lanes, n - a)]
        slot = x & mask
        place = places[slot]
        symbols[a : a + len(x)] = place
        x = table.freq[place] * (x >> bits) + slot - table.before[place]
        empty = np.flatnonzero(x < _LOW)
        if len(empty):
            x[empty] = (x[empty] << _WORD) | words[at : at + len(empty)]
            at += len(empty)
        states[: len(x)] = x
    if at != len(words) or (states != _LOW).any():
        raise ValueError("a segment doesn't end where its coder began")
    return symbols


def encode_block(ids: np.ndarray, lengths: np.ndarray, table: Table) -> bytes:
    """A block of documents with `lengths` ids each."""
    place_of = table.place_of()
    if len(ids) and (int(ids.max()) >= len(place_of) or (places := place_of[ids]).min() < 0):
        raise ValueError("an id is not in the frequency table")
    heads, bodies = [], []
    for a in range(0, len(ids), SEGMENT_IDS):
        some = np.ascontiguousarray(ids[a : a + SEGMENT_IDS], "<u4")
        states, words = _encode_segment(places[a : a + SEGMENT_IDS], table)
        heads.append(struct.pack("<IIII", len(some), len(words), zlib.crc32(some), len(states)) + states.astype("<u8").tobytes())
        bodies.append(words.astype("<u4").tobytes())
    head = _HEAD.pack(MAGIC, len(lengths), len(ids), len(heads), table.bits)
    return b"".join([head, np.asarray(lengths).astype("<u4").tobytes(), *heads, *bodies])


@dataclass(frozen=True)
class Block:
    """A block's parts: lengths of its documents, and (ids, words, crc32, states) of its segments with the words' places."""

    data: bytes
    lengths: np.ndarray
    segments: list[tuple[int, int, int, np.ndarray, int]]

    @staticmethod
    def parse(data: bytes) -> Block:
        magic, docs, ids, count, _ = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = _HEAD.size
        lengths = np.frombuffer(data, "<u4", docs, at)
        at += 4 * docs
        heads = []
        for _ in range(count):
            n, words, crc, lanes = struct.unpack_from("<IIII", data, at)
            heads.append((n, words, crc, np.frombuffer(data, "<u8", lanes, at + 16).astype(np.uint64)))
            at += 16 + 8 * lanes
        segments = []
        for n, words, crc, states in heads:
            segments.append((n, words, crc, states, at))
            at += 4 * words
        if at != len(data) or int(lengths.sum()) != ids or sum(s[0] for s in segments) != ids:
            raise ValueError("a block is cut short")
        return Block(data, lengths, segments)

    def segment(self, k: int, table: Table, places: np.ndarray) -> np.ndarray:
        """The ids of one segment, from its checkpoint."""
        n, count, crc, states, at = self.segments[k]
        words = np.frombuffer(self.data, "<u4", count, at).astype(np.uint64)
        ids = table.ids[_decode_segment(states, words, n, table, places)].astype("<u4")
        if zlib.crc32(ids) != crc:
            raise ValueError("a segment's checksum differs")
        return ids

    def ids(self, table: Table, places: np.ndarray) -> np.ndarray:
        parts = [self.segment(k, table, places) for k in range(len(self.segments))]
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")
