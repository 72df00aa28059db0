"""Context-tree weighting of bytes, each taken as eight binary decisions.

For each of the 255 places in a byte's binary tree there is a tree of contexts: the 0 to D bytes before it, the newest nearest
the root. A node keeps how often bit 0 and bit 1 followed its context. The Krichevsky-Trofimov estimate of a node is
(ones + 1/2) / (all + 1). The weighted probability of all that was seen at a node is half its own estimate's and half the
product of its children's; it follows that, for what comes next, a node's own estimate has the weight 1 / (1 + product of the
children's weighted probabilities / its own estimate's probability of what was seen), and its child the rest. A context that
was never seen says nothing: its parent then has all the rest.

Nodes of the same newest TOP bytes depend on one another only, so each such family is worked out alone; what is above
joins them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 5
TOP = 2


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series eight steps up."""
    x = np.asarray(x, np.float64)
    down = np.zeros_like(x)
    for k in range(8):
        down += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - down


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """Nodes of one depth and one number of bits known: context * 256 + the bits behind a leading 1, in ascending order."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_weighted: np.ndarray | None = None
    own: np.ndarray | None = None
    settled: np.ndarray | None = None
    rest: np.ndarray | None = None

    @property
    def estimate(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)

    def final(self) -> np.ndarray:
        """Probability of a 1 where this is the longest context that was seen."""
        return self.settled + self.rest * self.estimate


def _mask(depth: int) -> np.uint64:
    return np.uint64((1 << (8 * depth + 8)) - 1)


def grams_of_depth(key: np.ndarray, count: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of (context, byte) with the contexts cut to their newest `depth` bytes; keys are context * 256 + byte."""
    cut = key & _mask(depth)
    order = np.argsort(cut, kind="stable")
    cut, count = cut[order], count[order]
    start = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]])) if len(cut) else np.zeros(0, np.int64)
    return cut[start], np.add.reduceat(count, start) if len(start) else np.zeros(0, count.dtype)


def levels_of_depth(key: np.ndarray, count: np.ndarray) -> list[Level]:
    """The eight levels of nodes of one depth, from its sorted grams."""
    byte, context = key & np.uint64(255), key >> np.uint64(8) << np.uint64(8)
    out = []
    for j in range(8):
        node = context | np.uint64(1 << j) | (byte >> np.uint64(8 - j))
        one = (byte >> np.uint64(7 - j)) & np.uint64(1) == 1
        start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
        both = [np.add.reduceat(np.where(one == bit, count, 0).astype(np.float64), start) if len(start) else np.zeros(0) for bit in (False, True)]
        out.append(Level(node[start], *both))
    return out


def weigh(levels: dict[int, list[Level]], depths: range, deepest: int) -> None:
    """Fill in weighted probabilities and own weights, from the longest contexts of `depths` to the shortest.

    The level below depths[-1] must be weighed already, if it isn't `deepest`.
    """
    for depth in reversed(depths):
        for j, level in enumerate(levels[depth]):
            alone = log_estimate(level.zeros, level.ones)
            if depth == deepest:
                level.log_weighted, level.own = alone, np.ones(len(alone))
                continue
            child = levels[depth + 1][j]
            at = np.searchsorted(level.key, child.key & _mask(depth))
            below = np.bincount(at, child.log_weighted, len(level.key))
            more, less = np.maximum(alone, below), np.minimum(alone, below)
            level.log_weighted = more + np.log1p(np.exp(less - more)) - np.log(2)
            level.own = 1 / (1 + np.exp(np.clip(below - alone, -700, 700)))


def settle(levels: dict[int, list[Level]], depths: range) -> None:
    """Fill in what the nodes above have settled and what they leave, from the shortest contexts of `depths` down.

    Nodes of depth 0 have nothing above; the level above depths[0], if there is one, must be settled already.
    """
    for depth in depths:
        for j, level in enumerate(levels[depth]):
            if depth == 0:
                level.settled, level.rest = np.zeros(len(level.key)), np.ones(len(level.key))
                continue
            up = levels[depth - 1][j]
            at = np.searchsorted(up.key, level.key & _mask(depth - 1))
            level.settled = up.settled[at] + up.rest[at] * up.own[at] * up.estimate[at]
            level.rest = up.rest[at] * (1 - up.own[at])


#: Final probabilities are kept as whole 1024ths of their log-odds: both bits' still add up to 1.
_ODDS = 1024


def finals(key: np.ndarray, levels: list[Level]) -> np.ndarray:
    """For each gram the final log-odds of a 1 at the eight nodes it passes, were its context the longest seen."""
    byte, context = key & np.uint64(255), key >> np.uint64(8) << np.uint64(8)
    out = np.empty((len(key), 8), np.int16)
    for j, level in enumerate(levels):
        p = np.clip(level.final()[np.searchsorted(level.key, context | np.uint64(1 << j) | (byte >> np.uint64(8 - j)))], 1e-12, 1 - 1e-12)
        out[:, j] = np.clip(np.round(np.log(p / (1 - p)) * _ODDS), -32767, 32767)
    return out


def log10_of_odds(odds: np.ndarray) -> np.ndarray:
    """log10 probability of the bit that the log-odds speak for."""
    return _LOG10[np.asarray(odds).astype(np.int32) + 32768]


_LOG10 = (-np.logaddexp(0, -np.arange(-32768, 32768) / _ODDS) / np.log(10)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """For scoring: of each depth the grams that were seen, in order, and their `finals`."""

    grams: list[tuple[np.ndarray, np.ndarray]]

    @property
    def depth(self) -> int:
        return len(self.grams) - 1

    def table(self) -> HashTable:
        """log10 probabilities of the grams of the longest contexts."""
        key, final = self.grams[-1]
        total = np.zeros(len(key), np.float32)
        for j in range(8):
            total += log10_of_odds(np.where((key >> np.uint64(7 - j)) & np.uint64(1) == 1, final[:, j], -final[:, j]))
        return HashTable(key, total)

    def unseen(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of other grams: each bit by the longest context that was seen at its node, or one half."""
        total = np.zeros(len(gram))
        for j in range(8):
            odds, left = np.zeros(len(gram), np.int16), np.arange(len(gram))
            for depth in range(self.depth, -1, -1):
                key, final = self.grams[depth]
                if not len(key) or not len(left):
                    continue
                # Any gram of this context that agrees in the first j bits of the byte passes the node.
                shift = np.uint64(8 - j)
                want = (gram[left] & _mask(depth)) >> shift
                at = np.minimum(np.searchsorted(key, want << shift), len(key) - 1)
                hit = key[at] >> shift == want
                odds[left[hit]] = final[at[hit], j]
                left = left[~hit]
            total += log10_of_odds(np.where((gram >> np.uint64(7 - j)) & np.uint64(1) == 1, odds, -odds))
        return total


class HashTable:
    """Values by distinct 64-bit keys, looked up for whole arrays: open addressing, a step for all that are still looking."""

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 3 // 2).bit_length())
        self._shift, self._last = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        # The place of a key, or -1.
        self._slot = np.full(1 << bits, -1, np.int32)
        self._keys = keys if len(keys) else np.zeros(1, np.uint64)
        self._values = values if len(keys) else np.zeros(1, values.dtype)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = np.flatnonzero(self._slot[at] < 0)
            place, chosen = np.unique(at[free], return_index=True)
            self._slot[place] = left[free[chosen]]
            stay = np.ones(len(left), bool)
            stay[free[chosen]] = False
            left, at = left[stay], (at[stay] + 1) & self._last

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self._FACTOR) >> self._shift).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value of each key, places of keys that aren't there)."""
        at = self._home(keys)
        slot = self._slot[at]
        out = self._values[slot]
        left = np.flatnonzero((slot < 0) | (self._keys[slot] != keys))
        at, missing = at[left], []
        while len(left):
            gone = self._slot[at] < 0
            missing.append(left[gone])
            left, at = left[~gone], (at[~gone] + 1) & self._last
            slot = self._slot[at]
            hit = (slot >= 0) & (self._keys[slot] == keys[left])
            out[left[hit]] = self._values[slot[hit]]
            left, at = left[~hit], at[~hit]
        return out, np.concatenate(missing) if missing else np.zeros(0, np.int64)


def build(key: np.ndarray, count: np.ndarray, depth: int = DEPTH) -> Model:
    """The whole model in one place, for small corpora and tests."""
    grams = [grams_of_depth(key, count, d) for d in range(depth + 1)]
    levels = {d: levels_of_depth(*g) for d, g in enumerate(grams)}
    weigh(levels, range(depth + 1), depth)
    settle(levels, range(depth + 1))
    return Model([(g[0], finals(g[0], levels[d])) for d, g in enumerate(grams)])
