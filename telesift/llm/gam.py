"""A generalised additive model with pairwise interactions: lookup tables learned by cyclic boosting of shallow trees.

Each feature is cut into bins once. Round after round, every feature in turn gets a tree of two levels on its own bins,
fitted to what is still unexplained, and the tree is added to the feature's table. Then the pairs of features whose joint
bins explain most of the rest get tables in the same way. A score is the sum of one entry of each table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    bins: int = 64
    pair_bins: int = 12
    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 6
    rate: float = 0.1
    min_weight: float = 2.0
    smooth: float = 1.0


@dataclass(frozen=True)
class Model:
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1 / (1 + np.exp(-self.margin(x)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between values, so that bins hold about equally many rows; equal values share a bin."""
    if not len(x):
        return np.zeros(0)
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
    return cuts[cuts > x.min()]


def _split(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[float, int]:
    """Best gain and cut of histograms along their last axis."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + s.smooth) + gr**2 / (hr + s.smooth) - g.sum() ** 2 / (h.sum() + s.smooth)
    gain = np.where((hl >= s.min_weight / 4) & (hr >= s.min_weight / 4), gain, -np.inf)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _leaf(g: np.ndarray, h: np.ndarray, s: Settings) -> float:
    return float(g.sum() / (h.sum() + s.smooth))


def _tree(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    """A tree of two levels over the bins: its value in each."""
    value = np.full(len(g), _leaf(g, h, s))
    _, cut = _split(g, h, s)
    for part in (slice(0, cut), slice(cut, len(g))) if cut else ():
        _, inner = _split(g[part], h[part], s)
        for a, b in ((0, inner), (inner, len(g[part]))) if inner else ((0, len(g[part])),):
            value[part][a:b] = _leaf(g[part][a:b], h[part][a:b], s)
    return value


def _pair_tree(g: np.ndarray, h: np.ndarray, s: Settings) -> tuple[float, np.ndarray]:
    """One cut along either feature, then one along the other on each side."""
    best, out = 0.0, np.full(g.shape, _leaf(g, h, s))
    base = g.sum() ** 2 / (h.sum() + s.smooth)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, gg.shape[0]):
            value, gain = np.empty(gg.shape), -base
            for part in (slice(0, cut), slice(cut, None)):
                pg, ph = gg[part].sum(0), hh[part].sum(0)
                _, inner = _split(pg, ph, s)
                for a, b in ((0, inner), (inner, len(pg))) if inner else ((0, len(pg)),):
                    value[part, a:b] = _leaf(pg[a:b], ph[a:b], s)
                    gain += pg[a:b].sum() ** 2 / (ph[a:b].sum() + s.smooth)
            if gain > best + 1e-9:
                best, out = gain, value.T if flip else value
    return best, out


def fit(x: np.ndarray, y: np.ndarray, s: Settings = Settings()) -> Model:
    """x: rows by features; y: 0 or 1. Without rows the score is one half, with one label only that label's smoothed share."""
    n, k = x.shape
    share = (y.sum() + 1) / (n + 2)
    intercept = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, j], s.bins) for j in range(k)]
    coarse = [_edges(x[:, j], s.pair_bins) for j in range(k)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    empty = Model(edges, intercept, tables, coarse, [], [])
    if n == 0 or y.min() == y.max():
        return empty
    place = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    margin = np.full(n, intercept)
    for _ in range(s.rounds):
        for j in range(k):
            p = 1 / (1 + np.exp(-margin))
            g = np.bincount(place[j], y - p, len(tables[j]))
            h = np.bincount(place[j], p * (1 - p), len(tables[j]))
            step = s.rate * _tree(g, h, s)
            tables[j] += step
            margin += step[place[j]]
    place = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]

    def joint(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        at, p = place[a] * shape[1] + place[b], 1 / (1 + np.exp(-margin))
        size = shape[0] * shape[1]
        return at, np.bincount(at, y - p, size).reshape(shape), np.bincount(at, p * (1 - p), size).reshape(shape)

    gains = sorted(((_pair_tree(*joint(a, b)[1:], s)[0], a, b) for a in range(k) for b in range(a + 1, k)), key=lambda r: (-r[0], r[1:]))
    pairs = [(a, b) for gain, a, b in gains[: s.pairs] if gain > 0]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(s.pair_rounds):
        for (a, b), table in zip(pairs, pair_tables):
            at, g, h = joint(a, b)
            step = s.rate * _pair_tree(g, h, s)[1]
            table += step
            margin += step.ravel()[at]
    return Model(edges, intercept, tables, coarse, pairs, pair_tables)
