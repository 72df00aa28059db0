"""Ball trees over sparse vectors, searched best-first for the largest inner products.

A node is a ball: the mean of its vectors, and a radius that reaches all of them. No vector of it can have a larger product with
a query than the mean has, plus the query's length times the radius. These bounds are floating-point numbers with the rounding of
every sum behind them added, so they never fall below an exact score; leaves are scored in 64-bit integers.

The vectors' components are weight times impact, a query's are how often it holds a term. Terms that nearly all documents hold
weigh next to nothing, so they widen no ball.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Distinct vectors of a leaf at most.
LEAF = 32
#: Relative rounding of what makes a bound: of the products' sum by its terms, and of the rest.
_ROUND, _ROUND_TERM = 1e-9, 1e-15


@dataclass
class Sparse:
    """Vectors one after the other: entries first[i] to first[i + 1] are those of vector i, every vector has one at least."""

    first: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, rows: np.ndarray) -> "Sparse":
        n = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.first[rows] - first[:-1], n) + np.arange(first[-1])
        return Sparse(first, self.term[at], self.value[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.value * dense[self.term], self.first[:-1])

    def mean(self, dims: int) -> np.ndarray:
        return np.bincount(self.term, self.value, dims) / len(self)

    def dense(self, row: int, dims: int) -> np.ndarray:
        a, b = self.first[row], self.first[row + 1]
        return np.bincount(self.term[a:b], self.value[a:b], dims)


class Best:
    """The k best (score, smaller id first) that a query has met; ids may come more than once, each for a row of its own."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def kth(self) -> tuple[int, int]:
        """Score and id to beat: the worst of k, or none yet."""
        return self.rows[-1] if len(self.rows) == self.k else (0, None)

    def add(self, scores: np.ndarray, ids: list[list[tuple]]) -> None:
        """Scores of distinct vectors, with the ids of the documents that share each, sorted."""
        least = self.kth[0]
        new = [(int(scores[i]), key) for i in np.flatnonzero((scores >= least) & (scores > 0)) for key in ids[i]]
        if new:
            self.rows = heapq.nsmallest(self.k, self.rows + new, key=lambda r: (-r[0], r[1]))


@dataclass
class _Node:
    bounds: np.ndarray
    least_id: tuple
    children: tuple["_Node", "_Node"] | None
    leaf: tuple[np.ndarray, np.ndarray, np.ndarray, list] | None


@dataclass
class Queries:
    """Terms of each query and how often it holds them; `scored` is that times the terms' weights."""

    first: np.ndarray
    term: np.ndarray
    count: np.ndarray
    scored: np.ndarray

    def __post_init__(self):
        self.filled = np.flatnonzero(np.diff(self.first))
        self.norm = np.zeros(len(self.first) - 1)
        if len(self.filled):
            self.norm[self.filled] = np.sqrt(np.add.reduceat(self.count.astype(np.float64) ** 2, self.first[:-1][self.filled]))

    def bounds(self, centre: np.ndarray, radius: float) -> np.ndarray:
        """Greatest integer score a vector within the ball may have, for every query."""
        out = np.zeros(len(self.norm))
        if len(self.filled):
            out[self.filled] = np.add.reduceat(self.count * centre[self.term], self.first[:-1][self.filled])
        return np.floor((out + self.norm * radius) * (1 + _ROUND + _ROUND_TERM * np.diff(self.first)))


def _node(x: Sparse, norm2: np.ndarray, impact: np.ndarray, ids: list, dims: int, queries: Queries) -> _Node:
    centre = x.mean(dims)
    size = float(centre @ centre)
    away = norm2 + size - 2 * x.dot(centre)
    # What cancels in the difference is covered by a share of what was taken apart.
    radius = float(np.sqrt(np.maximum(away + (norm2 + size) * 1e-10, 0).max()))
    bounds, least = queries.bounds(centre, radius), min(group[0] for group in ids)
    if len(x) <= LEAF:
        return _Node(bounds, least, None, (x.first[:-1], x.term, impact, ids))
    a = x.dense(int(away.argmax()), dims)
    from_a = norm2 - 2 * x.dot(a)
    b = x.dense(int(from_a.argmax()), dims)
    order = np.argsort(x.dot(a - b), kind="stable")
    entries = Sparse(x.first, x.term, impact)
    halves = []
    for rows in (order[: len(order) // 2], order[len(order) // 2 :]):
        halves.append(_node(x.take(rows), norm2[rows], entries.take(rows).value, [ids[i] for i in rows], dims, queries))
    return _Node(bounds, least, tuple(halves), None)


def grow(documents: Sparse, keys: list, weight: np.ndarray, queries: Queries, k: int) -> _Node | None:
    """A tree over documents' impacts. Documents of equal impacts are one vector with the k smallest keys: they always tie."""
    if not len(documents):
        return None
    groups: dict[tuple[bytes, bytes], list[int]] = {}
    for i in range(len(documents)):
        a, b = documents.first[i], documents.first[i + 1]
        groups.setdefault((documents.term[a:b].tobytes(), documents.value[a:b].tobytes()), []).append(i)
    rows = np.array([g[0] for g in groups.values()])
    ids = [heapq.nsmallest(k, (keys[i] for i in g)) for g in groups.values()]
    impacts = documents.take(rows)
    x = Sparse(impacts.first, impacts.term, impacts.value.astype(np.float64) * weight[impacts.term])
    norm2 = np.add.reduceat(x.value**2, x.first[:-1])
    return _node(x, norm2, impacts.value, ids, len(weight), queries)


def search(root: _Node | None, queries: Queries, best: list[Best]) -> int:
    """Bring `best` up to date with a tree, ball by ball from the most promising; returns how many leaves were opened."""
    opened = 0
    if root is None:
        return opened
    scored = np.zeros(int(queries.term.max()) + 1 if len(queries.term) else 0, np.int64)
    for q in queries.filled.tolist():
        mine, a, b = best[q], queries.first[q], queries.first[q + 1]
        scored[queries.term[a:b]] = queries.scored[a:b]
        agenda = [(-root.bounds[q], 0, root)]
        pushed = 0
        while agenda:
            bound, _, node = heapq.heappop(agenda)
            score, id = mine.kth
            # An equal score only counts with a smaller id.
            if -bound < score:
                break
            if -bound == score and id is not None and node.least_id > id:
                continue
            if node.leaf is None:
                for child in node.children:
                    pushed += 1
                    heapq.heappush(agenda, (max(bound, -child.bounds[q]), pushed, child))
                continue
            first, term, impact, ids = node.leaf
            opened += 1
            inside = np.minimum(term, len(scored) - 1)
            mine.add(np.add.reduceat(np.where(term < len(scored), scored[inside], 0) * impact, first), ids)
        scored[queries.term[a:b]] = 0
    return opened


def leaves(root: _Node | None) -> Iterator[_Node]:
    if root is not None:
        if root.children is None:
            yield root
        else:
            for child in root.children:
                yield from leaves(child)
