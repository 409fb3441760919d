"""Ball trees over sparse integer vectors, searched for inner products.

A node covers a set of rows by their mean (the centre) and a radius.  For a
query q no row of the node can score more than ``<q, centre> + |q| * radius``.
Rounding is safe: radii and bounds are widened by more than the errors of the
floating point sums, and rows of a leaf are scored in 64-bit integers.

All queries of a block go down the tree together: the heap holds nodes with
the queries that may still find something there, the node of the largest
bound first; a subtree that no query can enter any more is never opened.  A
query without a threshold first scores its most promising leaf.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

LEAF = 64
TURNS = 4


@dataclass
class Sparse:
    """Row i holds ``values[starts[i]:starts[i + 1]]`` at terms ``codes[...]``."""

    ids: np.ndarray
    starts: np.ndarray
    codes: np.ndarray
    values: np.ndarray

    def take(self, rows: np.ndarray) -> "Sparse":
        sizes = self.starts[rows + 1] - self.starts[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], sizes)
        return Sparse(self.ids[rows], starts, self.codes[at], self.values[at])

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """Per row, the sum of its entries (no row is empty)."""
        return np.add.reduceat(entries, self.starts[:-1], axis=0)


@dataclass
class Node:
    rows: Sparse | None  # of a leaf
    centre: tuple[np.ndarray, np.ndarray]  # terms, means
    radius: float
    children: tuple["Node", ...] = ()


def build(rows: Sparse, width: int, leaf: int = LEAF) -> Node:
    """The ball tree of rows that each hold at least one term.  A node's rows
    are split at the widest gap, in the middle half, of their order along the
    direction in which they spread most."""
    n = len(rows.ids)
    values = rows.values.astype(np.float64)
    norms = rows.sums(values * values)

    def distances(point: np.ndarray, square: float) -> np.ndarray:
        return norms - 2 * rows.sums(values * point[rows.codes]) + square

    mean = np.bincount(rows.codes, weights=values, minlength=width) / n
    square = float(mean @ mean)
    far = distances(mean, square)
    radius = float(np.sqrt(max(0.0, float((far + 1e-9 * (norms + square)).max()))))
    terms = np.nonzero(mean)[0]
    centre = (terms, mean[terms])
    if n <= leaf:
        return Node(rows, centre, radius)

    # the direction in which the rows spread most, by power iteration
    part = slice(rows.starts[(i := int(far.argmax()))], rows.starts[i + 1])
    along = np.bincount(rows.codes[part], weights=values[part], minlength=width) - mean
    owner = np.repeat(np.arange(n), np.diff(rows.starts))
    for _ in range(TURNS):
        spread = rows.sums(values * along[rows.codes]) - mean @ along
        along = np.bincount(rows.codes, weights=values * spread[owner], minlength=width) - mean * spread.sum()
        along /= np.sqrt(along @ along) or 1.0
    place = rows.sums(values * along[rows.codes])
    order = np.argsort(place, kind="stable")
    gaps = np.diff(place[order])[n // 4:n - n // 4]
    cut = n // 4 + 1 + int(gaps.argmax()) if gaps.max() > 0 else n // 2
    return Node(None, centre, radius, tuple(build(rows.take(np.sort(h)), width, leaf) for h in (order[:cut], order[cut:])))


class Best:
    """The ``k`` best (score, id) of every query; larger scores first, then
    smaller ids; only scores above 0 and not below ``floor`` count."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.zeros((queries, k), dtype=np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = np.ones(queries, dtype=np.int64) if floor is None else np.maximum(floor, 1)

    def least(self) -> np.ndarray:
        """A score that a row must reach to count."""
        return np.maximum(self.floor, self.scores[:, -1])

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores[i, j]`` of query ``queries[i]`` and row ``ids[j]``."""
        some = (scores >= self.least()[queries][:, None]).any(axis=1)
        queries, scores = queries[some], scores[some]
        if not len(queries):
            return
        s = np.concatenate([self.scores[queries], scores], axis=1)
        i = np.concatenate([self.ids[queries], np.broadcast_to(ids, scores.shape)], axis=1)
        at = np.lexsort((i, -s), axis=1)[:, :self.scores.shape[1]]
        self.scores[queries], self.ids[queries] = np.take_along_axis(s, at, 1), np.take_along_axis(i, at, 1)

    def found(self):
        """``(query, id, score)`` of what counts."""
        real = self.scores >= self.floor[:, None]
        return np.nonzero(real)[0], self.ids[real], self.scores[real]


def search(root: Node, queries: np.ndarray, norms: np.ndarray, best: Best) -> int:
    """Add the rows of the tree to ``best``; ``queries[term, query]`` are
    non-negative integer weights (stored as floats) and ``norms`` their
    lengths.  Returns how many (query, row) pairs were scored."""
    def middle(node: Node, who: np.ndarray) -> np.ndarray:
        terms, means = node.centre
        return means @ queries[terms][:, who].astype(np.float64)

    def bounds(node: Node, who: np.ndarray) -> np.ndarray:
        return (middle(node, who) + norms[who] * node.radius) * (1 + 1e-9) + 1e-6

    scored, turn = 0, 0
    heap: list = []
    done: dict[int, np.ndarray] = {}  # who has seen a leaf already

    def score(node: Node, who: np.ndarray) -> None:
        nonlocal scored
        rows = node.rows
        scores = rows.sums(queries[rows.codes][:, who].astype(np.int64) * rows.values[:, None]).T
        scored += scores.size
        best.add(who, rows.ids, scores)

    def descend(node: Node, who: np.ndarray) -> None:
        """Straight to each query's most promising leaf."""
        while node.rows is None:
            one, two = node.children
            left = middle(one, who) >= middle(two, who)
            if not left.all():
                descend(two, who[~left])
            if not left.any():
                return
            node, who = one, who[left]
        score(node, who)
        done[id(node)] = who

    def push(node: Node, who: np.ndarray, limit: np.ndarray) -> None:
        nonlocal turn
        stay = limit >= best.least()[who]
        if stay.any():
            heapq.heappush(heap, (-float(limit[stay].max()), turn, node, who[stay], limit[stay]))
            turn += 1

    fresh = np.nonzero(best.least() <= 1)[0]  # no threshold yet
    if len(fresh):
        descend(root, fresh)
    everyone = np.arange(queries.shape[1])
    push(root, everyone, bounds(root, everyone))
    while heap:
        _, _, node, who, limit = heapq.heappop(heap)
        still = limit >= best.least()[who]  # thresholds may have risen meanwhile
        if id(node) in done:
            still &= ~np.isin(who, done[id(node)])
        who, limit = who[still], limit[still]
        if not len(who):
            continue
        if node.rows is not None:
            score(node, who)
        for child in node.children:
            push(child, who, np.minimum(limit, bounds(child, who)))
    return scored
