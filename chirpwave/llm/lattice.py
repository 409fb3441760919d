"""Subword lattices of many words at once, in log space.

A word's lattice has a node between any two characters and an arc for every
vocabulary piece that spells the characters between two nodes.  The forward
recursion sums the probabilities of all paths; with the backward recursion it
gives the expected number of uses of every piece.  Words of equal length
advance together; the trie walk that finds the arcs is shared.
"""

from __future__ import annotations

import math

import numpy as np

MARK = "▁"
LONG = 64
CHUNK = 50_000


class PieceTrie:
    """Pieces (text -> id) as a trie over code points, plus byte pieces for
    characters that no piece spells alone."""

    def __init__(self, pieces: list[str], byte_ids: list[int]):
        self.size = len(pieces)
        children, self.depth = {}, 0
        ends = [-1]
        for i, p in enumerate(pieces):
            if not p or MARK in p[1:] or i in byte_ids:
                continue
            node = 0
            for ch in p:
                key = node << 21 | ord(ch)
                node = children.get(key)
                if node is None:
                    node = children[key] = len(ends)
                    ends.append(-1)
            ends[node] = i
            self.depth = max(self.depth, len(p))
        self.children = children
        self.keys = np.array(sorted(children), dtype=np.int64)
        self.nodes = np.array([children[k] for k in self.keys.tolist()], dtype=np.int64)
        self.ends = np.array(ends, dtype=np.int64)
        self.byte_ids = byte_ids

    def step(self, node: np.ndarray, point: np.ndarray) -> np.ndarray:
        key = node << 21 | point
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], -1)

    def alone(self, point: int) -> bool:
        node = self.children.get(point, -1)
        return node >= 0 and self.ends[node] >= 0

    def byte_pieces(self, point: int) -> list[int]:
        return [self.byte_ids[b] for b in chr(point).encode("utf-8", "surrogatepass")]


def _points(words: list[str]) -> list[np.ndarray]:
    """Code points of marker + word; a marker inside a word is shifted out of
    the pieces' reach (it can only be spelled by bytes)."""
    out = []
    for w in words:
        p = np.frombuffer((MARK + w).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        p[1:][p[1:] == ord(MARK)] = ord(MARK) | 1 << 20 | 1 << 19
        out.append(p)
    return out


def _block(points: np.ndarray, trie: PieceTrie, logp: np.ndarray, counts: np.ndarray | None):
    """Forward (and, with ``counts``, backward) over words of one length."""
    n, size = points.shape
    alpha = np.full((n, size + 1), -np.inf)
    alpha[:, 0] = 0.0
    arcs = []
    spelled = np.zeros(trie.size, dtype=np.float64)
    for i in range(size):
        rows, node = np.arange(n), np.zeros(n, dtype=np.int64)
        single = np.zeros(n, dtype=bool)
        for length in range(1, min(trie.depth, size - i) + 1):
            node = trie.step(node, points[rows, i + length - 1])
            found = node >= 0
            rows, node = rows[found], node[found]
            if not len(rows):
                break
            piece = trie.ends[node]
            use = piece >= 0
            r, p = rows[use], piece[use]
            if length == 1:
                single[r] = True
            j = i + length
            alpha[r, j] = np.logaddexp(alpha[r, j], alpha[r, i] + logp[p])
            if counts is not None:
                arcs.append((i, j, r, p, None))
        bare = np.nonzero(~single)[0]
        if len(bare):
            odd, which = np.unique(points[bare, i], return_inverse=True)
            spell = [trie.byte_pieces(_real(c)) for c in odd.tolist()]
            weight = np.array([sum(logp[b] for b in s) for s in spell])[which]
            alpha[bare, i + 1] = np.logaddexp(alpha[bare, i + 1], alpha[bare, i] + weight)
            if counts is not None:
                arcs.append((i, i + 1, bare, which, (spell, weight)))
    total = alpha[:, size]
    if counts is None:
        return total, None
    beta = np.full((n, size + 1), -np.inf)
    beta[:, size] = 0.0
    for i, j, r, p, bytes_ in reversed(arcs):
        w = logp[p] if bytes_ is None else bytes_[1]
        uses = np.exp(alpha[r, i] + w + beta[r, j] - total[r]) * counts[r]
        if bytes_ is None:
            spelled += np.bincount(p, weights=uses, minlength=trie.size)
        else:
            for k, s in enumerate(bytes_[0]):
                np.add.at(spelled, s, uses[p == k].sum())
        beta[r, i] = np.logaddexp(beta[r, i], w + beta[r, j])
    return total, spelled


def _real(point: int) -> int:
    return ord(MARK) if point == ord(MARK) | 1 << 20 | 1 << 19 else point


def _long(points: list[int], trie: PieceTrie, logp: np.ndarray, count: float | None):
    """One word without a length limit, node by node."""
    size = len(points)
    into: list[list] = [[] for _ in range(size + 1)]  # (from, pieces, weight)
    for i in range(size):
        node, single = 0, False
        for j in range(i + 1, min(i + trie.depth, size) + 1):
            node = trie.children.get(node << 21 | points[j - 1], -1)
            if node < 0:
                break
            piece = int(trie.ends[node])
            if piece >= 0:
                single |= j == i + 1
                into[j].append((i, [piece], float(logp[piece])))
        if not single:
            spell = trie.byte_pieces(_real(points[i]))
            into[i + 1].append((i, spell, float(sum(logp[b] for b in spell))))

    def log_sum(xs):
        top = max(xs)
        return top + math.log(sum(math.exp(x - top) for x in xs))

    alpha = [0.0] * (size + 1)
    for j in range(1, size + 1):
        alpha[j] = log_sum([alpha[i] + w for i, _, w in into[j]])
    if count is None:
        return alpha[size], None
    spelled, beta = {}, [-math.inf] * size + [0.0]
    for j in range(size, 0, -1):
        for i, pieces, w in into[j]:
            uses = math.exp(alpha[i] + w + beta[j] - alpha[size]) * count
            for b in pieces:
                spelled[b] = spelled.get(b, 0.0) + uses
            beta[i] = log_sum([beta[i], w + beta[j]]) if beta[i] > -math.inf else w + beta[j]
    return alpha[size], spelled


def word_lattices(words: list[str], trie: PieceTrie, logp: np.ndarray, counts: np.ndarray | None = None):
    """Natural-log marginal probability of every word (with its marker), and
    the expected piece uses weighted by ``counts`` (None without counts)."""
    points = _points(words)
    sizes = np.array([len(p) for p in points], dtype=np.int64)
    total = np.zeros(len(words))
    spelled = None if counts is None else np.zeros(trie.size)
    for size in np.unique(sizes).tolist():
        which = np.nonzero(sizes == size)[0]
        if size > LONG:
            for i in which.tolist():
                total[i], uses = _long(points[i].tolist(), trie, logp, None if counts is None else float(counts[i]))
                for piece, x in (uses or {}).items():
                    spelled[piece] += x
            continue
        for start in range(0, len(which), CHUNK):
            part = which[start:start + CHUNK]
            block = np.stack([points[i] for i in part.tolist()])
            total[part], uses = _block(block, trie, logp, None if counts is None else counts[part])
            if spelled is not None:
                spelled += uses
    return total, spelled
