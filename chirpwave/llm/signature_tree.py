"""Signature trees over groups of token sets, joined by dual traversal.

A set's signature is a bitmap with one bit per token hash.  A tree node holds
the OR of its sets' signatures, their smallest and largest size, and how far
a signature can undercount its set (``slack``: tokens that share a bit).
Two sets below nodes x and y share at most
``popcount(x.bits & y.bits) + min(x.slack, y.slack)`` tokens, so a node pair
is dropped when that, or the size ranges, cannot reach the threshold, or when
all sets below both are already known to be connected.

All groups of a task are traversed together: a frontier of node pairs is
expanded and pruned level by level with array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FANOUT = 8
PAIRS = 1 << 17  # node pairs expanded at a time
WORDS = 1 << 18  # bitmap words compared at a time


@dataclass
class Level:
    bits: np.ndarray  # nodes x words
    low: np.ndarray
    high: np.ndarray
    slack: np.ndarray
    component: np.ndarray  # -1: mixed
    must: np.ndarray  # holds a set that may start a pair
    first: np.ndarray  # first child, in the level below
    last: np.ndarray


def build(bits: np.ndarray, sizes: np.ndarray, component: np.ndarray, must: np.ndarray, group: np.ndarray) -> list[Level]:
    """Levels of the trees of all groups; rows of a group are adjacent.  The
    last level has one root per group."""
    ones = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    every = np.arange(len(sizes))
    levels = [Level(bits, sizes, sizes, sizes - ones, component, must, every, every + 1)]
    while True:
        new = np.concatenate([[True], group[1:] != group[:-1]])
        at = np.nonzero(new)[0]
        if len(at) == len(group):
            return levels
        nth = np.arange(len(group)) - np.repeat(at, np.diff(np.append(at, len(group))))
        starts = np.nonzero(nth % FANOUT == 0)[0]
        below = levels[-1]
        same = np.minimum.reduceat(below.component, starts)
        levels.append(Level(
            np.bitwise_or.reduceat(below.bits, starts, axis=0), np.minimum.reduceat(below.low, starts),
            np.maximum.reduceat(below.high, starts), np.maximum.reduceat(below.slack, starts),
            np.where(same == np.maximum.reduceat(below.component, starts), same, -1),
            np.logical_or.reduceat(below.must, starts), starts, np.append(starts[1:], len(group))))
        group = group[starts]


def _possible(level: Level, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets below nodes x and y may link."""
    ok = (100 * level.high[x] >= percent * level.low[y]) & (100 * level.high[y] >= percent * level.low[x])
    ok &= (level.component[x] < 0) | (level.component[x] != level.component[y])
    ok &= level.must[x] | level.must[y]
    left = np.nonzero(ok)[0]
    step = max(1, WORDS // level.bits.shape[1])
    for start in range(0, len(left), step):
        at = left[start:start + step]
        a, b = x[at], y[at]
        most = np.bitwise_count(level.bits[a] & level.bits[b]).sum(axis=1) + np.minimum(level.slack[a], level.slack[b])
        # 100 * shared >= percent * (a + b - shared)
        ok[at] = (100 + percent) * most >= percent * (level.low[a] + level.low[b])
    return ok


def dual_traversal(levels: list[Level], percent: int):
    """Yields arrays (i, j), i < j, of sets that may link, group by group."""
    roots = np.arange(len(levels[-1].low))
    stack = [(len(levels) - 1, roots, roots)]
    while stack:
        depth, x, y = stack.pop()
        if len(x) > PAIRS:
            half = len(x) // 2
            stack += [(depth, x[half:], y[half:]), (depth, x[:half], y[:half])]
            continue
        ok = _possible(levels[depth], x, y, percent)
        x, y = x[ok], y[ok]
        if depth == 0:
            if len(x):
                yield x, y
            continue
        level = levels[depth]
        wide, tall = level.last[y] - level.first[y], level.last[x] - level.first[x]
        counts = wide * tall
        if counts.sum() > PAIRS and len(x) > 1:
            half = len(x) // 2
            stack += [(depth, x[half:], y[half:]), (depth, x[:half], y[:half])]
            continue
        pair = np.repeat(np.arange(len(x)), counts)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts)
        cx, cy = level.first[x][pair] + nth // wide[pair], level.first[y][pair] + nth % wide[pair]
        keep = cx < cy if depth == 1 else cx <= cy
        stack.append((depth - 1, cx[keep], cy[keep]))
