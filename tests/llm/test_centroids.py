"""Centroid clustering against plain k-means in Python integers."""

import hashlib
import math

import numpy as np

from chirpwave.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<float>, cluster int, id string, v string"


def plain(rows, k=8, rounds=10):
    vecs = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(vecs, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in vecs:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            cs[j] = [sum(col) // len(g) for col in zip(*g)]
    out = [(i, *near(v)) for i, v in vecs]
    inertia = {}
    for _, d, j in out:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, d, j in out), key=str)


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 64))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.3 * rng.normal(size=64)]) for i in range(200)]
    one = [0.5] * 64
    rows += [(300 + i, one) for i in range(60)]  # a large group of equal vectors
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, one)]  # repeated and null ids
    rows += [(400, None), (401, []), (402, [0.0] * 63), (403, [0.0] * 65), (404, [None] + [0.0] * 63),
             (405, [float("nan")] + [0.0] * 63), (406, [float("inf")] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)
    assert got(C.centroid_clusters(df)) == plain(rows)


def test_few_vectors_ties_and_nothing(spark):
    a, b = [0.0] * 64, [1.0] * 64
    for rows in ([], [(1, a)], [(1, a), (2, a), (3, a)], [(1, a), (2, b), (3, [0.5] * 64)], [(i, a) for i in range(20)] + [(99, b)]):
        df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)
        assert got(C.centroid_clusters(df)) == plain(rows)


def test_huge_components_are_clipped(spark):
    df = spark.createDataFrame([(1, [3e38] * 64, 1, "", ""), (2, [-3e38] * 64, 1, "", ""), (3, [0.0] * 64, 1, "", "")], SCHEMA)
    rows = C.centroid_clusters(df, k=1).collect()
    assert len(rows) == 3 and all(0 <= r["distance"] < 2**63 for r in rows)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, size=(8, 64))
    rows = (centres[rng.integers(0, 8, 4000)] + rng.integers(-150, 150, size=(4000, 64))).astype(np.int64)
    to = np.stack([C.squared(rows, p) for p in centres], axis=1)
    pairs = C.pivot_pairs(centres, 4)
    moved = centres + rng.integers(-20, 20, size=(8, 64))
    exact = np.stack([C.squared(rows, c) for c in moved], axis=1)
    assert (C.lower_bounds(to, moved, centres, pairs) <= exact).all()
    near, distance, checked = C.assign(rows, to, moved, centres, pairs)
    assert (near == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert checked.mean() < 4  # of eight centroids


def test_pivot_pairs_leave_out_equal_pivots():
    same = np.zeros((4, 64), dtype=np.int64)
    assert C.pivot_pairs(same, 4) == [] and C.pivot_pairs(same[:1], 4) == []
    assert [(p, s) for p, s, _ in C.pivot_pairs(np.arange(8 * 64).reshape(8, 64), 4)] == [(0, 1), (2, 3), (4, 5), (6, 7)]
