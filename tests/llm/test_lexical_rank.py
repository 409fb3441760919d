"""Ranked lexical search against the plain formula."""

import math
import random
from collections import Counter

import numpy as np

from chirpwave.llm import ball_tree as B
from chirpwave.llm.lexical_rank import lexical_rank

from . import brute

DOCS = "doc_id bigint, text string, id string, n int, codes string, score double"
ITEMS = "item_id bigint, text string, num int, rank int"


def plain(docs, items, k=20):
    docs = [(i, brute.alnum_words(t)) for i, t in docs if i is not None]
    total, n = sum(len(w) for _, w in docs), sum(1 for _, w in docs if w)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for i, words in docs:
            tf, s = Counter(words), 0
            for t, c in Counter(brute.alnum_words(text)).items():
                if tf[t]:
                    m = 100 - 25 + (25 * len(words) * n) // total
                    s += c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if s > 0:
                scored.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", 1, "c", 0.5) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical_rank(d, q, **kw).collect()), key=str)


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    return [(i, " ".join(rng.choice(vocab[:rng.choice([20, 400])]) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def test_equals_plain_formula(spark):
    docs = corpus(300)
    docs += [(1000 + i, "Alpha, beta! GAMMA-delta 42") for i in range(30)]  # ties, more than the limit
    docs += [(5, docs[5][1]), (None, "alpha beta"), (2000, None), (2001, ""), (2002, " .,! "), (2003, "日本語 Ünïcode\x00w1 w2"),
             (2004, " ".join(f"w{i % 500}" for i in range(40_000)))]
    items = [(1, docs[3][1]), (2, "alpha alpha beta 42 missing"), (3, None), (4, ""), (5, "nowhere nothing"), (6, "日本語 ünïcode"),
             (7, "w1 w2 w3 " * 50), (7, "w5"), (None, "gamma"), (None, "gamma"), (8, "w399")]
    want = plain(docs, items)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, block_items=4) == want  # many blocks


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == [] and got(spark, [(1, None)], [(1, "a")]) == []


def test_fewer_documents_than_ranks(spark):
    docs, items = [(1, "a b"), (2, "b c"), (3, "d")], [(9, "b"), (8, "a b c d")]
    assert got(spark, docs, items, k=2) == plain(docs, items, 2)


def sparse(rng, n, width):
    codes = [np.sort(rng.choice(width, size=rng.integers(1, 20), replace=False)) for _ in range(n)]
    values = [rng.integers(0, 10**10, size=len(c)) for c in codes]
    return B.Sparse(np.arange(n), np.concatenate([[0], np.cumsum([len(c) for c in codes])]), np.concatenate(codes), np.concatenate(values))


def dense(rows, width):
    out = np.zeros((len(rows.ids), width), dtype=np.int64)
    out[np.repeat(np.arange(len(rows.ids)), np.diff(rows.starts)), rows.codes] = rows.values
    return out


def test_balls_cover_their_rows():
    rows = sparse(np.random.default_rng(2), 700, 50)
    nodes, leaves = [B.build(rows, 50, leaf=16)], []
    for node in nodes:
        nodes += node.children
        if node.rows is not None:
            leaves += node.rows.ids.tolist()
            centre = np.zeros(50)
            centre[node.centre[0]] = node.centre[1]
            assert (np.sqrt(((dense(node.rows, 50) - centre) ** 2).sum(axis=1)) <= node.radius).all()
    assert sorted(leaves) == list(range(700))


def test_search_is_exact_and_prunes():
    rng = np.random.default_rng(4)
    width, groups = 200, 16
    parts = []
    for g in range(groups):  # documents of a group share their terms
        terms = np.arange(g * 12, g * 12 + 12)
        parts += [(terms, rng.integers(8 * 10**9, 10**10, size=12)) for _ in range(100)]
    rng.shuffle(parts)
    rows = B.Sparse(np.arange(len(parts)), np.arange(0, 12 * len(parts) + 1, 12), np.concatenate([c for c, _ in parts]),
                    np.concatenate([v for _, v in parts]))
    queries = np.zeros((width, groups), dtype=np.float32)
    for g in range(groups):
        queries[g * 12:g * 12 + 12, g] = rng.integers(1, 4, size=12)
    best = B.Best(groups, 10)
    scored = B.search(B.build(rows, width), queries, np.sqrt((queries.astype(float) ** 2).sum(axis=0)) * (1 + 1e-9), best)
    exact = dense(rows, width) @ queries.astype(np.int64)
    for g in range(groups):
        order = np.lexsort((rows.ids, -exact[:, g]))[:10]
        assert best.ids[g].tolist() == order.tolist() and best.scores[g].tolist() == exact[order, g].tolist()
    assert scored < exact.size / 4
