"""Operator 6: exact top-k search by block-at-a-time pruning.

Vectors are turned into integer term weights.  Documents are ordered so that
neighbours are alike (nearest of a few pivots, then similarity to it) and
cut into document-range blocks; each block keeps its forward index (the
weights) and its term maxima (largest and smallest weight of every term).
A query bounds each block by summing, over its terms, the largest product
the block can give; blocks are scored in falling order of their bound until
the next bound is below the query's k-th score.  Ties at the k-th score go to
the smaller id, so a block whose bound equals it is still scored.

Queries and documents meet in (query chunk, document group) pairs of bounded
size; each pair yields at most k rows per query, which a window per query
merges.  Products are exact: in floating point while all partial sums stay
below 2^53, else in 64-bit integers (which wrap, as Spark's do; components
beyond 64 bits are clipped).

Defined cases: null vectors and vectors with null or non-finite components
take no part, nor do rows with a null id; a shorter vector is padded with
zeros; rows that share the query's id are not its candidates, other repeated
rows each count; every query row is answered by itself; fewer candidates
than k are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_ROWS = 2048
CHUNK_ROWS = 2048
PIVOTS = 32
BLOCK = 128


def integer_weights(vectors: pa.Array, scale: float, width: int | None = None) -> np.ndarray:
    """floor(scale * x) as int64, rows padded with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.asarray(pc.list_value_length(vectors), dtype=np.int64)
    flat = np.asarray(vectors.flatten().cast(pa.float64()))
    width = width if width is not None else int(sizes.max(initial=0))
    with np.errstate(over="ignore"):  # a finite product may pass the largest double
        scaled = np.floor(np.clip(flat * scale, -(2.0**63), 2.0**63 - 1024))
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = scaled.astype(np.int64)
    return out


def _exact_in_doubles(a: np.ndarray, b: np.ndarray) -> bool:
    def top(x):
        return max(float(x.max(initial=0)), -float(x.min(initial=0)))
    return top(a) * top(b) * max(a.shape[1], 1) < 2.0**53


def block_search(ids: np.ndarray, docs: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int, block: int = BLOCK):
    """Top k of every query over documents in block order: (query row, id, score)."""
    m, n = len(queries), len(docs)
    if not m or not n:
        return [np.empty(0, dtype=np.int64)] * 3
    if _exact_in_doubles(docs, queries):
        docs, queries = docs.astype(np.float64), queries.astype(np.float64)
    starts = np.arange(0, n, block)
    high, low = np.maximum.reduceat(docs, starts), np.minimum.reduceat(docs, starts)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    bounds = up @ high.T.astype(np.float64) + down @ low.T.astype(np.float64)
    if docs.dtype != np.float64:
        bounds = np.where(np.abs(bounds) < 2.0**53, bounds, np.inf)  # rounded or wrapping sums prune nothing
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_s, best_i = np.full((m, k), np.iinfo(np.int64).min), np.full((m, k), np.iinfo(np.int64).max)
    filled = np.zeros(m, dtype=np.int64)
    active = np.arange(m)
    for turn in range(len(starts)):
        which = order[active, turn]
        go = (filled[active] < k) | (bounds[active, which] >= best_s[active, k - 1])
        active, which = active[go], which[go]
        if not len(active):
            break
        for b in np.unique(which).tolist():
            rows = active[which == b]
            part = slice(starts[b], min(starts[b] + block, n))
            scores = (queries[rows] @ docs[part].T).astype(np.int64)
            own = q_ids[rows][:, None] == ids[part][None, :]
            s = np.concatenate([best_s[rows], scores], axis=1)
            i = np.concatenate([best_i[rows], np.broadcast_to(ids[part], own.shape)], axis=1)
            gone = np.concatenate([np.arange(k)[None, :] >= filled[rows][:, None], own], axis=1)
            at = np.lexsort((i, ~s, gone), axis=1)[:, :k]  # ~s falls as s rises, without overflow
            best_s[rows], best_i[rows] = np.take_along_axis(s, at, 1), np.take_along_axis(i, at, 1)
            filled[rows] = np.minimum(k, (~gone).sum(axis=1))
    real = np.arange(k)[None, :] < filled[:, None]
    return np.nonzero(real)[0], best_i[real], best_s[real]


def usable(vector: str) -> Column:
    """No null and no non-finite component."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def topk_search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
                scale: float = 1024.0, group_rows: int = GROUP_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every
    row for which ``queries`` holds, among all other rows."""
    rows = (vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                    F.coalesce(queries, F.lit(False)).alias("asks")))
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    pivots = rows.orderBy(F.xxhash64("id", "v"), "id").limit(PIVOTS).select("v").toArrow()["v"]
    centres = integer_weights(pivots, scale).astype(np.float64)
    split = max(1, -(-n // (PIVOTS * group_rows)))  # parts of each pivot's documents, by id
    chunks = max(1, -(-asking // chunk_rows))

    def near(batches):
        for batch in batches:
            w = integer_weights(batch["v"], scale).astype(np.float64)
            width = min(w.shape[1], centres.shape[1])
            sims = w[:, :width] @ centres[:, :width].T
            pivot = sims.argmax(axis=1) if sims.shape[1] else np.zeros(len(w), dtype=np.int64)
            near = sims.max(axis=1) if sims.shape[1] else np.zeros(len(w))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(pivot.astype(np.int32)), pa.array(near)],
                                             names=["id", "v", "pivot", "near"])

    placed = rows.select("id", "v").mapInArrow(near, "id bigint, v array<double>, pivot int, near double")
    docs = placed.select((F.col("pivot") * split + F.pmod(F.xxhash64("id"), F.lit(split)).cast("int")).alias("group"),
                         F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "id", "v", "near")
    asks = rows.where("asks").select(
        F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), "id", "v",
        F.explode(F.sequence(F.lit(0), F.lit(PIVOTS * split - 1))).alias("group"))

    def search(key, asks, docs):
        asks, docs = asks.sort_by([("id", "ascending")]), docs.sort_by([("near", "descending"), ("id", "ascending")])
        a, d = integer_weights(asks["v"], scale), integer_weights(docs["v"], scale)
        width = max(a.shape[1], d.shape[1])
        a, d = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, d))
        # repeated query rows are told apart by a number; their vectors may differ, so it follows vector order
        q_ids = np.asarray(asks["id"], dtype=np.int64)
        order = np.lexsort(tuple(a.T[::-1]) + (q_ids,)) if width else np.arange(len(q_ids))
        a, q_ids = a[order], q_ids[order]
        first = np.searchsorted(q_ids, q_ids)
        nth = np.arange(len(q_ids)) - first
        q, ids, scores = block_search(np.asarray(docs["id"], dtype=np.int64), d, q_ids, a, k)
        return pa.table({"query_id": pa.array(q_ids[q]), "nth": pa.array(nth[q]), "vec_id": pa.array(ids), "score": pa.array(scores)})

    found = (asks.groupBy("group", "chunk").cogroup(docs.groupBy("group", "chunk"))
             .applyInArrow(search, "query_id bigint, nth bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("query_id", "nth").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
