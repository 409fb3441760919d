"""Operator 11: centroid clustering with Ptolemaic pivots.

Exact k-means (Lloyd rounds) of integer vectors.  Ptolemy's inequality says
that for a vector x, a centroid c and two pivots p, s

    d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|

so distances to fixed pivots bound d(x, c) from below without looking at x.
The pivots are the first centroids.  A vector's pivot distances are
computed once and written beside it; a centroid's are computed once a round.
In every round a vector is measured against the centroid of smallest bound,
then only against centroids whose bound does not exceed that distance.
Bounds are rounded down by more than all rounding errors; survivors are
compared by exact squared distances in 64-bit integers.

A round is one pass over the written table: each task sends one row of sums
per centroid, Spark adds them up exactly, and k x dimension totals reach the
driver.  Nothing else does.

Defined cases: vectors that are null, of another length or with a null or
non-finite component take no part; components beyond 2^27 are clipped there
(so that squared distances stay within 64 bits); repeated rows each count;
equal hashes (repeated ids) start in the order of their components and null
ids last; ties go to the smaller centroid; fewer vectors than ``k`` give as
many centroids; an empty table gives an empty result; sums beyond 64 bits
are reported as the largest long.  Only the two columns named are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .topk_search import usable

LIMIT = 2.0**27
BATCH = 8192


def start_key(id_col: str, salt: str = "3") -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}:"), F.col(id_col).cast("bigint").cast("string")), 256)


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    diff = rows - point
    return np.einsum("ij,ij->i", diff, diff)


def pivot_pairs(pivots: np.ndarray, pairs: int) -> list[tuple[int, int, float]]:
    """``(p, s, d(p, s))`` of neighbouring pivots in order, equal ones left out."""
    found = []
    for step in range(1, len(pivots)):
        for p in range(0, len(pivots) - step, 1 if step > 1 else 2):
            d = float(squared(pivots[p:p + 1], pivots[p + step])[0]) ** 0.5
            if d > 0:
                found.append((p, p + step, d))
            if len(found) == pairs:
                return found
    return found


def lower_bounds(to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray, pairs) -> np.ndarray:
    """A squared distance that no vector of the row can come below, per centroid.
    ``to_pivots`` holds exact squared distances."""
    x = np.sqrt(to_pivots.astype(np.float64))
    c = np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1).astype(np.float64))
    best = np.zeros((len(x), len(centroids)))
    for p, s, d in pairs:
        one, two = np.outer(x[:, p], c[:, s]), np.outer(x[:, s], c[:, p])
        # square roots and products are off by less than 2^-50 of their size
        np.maximum(best, (np.abs(one - two) - (one + two) * 2.0**-48) / d, out=best)
    return best * best * (1 - 2.0**-40)


def assign(rows: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray, pairs):
    """Nearest centroid (smaller number at ties), its exact squared distance,
    and how many centroids were measured exactly, per row."""
    n, k = len(rows), len(centroids)
    bounds = lower_bounds(to_pivots, centroids, pivots, pairs)
    nearest = bounds.argmin(axis=1)
    distance = np.empty(n, dtype=np.int64)
    for j in range(k):
        at = np.nonzero(nearest == j)[0]
        distance[at] = squared(rows[at], centroids[j])
    first, checked = nearest.copy(), np.ones(n, dtype=np.int32)
    for j in range(k):
        at = np.nonzero((first != j) & (bounds[:, j] <= distance))[0]
        d = squared(rows[at], centroids[j])
        checked[at] += 1
        closer = (d < distance[at]) | ((d == distance[at]) & (j < nearest[at]))
        nearest[at[closer]], distance[at[closer]] = j, d[closer]
    return nearest, distance, checked


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


def _pieces(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def _next_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, pairs) -> np.ndarray:
    k, width = centroids.shape

    def sums(batches):
        total, count = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in _pieces(batches):
            rows = _matrix(batch["v"], width)
            near, _, _ = assign(rows, _matrix(batch["pd"], len(pivots)), centroids, pivots, pairs)
            for j in np.unique(near).tolist():
                at = near == j
                total[j] += rows[at].sum(axis=0)
                count[j] += at.sum()
        used = np.nonzero(count)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]),
                                          pa.array(total[used].tolist(), type=pa.list_(pa.int64()))], names=["j", "n", "s"])

    parts = table.select("v", "pd").mapInArrow(sums, "j int, n bigint, s array<bigint>")
    wide = "decimal(38,0)"
    totals = (parts.select("j", "n", F.posexplode("s").alias("at", "x")).groupBy("j", "at")
              .agg(F.sum(F.col("x").cast(wide)).alias("x"), F.sum(F.col("n").cast(wide)).alias("n")))
    new = centroids.copy()
    for r in totals.collect():  # k x width rows
        new[r["j"], r["at"]] = int(r["x"]) // int(r["n"])
    return new


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, width: int = 64,
                      rounds: int = 10, scale: float = 1024.0, salt: str = "3", pairs: int = 4) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    checked`` of every vector; ``checked`` is the number of centroids whose
    exact distance was needed."""
    spark: SparkSession = vectors.sparkSession
    whole = F.transform(F.col(vector_col).cast("array<double>"),
                        lambda x: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), x * scale))).cast("int"))
    kept = vectors.where(usable(vector_col) & (F.size(vector_col) == width)).select(
        F.col(id_col).cast("bigint").alias("id"), whole.alias("v"))
    start = kept.select("v", start_key("id", salt).alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    schema = T.StructType.fromDDL("id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
                                  "centroid_sha256 string, checked int")
    if not start:
        return spark.createDataFrame([], schema)
    pivots = np.array([r["v"] for r in start], dtype=np.int64)
    fixed = pivot_pairs(pivots, pairs)

    def measure(batches):
        for batch in _pieces(batches):
            rows = _matrix(batch["v"], width)
            to = np.stack([squared(rows, p) for p in pivots], axis=1)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(to.tolist(), type=pa.list_(pa.int64()))],
                                             names=["id", "v", "pd"])

    path = scratch_path(spark, "centroids")
    kept.mapInArrow(measure, "id bigint, v array<int>, pd array<bigint>").write.parquet(path)
    table = spark.read.parquet(path)
    centroids = pivots
    for _ in range(rounds):
        new = _next_centroids(table, centroids, pivots, fixed)
        if (new == centroids).all():  # all further rounds would repeat this one
            break
        centroids = new

    def last(batches):
        for batch in _pieces(batches):
            near, distance, checked = assign(_matrix(batch["v"], width), _matrix(batch["pd"], len(pivots)), centroids, pivots, fixed)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(near.astype(np.int32)), pa.array(distance), pa.array(checked)],
                                             names=["id", "cluster", "distance", "checked"])

    assigned = table.mapInArrow(last, "id bigint, cluster int, distance bigint, checked int")
    sums = {r["cluster"]: int(r["s"]) for r in
            assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    top = 2**63 - 1
    facts = F.array(*[F.struct(F.lit(min(sums.get(j, 0), top)).cast("bigint").alias("s"),
                               F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()).alias("h"))
                      for j, c in enumerate(centroids)])
    fact = F.get(facts, F.col("cluster"))
    return assigned.select("id", "cluster", "distance", fact["s"].alias("cluster_inertia"),
                           F.lit(min(sum(sums.values()), top)).cast("bigint").alias("inertia"), fact["h"].alias("centroid_sha256"),
                           "checked")
