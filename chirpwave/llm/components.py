"""Connected components of an edge table, by alternating star contractions.

Each round hangs every node's larger neighbours on its smallest one (large
star), then its smaller neighbours (small star).  Rounds are joins and
minimum aggregations only; edges are checkpointed to the shared folder after
each round and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpwave.session import ensure_checkpoint_dir


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; a component is
    named by its smallest node."""
    ensure_checkpoint_dir(edges.sparkSession)
    edges = (edges.where(F.col("u") != F.col("v"))
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        after = _state(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
