"""Sort, limit and top-k.

* ``top_k``: global ``orderBy(...).limit(k)``; Spark plans it as
  ``TakeOrderedAndProject`` (each task keeps k rows, the final merge sees
  k x tasks rows), never a full sort or a collect.
* ``top_k_per_group``: ``row_number()`` over the group, filtered to
  ``<= k``.  Spark inserts a partial ``WindowGroupLimit`` before the
  shuffle, so a group (one window) never sends more than k rows per map
  task to its reducer, however many distinct words it holds.

Ties are broken by the given order columns, so results are deterministic
(the reference leaves them arbitrary).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], k: int, order: Sequence[Column],
                    rank_col: str | None = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    if rank_col:
        return ranked.withColumnRenamed("_rank", rank_col)
    return ranked.drop("_rank")
