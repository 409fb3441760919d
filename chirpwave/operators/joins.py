"""Joins (J1-J3).

``join_windows`` is the windowed equi-join of two per-(window, place)
aggregates, on their grouping keys (the ``window`` struct and the
place).  Both inputs come out of an aggregate hash-partitioned on exactly
those keys, so in batch Spark joins them without re-shuffling either
side (or broadcasts one at runtime when AQE measures it small); on a
stream it is a stream-stream inner join in append mode whose state is
dropped once both watermarks pass a window (the struct carries them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

WINDOW_KEYS = ("window", "place")


def join_windows(left: DataFrame, right: DataFrame, keys: Sequence[str] = WINDOW_KEYS,
                 how: str = "inner") -> DataFrame:
    return left.join(right, list(keys), how)

