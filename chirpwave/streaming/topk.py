"""Top-k per window inside a streaming plan.

A stream may not rank with ``row_number``.  The windowed counts, emitted in
append mode as the watermark closes their windows, pass two steps instead:

1. every task keeps its k best words of each window (no shuffle, no state),
   so that a window reaches its reducer with at most k rows per task;
2. a stateful processor keeps the k best words of each window, never more,
   and emits them when the watermark has passed the window's end.

The step before the shuffle makes the window as a key harmless; the state
holds at most k rows per open window, not the list of its words.

Both steps travel with the query (pickled by value), so the workers need pandas
but not this package, nor does the worker with which Spark's driver checks the
processor's state schema.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ROCKSDB, STATE_PROVIDER

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = ["window_start", "window_end"]
RANKED = "window_start timestamp, window_end timestamp, word string, count bigint, rank int"


def best_words(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k first rows of each window, by count (largest first) and word.
    Words are compared by code point, as Spark compares them."""
    keyed = rows.assign(_word=rows["word"].map(lambda w: (w is not None, (w or "").encode())))
    ordered = keyed.sort_values(["count", "_word"], ascending=[False, True], kind="stable")
    return ordered.groupby(WINDOW, sort=False, dropna=False).head(k).drop(columns="_word")


def state_conf(spark: SparkSession) -> dict[str, str]:
    """What the session must be set to when the query starts: the processor's
    list state and timers need column families, which Spark's default state
    store does not have.  The checkpoint keeps the setting for restarts."""
    current = spark.conf.get(STATE_PROVIDER, "")
    return {STATE_PROVIDER: ROCKSDB} if not current or current.endswith("HDFSBackedStateStoreProvider") else {}


class TopWords(StatefulProcessor):
    """State per window: its k best ``(word, count)`` rows so far."""

    def __init__(self, k: int) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "word string, count bigint")

    def _frame(self, key, rows) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["word", "count"])
        return out.assign(window_start=key[0], window_end=key[1])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = self._frame(key, [tuple(r) for r in self.best.get()])
        for part in rows:
            best = best_words(pd.concat([best, part[["word", "count", *WINDOW]]], ignore_index=True), self.k)
        self.best.put([(w, int(n)) for w, n in zip(best["word"], best["count"])])
        self.handle.registerTimer(int(pd.Timestamp(key[1]).timestamp() * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = best_words(self._frame(key, [tuple(r) for r in self.best.get()]), self.k)
        self.best.clear()
        yield best.assign(rank=range(1, len(best) + 1))[[*WINDOW, "word", "count", "rank"]]

    def close(self) -> None:
        pass


def top_words_stream(counts: DataFrame, k: int = 5) -> DataFrame:
    """``counts`` (closed windows of a stream: ``window_start, window_end,
    word, count``) ranked inside the plan; adds ``rank``.  Start the query under
    ``state_conf``."""
    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # k rows per window of this task
        for part in parts:
            held = best_words(part if held is None else pd.concat([held, part], ignore_index=True), k)
        if held is not None:
            yield held

    rows = counts.select(*[F.col(c).cast("timestamp").alias(c) for c in WINDOW], "word", F.col("count").cast("bigint").alias("count"))
    return rows.mapInPandas(first, rows.schema).groupBy(*WINDOW).transformWithStateInPandas(
        statefulProcessor=TopWords(k), outputStructType=RANKED, outputMode="append", timeMode="eventTime")
