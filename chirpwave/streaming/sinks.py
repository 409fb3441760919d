"""Sinks (K1-K3) and query start helpers.

Every streaming query names its checkpoint, a folder of the shared file
system: offsets, state and the sink's commit log live there, so a lost
executor or a restarted driver resumes where it stopped instead of losing or
repeating windows.  There is no default: a random folder would resume nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

# Fixed value: the reference's micro-batch interval.
DEFAULT_TRIGGER = "100 milliseconds"


def to_kafka_rows(df: DataFrame, cols: Sequence[str] | None = None, key: Column | None = None) -> DataFrame:
    """``(key, value)`` rows for the Kafka sink: value = JSON object of
    ``cols`` (all columns by default).  No key by default, so records
    spread over all topic partitions (a constant key would send them all
    to one)."""
    cols = list(cols or df.columns)
    k = (key if key is not None else F.lit(None)).cast("string")
    return df.select(k.alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def kafka_sink_options(brokers: str, topic: str, extra: dict | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers, "topic": topic}
    opts.update(extra or {})
    return opts


def start_query(df: DataFrame, fmt: str, checkpoint: str, path: str | None = None,
                output_mode: str = "append", trigger: dict | None = None, options: dict | None = None,
                query_name: str | None = None) -> StreamingQuery:
    """Start a streaming query with a checkpoint and a trigger
    (``{"processingTime": "100 milliseconds"}`` by default)."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def start_kafka_query(df: DataFrame, brokers: str, topic: str, checkpoint: str, cols: Sequence[str] | None = None,
                      key: Column | None = None, trigger: dict | None = None) -> StreamingQuery:
    """K1/K2: write each result row as a JSON record to a Kafka topic."""
    return start_query(to_kafka_rows(df, cols, key), "kafka", checkpoint,
                       trigger=trigger, options=kafka_sink_options(brokers, topic))


def start_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        output_mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """K3: hand every micro-batch to ``fn(batch_df, epoch_id)``."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
           .foreachBatch(fn).trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER})))
    return w.start()


class LateRows(StreamingQueryListener):
    """Counts, per query, the rows that state operators dropped because the
    watermark had passed them, and logs every batch that dropped some.

    A row is counted once per stateful operator that drops it (a window
    aggregate drops a late row before any later operator sees it)."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        n = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if n > 0:
            self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + n
            log.warning("query %s batch %s: %s rows came after the watermark and were dropped", p.name or p.id, p.batchId, n)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
