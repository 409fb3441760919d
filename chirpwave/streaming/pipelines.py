"""Streaming forms of P1-P4.

The batch functions of ``plans.pipelines`` already run on streams; what
a stream adds is event time with a watermark (R3/R4: rows later than
the watermark are dropped, the delay is a parameter), append-mode
emission of closed windows (R5), and two shapes that Structured
Streaming only allows in a particular form:

* top-k per window (P3): ``row_number`` is not allowed on a stream, so
  the windowed counts are emitted in append mode and ranked either inside
  ``foreachBatch`` (exact: all rows of a window are emitted in the one
  micro-batch that closes it), or inside the plan by a second stateful
  operator that keeps k rows per window (``streaming.topk``).
* the stream-stream join of two windowed aggregates (P4) is joined on the
  ``window`` struct, which carries the watermark, so Spark can drop join
  state once both sides have passed a window.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import pipelines as P
from .topk import top_words_stream

Scorer = Callable[[Column], Column]

# Default watermark delay of the functions.  Rows stamped on arrival are never
# late; Kafka timestamps can be (several partitions or topics, a backlog after
# a restart), so the command line asks for a delay.
DEFAULT_DELAY = "0 seconds"


def with_event_time(df: DataFrame, ts: str = "timestamp", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Event time as TIMESTAMP (a watermark refuses TIMESTAMP_NTZ) with a
    watermark of ``delay``."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_classify(records: DataFrame, lexicon: dict[str, int] | None = None,
                    scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """P1 on a stream: stateless, one narrow stage."""
    return P.classify_posts(records, lexicon, scorer)


def stream_state_sentiment(posts: DataFrame, ts: str = "ts", size: str = "5 seconds",
                           delay: str = DEFAULT_DELAY, exact: bool = False, trim: bool = True,
                           lexicon: dict[str, int] | None = None, scorer: Scorer | None = None) -> DataFrame:
    """P2 on a stream (append mode: one row per closed window and state)."""
    return P.state_sentiment(with_event_time(posts, ts, delay), ts, size, exact=exact, trim=trim, lexicon=lexicon, scorer=scorer)


def stream_hashtag_counts(posts: DataFrame, ts: str = "ts", size: str = "4 seconds",
                          slide: str | None = "2 seconds", delay: str = DEFAULT_DELAY,
                          mode: str = "normal", text_col: str = "text", panes: bool | None = None) -> DataFrame:
    """A1 on a stream: closed-window hashtag counts (append mode).  With
    ``panes`` (see ``plans.pipelines.hashtag_counts``) a row updates the state
    of one pane instead of size/slide windows."""
    return P.hashtag_counts(with_event_time(posts, ts, delay), ts, size, slide, mode, text_col, panes)


def stream_trending_inplan(posts: DataFrame, ts: str = "ts", size: str = "4 seconds", slide: str | None = "2 seconds",
                           k: int = 5, delay: str = DEFAULT_DELAY, mode: str = "normal", text_col: str = "text",
                           panes: bool | None = None) -> DataFrame:
    """P3 on a stream, ranked inside the plan, for any sink:
    ``window_start, window_end, word, count, rank``."""
    return top_words_stream(stream_hashtag_counts(posts, ts, size, slide, delay, mode, text_col, panes), k)


def top_k_writer(sink: Callable[[DataFrame, int], None], k: int = 5) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function ranking each batch's closed windows."""
    def _rank(batch: DataFrame, epoch_id: int) -> None:
        sink(P.top_words(batch, k), epoch_id)
    return _rank


def query_tag(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: the same after a restart
    from it, another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def epoch_path(spark: SparkSession, path: str, checkpoint: str, epoch_id: int) -> str:
    """Where an epoch's output goes.  A batch replayed after a failure
    overwrites its first attempt; a query with a new checkpoint, whose epochs
    count from 0 again, writes beside the earlier output."""
    return f"{path}/query={query_tag(spark, checkpoint)}/epoch={epoch_id}"


def parquet_epoch_sink(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Idempotent ``foreachBatch`` sink (see ``epoch_path``)."""
    def _write(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(epoch_path(df.sparkSession, path, checkpoint, epoch_id))
    return _write


def stream_sentiment_weather(posts: DataFrame, weather: DataFrame, ts: str = "ts", weather_ts: str | None = None,
                             size: str = "2 seconds", delay: str = DEFAULT_DELAY, exact: bool = False,
                             trim: bool = True, lexicon: dict[str, int] | None = None,
                             scorer: Scorer | None = None) -> DataFrame:
    """P4 on two streams: two watermarked windowed aggregates joined on
    ``(window, place)`` in append mode."""
    weather_ts = weather_ts or ts
    return P.sentiment_weather(with_event_time(posts, ts, delay), with_event_time(weather, weather_ts, delay),
                               ts, weather_ts, size, exact, trim, lexicon, scorer)
