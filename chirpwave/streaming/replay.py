"""Replay a table through Structured Streaming (stream = batch checks).

``replay`` writes each input feed into a landing folder in time-ordered
slices and, after every slice, runs the streaming query with
``trigger(availableNow=True)`` on one checkpoint.  Every run therefore
restarts from the checkpoint (offsets, state store, sink log) exactly as
after a lost driver, and the watermark advances slice by slice as it
would on a live feed.  A final sentinel row far in the future closes
every real window; rows produced by it are removed from the result.

All folders are under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import valid
from ..plans import pipelines as P
from ..plans import queries as Q
from ..session import make_folder, scratch_path, settings
from ..sources import feeds
from ..sources.tables import read_parquet_stream
from . import jobs as J
from . import pipelines as S
from .sinks import start_foreach_batch, start_query
from .topk import state_conf

# Fixed parameters of the replay.
SLICES = 4
SENTINEL_KEY = "~sentinel"
SENTINEL_GAP_DAYS = 60

# RocksDB state of runs of one or two batches: a store left open after its run
# keeps files of 4 MB and more until the next maintenance, and a snapshot per
# batch is more than its changes.
SHORT_RUNS = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns back to TIMESTAMP_NTZ (same UTC wall clock)."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
    return df


def _landing(spark: SparkSession, df: DataFrame, ts: str, base: str, name: str,
             key: str | None, overrides: dict[str, str] | None = None
             ) -> tuple[str, T.StructType, list[DataFrame], object]:
    """Materialise one feed once, partitioned by time slice, and prepare
    the slice reads (each reads only its own folder) and the sentinel."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    full = f"{base}/{name}-all"
    # one bounded aggregate row for the time range
    lo, hi = df.agg(F.unix_micros(F.min(ts)), F.unix_micros(F.max(ts))).first()
    width = max(1, -(-(hi - lo + 1) // SLICES))
    # rows without an event time go with the first slice: an analysis that needs no time gets them too
    number = ((F.unix_micros(F.col(ts)) - F.lit(lo)) / F.lit(width)).cast("int")
    sliced = df.withColumn("_slice", F.coalesce(number, F.lit(0)))
    sliced.write.partitionBy("_slice").parquet(full)
    stored = spark.read.parquet(full)
    slices = [stored.where(F.col("_slice") == i).drop("_slice") for i in range(SLICES)]
    first = slices[0]
    sentinel = first.limit(1).withColumn(ts, F.col(ts) + F.expr(f"INTERVAL {SENTINEL_GAP_DAYS} DAYS"))
    if key:
        sentinel = sentinel.withColumn(key, F.lit(SENTINEL_KEY))
    for col, value in (overrides or {}).items():
        sentinel = sentinel.withColumn(col, F.lit(value))
    slices.append(sentinel)
    return f"{base}/{name}-in", first.schema, slices, hi


class Feed:
    """Inputs (name -> (batch feed, event-time column, key column or None[,
    column overrides for the sentinel row])) landed slice by slice under
    ``base``; ``streams`` reads them, ``last`` is the newest real event time."""

    def __init__(self, spark: SparkSession, inputs: dict[str, tuple]) -> None:
        self.spark = spark
        self.base = scratch_path(spark, "replay")
        self.prepared = {name: _landing(spark, spec[0], spec[1], self.base, name, spec[2], spec[3] if len(spec) > 3 else None)
                         for name, spec in inputs.items()}
        self.steps = max(len(slices) for _, _, slices, _ in self.prepared.values())
        self.last = max(hi for _, _, _, hi in self.prepared.values())
        self.land(0)  # a file source needs its folder before the query is defined
        self.streams = {name: read_parquet_stream(spark, path, schema) for name, (path, schema, _, _) in self.prepared.items()}

    def land(self, i: int) -> None:
        for path, _, slices, _ in self.prepared.values():
            if i < len(slices):
                slices[i].write.mode("append").parquet(path)

    def real(self, df: DataFrame, time: Column) -> DataFrame:
        """Without the windows that only the sentinel row fills."""
        return df.where(time.cast("timestamp") <= F.timestamp_micros(F.lit(self.last)))

    def run(self, step: Callable[[], None], conf: dict[str, str] | None = None) -> None:
        """``step()`` after every slice, and once more without new data, so
        that the final watermark closes windows; under ``conf`` meanwhile.

        State partitions are fixed by the first run of a checkpoint; they are
        sized to the cores available rather than to a generic default."""
        partitions = str(max(1, self.spark.sparkContext.defaultParallelism))
        with settings(self.spark, {"spark.sql.shuffle.partitions": partitions, **(conf or {})}):
            for i in range(self.steps):
                if i:
                    self.land(i)
                step()
            step()


def run_once(result: DataFrame, path: str, checkpoint: str) -> None:
    """All that is there now, appended to a parquet folder."""
    start_query(result, "parquet", checkpoint, path=path, trigger={"availableNow": True}).awaitTermination()


def replay(spark: SparkSession, inputs: dict[str, tuple],
           build: Callable[[dict[str, DataFrame]], DataFrame],
           sink: str = "parquet", k: int | None = None,
           window_filter: bool = True, conf: dict[str, str] | None = None) -> DataFrame:
    """Run ``build(streams)`` as a streaming query over ``inputs`` (see
    ``Feed``), under the settings ``conf``, and return what reached the sink,
    sentinel rows removed.

    ``sink="topk"`` ranks each micro-batch with ``top_words(k)`` in
    ``foreachBatch`` (P3); otherwise rows go to a parquet file sink.
    """
    feed = Feed(spark, inputs)
    result = build(feed.streams)
    out, ckpt = f"{feed.base}/out", f"{feed.base}/checkpoint"

    def step() -> None:
        if sink == "topk":
            writer = S.top_k_writer(S.parquet_epoch_sink(out, ckpt), k or 5)
            start_foreach_batch(result, writer, ckpt, trigger={"availableNow": True}).awaitTermination()
        else:
            run_once(result, out, ckpt)

    feed.run(step, conf)
    got = spark.read.parquet(out).drop("query", "epoch")
    if window_filter and "window_start" in got.columns:
        got = feed.real(got, F.col("window_start"))
    if "key" in got.columns:
        got = got.where(F.col("key").isNull() | (F.col("key") != SENTINEL_KEY))
    return _ntz(got)


# ---------------------------------------------------------------- registered stream queries

def q_stream_classify(spark: SparkSession, sf: str) -> DataFrame:
    """P1 as a stream (replayed slices), read back."""
    out = replay(spark, {"posts": (feeds.post_records(spark, sf), "timestamp", "key")},
                 lambda s: S.stream_classify(s["posts"]).where(F.col("_reject").isNull()).drop("_reject"))
    return Q._read_back(out.select("value")).drop("n_fields")


def q_stream_state_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """P2 as a stream: append mode, watermark, state store."""
    return replay(spark, {"posts": (feeds.posts(spark, sf), "ts", "id")},
                  lambda s: S.stream_state_sentiment(s["posts"], "ts", Q.DAY))


def q_stream_trending(spark: SparkSession, sf: str) -> DataFrame:
    """P3 as a stream: append-mode counts, foreachBatch top-k."""
    return replay(spark, {"posts": (feeds.posts(spark, sf), "ts", "id")},
                  lambda s: S.stream_hashtag_counts(s["posts"], "ts", *Q.SLIDING), sink="topk", k=Q.K)


def q_stream_sentiment_weather(spark: SparkSession, sf: str) -> DataFrame:
    """P4 as two streams joined on closed windows."""
    return replay(spark, {"posts": (feeds.posts(spark, sf), "ts", "id"),
                          "weather": (feeds.weather(spark, sf), "ts", None)},
                  lambda s: S.stream_sentiment_weather(s["posts"], s["weather"], "ts", size=Q.DAY))


def q_stream_state_sentiment_no_id(spark: SparkSession, sf: str) -> DataFrame:
    """P2 as a stream of JSON records with string, numeric and no ids."""
    def build(streams):
        posts = valid(P.parse_posts(streams["posts"])).withColumnRenamed("timestamp", "ts")
        return S.stream_state_sentiment(posts, "ts", Q.DAY)
    return replay(spark, {"posts": (feeds.post_records_mixed_ids(spark, sf), "timestamp", "key")}, build)


def q_stream_hashtag_counts_paned(spark: SparkSession, sf: str) -> DataFrame:
    """A1 as a stream of two chained aggregates: panes, then windows of panes."""
    return replay(spark, {"posts": (feeds.posts(spark, sf), "ts", "id")},
                  lambda s: S.stream_hashtag_counts(s["posts"], "ts", *Q.MANY_PANES, panes=True))


def q_stream_trending_inplan(spark: SparkSession, sf: str) -> DataFrame:
    """P3 as a stream ranked inside its plan, into a plain file sink."""
    return replay(spark, {"posts": (feeds.posts(spark, sf), "ts", "id")},
                  lambda s: S.stream_trending_inplan(s["posts"], "ts", *Q.SLIDING, k=Q.K),
                  conf={**SHORT_RUNS, **state_conf(spark)})


def q_stream_state_sentiment_model(spark: SparkSession, sf: str) -> DataFrame:
    """P2's job with a model: records scored once in a step of their own, the
    windowed result read back from its sink."""
    whole = '{"id": "0", "text": "the end", "place_full_name": "Texas"}'  # the sentinel must not be a corrupt record
    feed = Feed(spark, {"posts": (Q.corrupted_post_records(spark, sf), "timestamp", "key", {"value": whole})})
    out, scorer = f"{feed.base}/out", Q.stand_in_model()

    def step() -> None:
        J.state_sentiment_job(feed.streams["posts"], J.Sink.files(out), J.Sink.files(f"{feed.base}/rejects"),
                              f"{feed.base}/checkpoint", size=Q.DAY, trigger={"availableNow": True}, scorer=scorer).await_all()

    feed.run(step)
    rows = spark.read.parquet(out).select(F.inline(F.array(F.from_json(
        "value", "time bigint, place string, sentiment double, count bigint"))))
    return feed.real(rows, F.timestamp_millis("time") - F.expr(f"INTERVAL {Q.DAY}"))


def live_snapshots(spark: SparkSession, sf: str, seen: Callable[[DataFrame, DataFrame], None] | None = None) -> DataFrame:
    """P4 replayed, and P5 kept live from the rows it emits.  After every slice
    ``seen(frame, rows)`` gets the live frame and P4's rows so far; returns the
    last frame."""
    feed = Feed(spark, {"posts": (feeds.posts(spark, sf), "ts", "id"), "weather": (feeds.weather(spark, sf), "ts", None)})
    p4 = S.stream_sentiment_weather(feed.streams["posts"], feed.streams["weather"], "ts", size=Q.DAY)
    out = f"{feed.base}/out"
    make_folder(spark, out)
    rows = feed.real(read_parquet_stream(spark, out, p4.schema), F.col("window_start"))
    table = J.Sink.table("snapshot_" + feed.base.rpartition("-")[2])
    live = J.start_snapshot(rows, table, f"{feed.base}/live", {"processingTime": "100 milliseconds"})

    def step() -> None:
        run_once(p4, out, f"{feed.base}/checkpoint")
        live.processAllAvailable()
        if seen:
            seen(J.live_snapshot(spark, live.name), feed.real(spark.read.schema(p4.schema).parquet(out), F.col("window_start")))

    try:
        feed.run(step)
    finally:
        live.stop()
    return _ntz(J.live_snapshot(spark, live.name))


def q_stream_state_snapshot_live(spark: SparkSession, sf: str) -> DataFrame:
    """P5 on a live feed: latest row per state as streaming state."""
    return live_snapshots(spark, sf)


def q_stream_state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """P5 from the rows that the P4 stream has emitted."""
    return P.state_snapshot(q_stream_sentiment_weather(spark, sf))


STREAM: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_classify": q_stream_classify,
    "stream_state_sentiment": q_stream_state_sentiment,
    "stream_state_sentiment_no_id": q_stream_state_sentiment_no_id,
    "stream_trending": q_stream_trending,
    "stream_sentiment_weather": q_stream_sentiment_weather,
    "stream_state_snapshot": q_stream_state_snapshot,
    "stream_hashtag_counts_paned": q_stream_hashtag_counts_paned,
    "stream_trending_inplan": q_stream_trending_inplan,
    "stream_state_sentiment_model": q_stream_state_sentiment_model,
    "stream_state_snapshot_live": q_stream_state_snapshot_live,
}


def stream_oracle() -> dict[str, str]:
    o = Q.oracle()
    state = o["state_sentiment"]
    return {
        "stream_classify": o["classify_posts"],
        "stream_state_sentiment": state,
        "stream_state_sentiment_no_id": state,
        "stream_trending": o["trending_topics"],
        "stream_sentiment_weather": o["sentiment_weather"],
        "stream_state_snapshot": o["state_snapshot"],
        "stream_hashtag_counts_paned": o["hashtag_counts_many_panes"],
        "stream_trending_inplan": o["trending_topics"],
        "stream_state_sentiment_model": o["state_sentiment_model"],
        "stream_state_snapshot_live": o["state_snapshot"],
    }


