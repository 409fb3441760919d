"""End-to-end streaming jobs: the four analyses from source to sink.

Each job takes streaming record frames ``(key, value, timestamp)`` (from
``sources.kafka.read_kafka`` on a cluster, or any file stream) and a
``Sink`` per output, and starts:

* the result query: JSON records (``value``, optional ``key``) to the
  output sink, append mode, with a checkpoint;
* the reject query: records that could not be parsed or scored, with the
  reason, to the reject sink (the reference fails the whole job instead).
  With the lexicon it uses cheap input checks, never the scoring itself, so
  the expensive per-row work runs once.

P1 is one query that routes good and bad records.  In P2-P4 two queries read
the same source frame; start it at explicit offsets or a timestamp (the
command line does), so that both begin at the same record.

With a user model, P2 and P4 score in a step of their own (``scored_stage``):
one query scores every record once and writes it, with its reject reason, to
a file sink under the checkpoint; the result and the reject query read that
stream.  So both see the same class of a record, whatever the model would
answer a second time.

P5 (``snapshot_job``) keeps the dashboard's 50 rows up to date from the rows
that P4 emits, into a sink that replaces rows by state.

All queries checkpoint under the given folder, so a restarted job
resumes from its offsets and state.

Command line (on a cluster with the Kafka connector)::

    python -m chirpwave.streaming.jobs trending --brokers b:9092 --topics posts \\
        --out-topic trending-topics --checkpoint /shared/ckpt/trending --delay "10 seconds"
"""

from __future__ import annotations

import argparse
import importlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import window_time_ms
from ..functions.records import TEXT_FIELDS, rejects, valid
from ..plans import pipelines as P
from ..session import make_folder, settings
from ..sources.tables import read_parquet_stream
from . import pipelines as S
from .sinks import DEFAULT_TRIGGER, LateRows, kafka_sink_options, start_foreach_batch, start_query, to_kafka_rows
from .topk import state_conf

Scorer = Callable[[Column], Column]


@dataclass
class Sink:
    """Where an output goes: ``format`` plus options (``path`` for files)."""
    format: str
    options: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def kafka(brokers: str, topic: str) -> "Sink":
        return Sink("kafka", kafka_sink_options(brokers, topic))

    @staticmethod
    def files(path: str, fmt: str = "parquet") -> "Sink":
        return Sink(fmt, {"path": path})

    @staticmethod
    def table(name: str) -> "Sink":
        """An in-memory table of the driver's session (small results only)."""
        return Sink("memory", {"queryName": name})

    def write_batch(self, df: DataFrame, epoch_id: int, checkpoint: str) -> None:
        """Write one micro-batch (used from ``foreachBatch``).  A file sink
        writes each epoch of the query that owns ``checkpoint`` to its own
        folder in overwrite mode, so a batch replayed after a failure replaces
        its first attempt and nothing else; Kafka is at-least-once, as Spark's
        own Kafka sink is."""
        opts = dict(self.options)
        path = opts.pop("path", None)
        w = df.write.format(self.format).options(**opts)
        if path:
            w.mode("overwrite").save(S.epoch_path(df.sparkSession, path, checkpoint, epoch_id))
        else:
            w.mode("append").save()


def _start(df: DataFrame, sink: Sink, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return start_query(df, sink.format, checkpoint, trigger=trigger, options=sink.options)


def _reject_rows(df: DataFrame, already_split: bool = False) -> DataFrame:
    cols = [c for c in ("key", "timestamp") if c in df.columns]
    return (df if already_split else rejects(df)).select(*cols, "value", "reason")


@dataclass
class Job:
    """The running queries of one job; ``stages`` feed the others."""
    result: StreamingQuery
    rejects: list[StreamingQuery]
    stages: list[StreamingQuery] = field(default_factory=list)

    @property
    def queries(self) -> list[StreamingQuery]:
        return [self.result, *self.rejects, *self.stages]

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def await_all(self, poll_seconds: float = 0.2) -> None:
        """Wait until all queries of the job have ended (as they do with an
        ``availableNow`` trigger) or one has failed; then stop the others and
        raise.  A job never goes on without one of its outputs."""
        while True:
            active = [q for q in self.queries if q.isActive]
            failed = [q.exception() for q in self.queries if q not in active and q.exception() is not None]
            if failed:
                self.stop()
                raise failed[0]
            if not active:
                return
            time.sleep(poll_seconds)


# ---------------------------------------------------------------- P1

def route_rows(scored: DataFrame, good_topic: str, bad_topic: str) -> DataFrame:
    """``key, value, topic`` rows: good records as they are, bad ones with the reason."""
    good = F.col("_reject").isNull()
    bad = F.to_json(F.struct("value", F.col("_reject").alias("reason")))
    return scored.select(F.lit(None).cast("string").alias("key"), F.when(good, F.col("value")).otherwise(bad).alias("value"),
                         F.when(good, F.lit(good_topic)).otherwise(F.lit(bad_topic)).alias("topic"))


def classify_job(records: DataFrame, out: Sink, reject: Sink, checkpoint: str, trigger: dict | None = None,
                 lexicon: dict[str, int] | None = None, scorer: Scorer | None = None) -> Job:
    """Every post with its sentiment added, as JSON.

    One query scores each record once and routes it: two Kafka topics of the
    same brokers through a per-row ``topic`` column, other sinks from each
    micro-batch."""
    scored = S.stream_classify(records, lexicon, scorer)
    if out.format == reject.format == "kafka" and {**out.options, "topic": ""} == {**reject.options, "topic": ""}:
        options = {k: v for k, v in out.options.items() if k != "topic"}
        routed = route_rows(scored, out.options["topic"], reject.options["topic"])
        return Job(_start(routed, Sink("kafka", options), f"{checkpoint}/result", trigger), [])

    path = f"{checkpoint}/result"

    def emit(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            out.write_batch(valid(batch).select(F.lit(None).cast("string").alias("key"), "value"), epoch_id, path)
            reject.write_batch(_reject_rows(batch), epoch_id, path)
        finally:
            batch.unpersist()

    return Job(start_foreach_batch(scored, emit, path, trigger=trigger), [])


# ---------------------------------------------------------------- P2

#: what the result and reject queries need of a scored record
SCORED = ["key", "timestamp", "place", "sentiment", "_reject"]


def scored_stage(posts: DataFrame, scorer: Scorer, checkpoint: str, trigger: dict | None = None,
                 retention: str | None = None) -> tuple[StreamingQuery, DataFrame]:
    """Score every parsed post once: the scoring query, and the stream of its
    rows (``SCORED``, and the whole ``value`` of rejected records).

    The rows pass through Spark's own file sink and source, exactly once: a
    batch repeated after a failure is committed once, and readers follow the
    sink's log.  ``retention`` (e.g. ``"7 days"``) lets the log forget older
    files, which may then be deleted.  With an ``availableNow`` trigger the
    step is finished before its readers start."""
    rows = P.score_posts(posts, scorer=scorer)
    rows = rows.select(*[c for c in SCORED if c in rows.columns], F.when(F.col("_reject").isNotNull(), F.col("value")).alias("value"))
    path = f"{checkpoint}/scored/rows"
    make_folder(posts.sparkSession, path)  # a file source needs its folder, which the sink makes with its first batch
    query = start_query(rows, "parquet", f"{checkpoint}/scored/query", path=path, trigger=trigger,
                        options={"retention": retention} if retention else None)
    if (trigger or {}).get("availableNow"):
        query.awaitTermination()
    return query, read_parquet_stream(posts.sparkSession, path, rows.schema)


def state_sentiment_job(records: DataFrame, out: Sink, reject: Sink, checkpoint: str,
                        size: str = "5 seconds", delay: str = S.DEFAULT_DELAY, trigger: dict | None = None,
                        exact: bool = False, lexicon: dict[str, int] | None = None, scorer: Scorer | None = None) -> Job:
    """Per closed window and state, ``{time, place, sentiment, count}``."""
    posts = P.parse_posts(records)
    stages = []
    if scorer is not None:
        stage, scored = scored_stage(posts, scorer, checkpoint, trigger)
        stages.append(stage)
        agg = P.sentiment_by_state(S.with_event_time(valid(scored), "timestamp", delay), "timestamp", size, exact=exact)
        bad = _reject_rows(scored)
    else:
        agg = S.stream_state_sentiment(valid(posts), "timestamp", size, delay, exact=exact, lexicon=lexicon)
        bad = _reject_rows(P.post_rejects(posts), already_split=True)
    result = to_kafka_rows(agg, ["time", "place", "sentiment", "count"])
    return Job(_start(result, out, f"{checkpoint}/result", trigger),
               [_start(bad, reject, f"{checkpoint}/rejects", trigger)], stages)


# ---------------------------------------------------------------- P3

def trending_job(records: DataFrame, out: Sink, reject: Sink, checkpoint: str,
                 size: str = "4 seconds", slide: str = "2 seconds", k: int = 5,
                 delay: str = S.DEFAULT_DELAY, mode: str = "normal",
                 trigger: dict | None = None, text_col: str = "text", in_plan: bool = False) -> Job:
    """Every closed window's top-k hashtags, ``{time, word, count}``.

    Counts are emitted in append mode and ranked per micro-batch in
    ``foreachBatch`` (a window's counts all arrive in the batch that closes
    it), or with ``in_plan`` by a stateful operator of the plan, whose rows
    any streaming sink takes.  ``mode="raw", text_col="value"`` tokenises the whole raw record,
    case kept (the reference's Spark variant); the default lower-cases the
    ``text`` field."""
    posts = P.parse_records(records, TEXT_FIELDS)
    counts = S.stream_hashtag_counts(valid(posts), "timestamp", size, slide, delay, mode, text_col)
    path = f"{checkpoint}/result"
    if in_plan:
        top = S.top_words_stream(counts, k).withColumn("time", window_time_ms("window_end"))
        with settings(records.sparkSession, state_conf(records.sparkSession)):
            result = _start(to_kafka_rows(top, ["time", "word", "count"]), out, path, trigger)
        return Job(result, [_start(_reject_rows(posts), reject, f"{checkpoint}/rejects", trigger)])

    def emit(top: DataFrame, epoch_id: int) -> None:
        top = top.withColumn("time", window_time_ms("window_end"))
        out.write_batch(to_kafka_rows(top, ["time", "word", "count"]), epoch_id, path)

    q = start_foreach_batch(counts, S.top_k_writer(emit, k), path, trigger=trigger)
    return Job(q, [_start(_reject_rows(posts), reject, f"{checkpoint}/rejects", trigger)])


# ---------------------------------------------------------------- P4

def sentiment_weather_job(post_records: DataFrame, weather_records: DataFrame, out: Sink, reject: Sink,
                          checkpoint: str, size: str = "2 seconds", delay: str = S.DEFAULT_DELAY,
                          trigger: dict | None = None, exact: bool = False, lexicon: dict[str, int] | None = None,
                          scorer: Scorer | None = None) -> Job:
    """Per closed window and state, ``{time, place, sentiment, temperature}``.

    P5 is ``snapshot_job`` over the emitted records, or
    ``plans.pipelines.state_snapshot`` over a table of them."""
    posts = P.parse_posts(post_records)
    weather = P.parse_weather(weather_records)
    stages = []
    if scorer is not None:
        stage, scored = scored_stage(posts, scorer, checkpoint, trigger)
        stages.append(stage)
        joined = P.join_weather(S.with_event_time(valid(scored), "timestamp", delay),
                                S.with_event_time(valid(weather), "timestamp", delay), "timestamp", "timestamp", size, exact)
        bad_posts = _reject_rows(scored)
    else:
        joined = S.stream_sentiment_weather(valid(posts), valid(weather), "timestamp", "timestamp", size, delay, exact, lexicon=lexicon)
        bad_posts = _reject_rows(P.post_rejects(posts), True)
    joined = joined.withColumn("time", window_time_ms("window_end"))
    bad = bad_posts.unionByName(_reject_rows(P.weather_rejects(weather), True))
    result = to_kafka_rows(joined, ["time", "place", "sentiment", "temperature"])
    return Job(_start(result, out, f"{checkpoint}/result", trigger),
               [_start(bad, reject, f"{checkpoint}/rejects", trigger)], stages)


# ---------------------------------------------------------------- P5

def start_snapshot(p4: DataFrame, out: Sink, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the newest row of every state, from a stream of P4 rows, in a sink
    that replaces rows by state:

    * ``Sink.table(name)``: Spark's in-memory table, rewritten whole (at most
      50 rows) at every trigger with new rows; ``live_snapshot`` reads it as the
      dashboard's frame (after a restart the table is filled again, from the
      state, by the first trigger with new rows);
    * ``Sink.kafka``: the changed states only, keyed by state code; with a
      compacted topic the newest record of a state replaces the older ones.

    State: one row per state code, for the life of the checkpoint."""
    latest = P.latest_per_state(p4)
    if out.format == "memory":
        return start_query(latest, "memory", checkpoint, output_mode="complete", trigger=trigger, query_name=out.options["queryName"])
    if out.format == "kafka":
        rows = to_kafka_rows(latest.withColumn("time", window_time_ms("window_end")), ["time", "place", "sentiment", "temperature"],
                             key=F.col("place"))
        return start_query(rows, "kafka", checkpoint, output_mode="update", trigger=trigger, options=out.options)
    raise ValueError(f"a {out.format} sink cannot replace rows by state; use a table or Kafka")


def live_snapshot(spark: SparkSession, name: str) -> DataFrame:
    """P5's 50-row frame as of the last trigger of ``start_snapshot``."""
    return P.snapshot_frame(spark.table(name))


def snapshot_job(records: DataFrame, out: Sink, reject: Sink, checkpoint: str, trigger: dict | None = None) -> Job:
    """P5 on a live feed of P4's JSON records."""
    rows = P.parse_state_weather(records)
    return Job(start_snapshot(valid(rows), out, f"{checkpoint}/result", trigger),
               [_start(_reject_rows(rows), reject, f"{checkpoint}/rejects", trigger)])


# ---------------------------------------------------------------- command line

JOBS: dict[str, Callable[..., Job]] = {
    "classify": classify_job,
    "state-sentiment": state_sentiment_job,
    "trending": trending_job,
    "sentiment-weather": sentiment_weather_job,
    "state-snapshot": snapshot_job,
}

# the job parameters each command takes from the command line
PARAMETERS = {
    "classify": ("lexicon", "scorer"),
    "state-sentiment": ("size", "delay", "exact", "lexicon", "scorer"),
    "trending": ("size", "slide", "k", "delay", "mode", "text_col", "in_plan"),
    "sentiment-weather": ("size", "delay", "exact", "lexicon", "scorer"),
    "state-snapshot": (),
}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="chirpwave.streaming.jobs")
    ap.add_argument("job", choices=list(JOBS))
    ap.add_argument("--brokers", required=True)
    ap.add_argument("--topics", required=True, help="comma list of input topics")
    ap.add_argument("--weather-topics", help="sentiment-weather only (required there)")
    ap.add_argument("--out-topic", required=True)
    ap.add_argument("--reject-topic", default=None)
    ap.add_argument("--checkpoint", required=True, help="shared folder for offsets and state")
    ap.add_argument("--trigger", default=DEFAULT_TRIGGER)
    ap.add_argument("--starting-offsets", default="now", help="now (both queries from this moment), earliest, or the connector's JSON")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=None, help="bounds a micro-batch, so a backlog is worked off in steps")
    ap.add_argument("--state-partitions", type=int, default=None,
                    help="partitions of the window state, fixed by a checkpoint's first run (default: the cores at start)")
    ap.add_argument("--delay", help='watermark delay, e.g. "10 seconds"; required by the windowed jobs')
    ap.add_argument("--size", help="window size")
    ap.add_argument("--slide", help="trending only")
    ap.add_argument("--k", type=int, help="trending only")
    ap.add_argument("--mode", choices=["normal", "raw"], help="trending only: tokenizer")
    ap.add_argument("--text-col", choices=["text", "value"], help="trending only: the text field or the whole raw record")
    ap.add_argument("--in-plan", action="store_true", default=None, help="trending only: rank in a stateful operator, not in foreachBatch")
    ap.add_argument("--exact", action="store_true", default=None, help="exact instead of integer means")
    ap.add_argument("--lexicon", help="JSON file of word weights")
    ap.add_argument("--model", help="module:function that loads a sentiment model (see functions.sentiment.model_scorer)")
    return ap


def job_parameters(a: argparse.Namespace) -> dict:
    """Keyword arguments of the job from the command line."""
    given = {"size": a.size, "slide": a.slide, "k": a.k, "delay": a.delay, "mode": a.mode, "text_col": a.text_col, "exact": a.exact,
             "in_plan": a.in_plan,
             "lexicon": None, "scorer": None}
    if a.lexicon:
        with open(a.lexicon, encoding="utf-8") as f:
            given["lexicon"] = json.load(f)
    if a.model:
        from ..functions.sentiment import model_scorer
        module, _, name = a.model.partition(":")
        given["scorer"] = model_scorer(getattr(importlib.import_module(module), name), model_key=a.model)
    given = {k: v for k, v in given.items() if v is not None}
    unknown = sorted(set(given) - set(PARAMETERS[a.job]))
    if unknown:
        raise SystemExit(f"{a.job} does not take: {', '.join(unknown)}")
    if "delay" in PARAMETERS[a.job] and "delay" not in given:
        raise SystemExit(f"{a.job} needs --delay: rows later than the watermark are dropped (and counted in the log)")
    if a.job == "sentiment-weather" and not a.weather_topics:
        raise SystemExit("sentiment-weather needs --weather-topics")
    return given


def main(argv: list[str] | None = None) -> None:  # pragma: no cover - needs Kafka
    from ..session import apply_stream_conf
    from ..sources.kafka import read_kafka

    a = parser().parse_args(argv)
    params = job_parameters(a)
    spark = SparkSession.builder.appName(f"chirpwave-{a.job}").getOrCreate()
    apply_stream_conf(spark, a.state_partitions)
    spark.streams.addListener(LateRows())
    out = Sink.kafka(a.brokers, a.out_topic)
    reject = Sink.kafka(a.brokers, a.reject_topic or f"{a.out_topic}-rejects")
    now_ms = int(time.time() * 1000)
    offsets, since = (None, now_ms) if a.starting_offsets == "now" else (a.starting_offsets, None)

    def read(topics: str) -> DataFrame:
        return read_kafka(spark, a.brokers, topics, starting_offsets=offsets or "latest", since_ms=since,
                          max_offsets_per_trigger=a.max_offsets_per_trigger)

    sources = [read(a.topics)] + ([read(a.weather_topics)] if a.job == "sentiment-weather" else [])
    JOBS[a.job](*sources, out, reject, a.checkpoint, trigger={"processingTime": a.trigger}, **params).await_all()


if __name__ == "__main__":  # pragma: no cover
    main()
