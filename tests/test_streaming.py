"""Streams equal batch on closed windows; late data; sink shapes."""
import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from chirpwave.session import scratch_path
from chirpwave.sources.kafka import kafka_source_options
from chirpwave.sources.tables import read_parquet_stream
from chirpwave.streaming import pipelines as S
from chirpwave.streaming.sinks import kafka_sink_options, to_kafka_rows
from conftest import SF0001
from oracle_compare import canon, duck


@pytest.mark.parametrize("name", ["stream_state_sentiment", "stream_trending", "stream_sentiment_weather",
                                  "stream_classify", "stream_state_snapshot", "stream_state_sentiment_no_id",
                                  "stream_hashtag_counts_paned", "stream_trending_inplan", "stream_state_sentiment_model"])
def test_stream_equals_batch(spark, name):
    df = E.queries()[name](spark, SF0001)
    res = duck(SF0001).sql(E.oracle_sql()[name])
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), res.columns)


def _run(spark, delay):
    base = scratch_path(spark, "late")
    schema = "ts timestamp, word string"
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    first = [(t0, "#a"), (t0 + dt.timedelta(hours=3), "#b")]
    late = [(t0 + dt.timedelta(minutes=5), "#late")]
    spark.createDataFrame(first, schema).write.parquet(f"{base}/in")
    stream = read_parquet_stream(spark, f"{base}/in", spark.createDataFrame(first, schema).schema)
    counts = S.stream_hashtag_counts(stream.withColumnRenamed("word", "text"), "ts", "1 hour", None, delay)
    out, ckpt = f"{base}/out", f"{base}/ckpt"

    def run():
        (counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start().awaitTermination())
    run()
    spark.createDataFrame(late, schema).write.mode("append").parquet(f"{base}/in")
    run()
    spark.createDataFrame([(t0 + dt.timedelta(days=2), "#end")], schema).write.mode("append").parquet(f"{base}/in")
    run()
    run()
    return {r.word for r in spark.read.parquet(out).collect()}


def test_late_data_dropped_at_zero_delay(spark):
    assert "#late" not in _run(spark, "0 seconds")


def test_late_data_kept_with_delay(spark):
    assert "#late" in _run(spark, "6 hours")


def test_kafka_rows_shape(spark):
    df = spark.createDataFrame([("#a", 3)], "word string, count long")
    rows = to_kafka_rows(df).collect()
    assert rows[0].key is None and rows[0].value == '{"word":"#a","count":3}'
    keyed = to_kafka_rows(df, ["count"], key=F.col("word")).first()
    assert keyed.key == "#a" and keyed.value == '{"count":3}'


def test_kafka_options():
    o = kafka_source_options("b1:9092,b2:9092", ["posts", "weather"])
    assert o["subscribe"] == "posts,weather" and o["startingOffsets"] == "latest"
    assert kafka_sink_options("b:9092", "out") == {"kafka.bootstrap.servers": "b:9092", "topic": "out"}


def test_state_sentiment_json_shape(spark):
    import json
    from chirpwave.plans import pipelines as P
    from chirpwave.sources import feeds
    r = P.state_sentiment_json(P.state_sentiment(feeds.posts(spark, SF0001), "ts", "1 day")).first()
    rec = json.loads(r.value)
    assert set(rec) == {"time", "place", "sentiment", "count"} and rec["time"] % 1000 == 999


def test_ingestion_time(spark):
    from chirpwave.sources.kafka import with_ingestion_time
    df = with_ingestion_time(spark.createDataFrame([("a",)], "v string"))
    assert dict(df.dtypes)["timestamp"] == "timestamp" and df.first().timestamp is not None


def test_foreach_batch_helper(spark):
    from chirpwave.streaming.sinks import start_foreach_batch
    base = scratch_path(spark, "feb")
    spark.createDataFrame([("x",), ("y",)], "v string").write.parquet(f"{base}/in")
    seen = []
    q = start_foreach_batch(read_parquet_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema),
                            lambda df, epoch: seen.append(df.count()), f"{base}/ckpt",
                            trigger={"availableNow": True})
    q.awaitTermination()
    assert sum(seen) == 2


def test_kafka_values_decode(spark):
    import datetime as dt
    from chirpwave.sources.kafka import kafka_values
    raw = spark.createDataFrame(
        [(bytearray(b"k1"), bytearray(b'{"text":"hi"}'), "posts", 0, 5, dt.datetime(2024, 1, 1))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    r = kafka_values(raw).first()
    assert (r.key, r.value, r.topic, r.offset) == ("k1", '{"text":"hi"}', "posts", 5)


def test_apply_cluster_conf_keeps_launcher_settings(spark):
    from chirpwave.session import apply_cluster_conf
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "123",
                                         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
                                         "spark.ui.enabled": "true"})
    try:
        # shuffle.partitions was set by the session builder: kept; non-SQL keys are never touched
        assert "spark.sql.shuffle.partitions" not in applied and "spark.ui.enabled" not in applied
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert applied == {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m"}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_start_by_time_replaces_latest():
    o = kafka_source_options("b:9092", "posts", since_ms=1700000000000)
    assert o["startingTimestamp"] == "1700000000000" and "startingOffsets" not in o


def test_stream_settings_are_not_the_batch_settings(spark):
    from chirpwave.session import CLUSTER_CONF, STREAM_CONF, apply_stream_conf
    key = "spark.sql.shuffle.partitions"
    assert key in CLUSTER_CONF and key not in STREAM_CONF
    before = spark.conf.get(key)
    try:
        apply_stream_conf(spark)
        assert spark.conf.get(key) == before  # the launcher's own value
        assert apply_stream_conf(spark, 6)[key] == "6" and spark.conf.get(key) == "6"
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage")


def test_refused_settings_are_reported(spark):
    from chirpwave.session import _apply
    applied, refused = _apply(spark, {"spark.sql.extensions": "x", "spark.sql.cbo.enabled": "false"})
    spark.conf.unset("spark.sql.cbo.enabled")
    assert set(applied) == {"spark.sql.cbo.enabled"} and set(refused) == {"spark.sql.extensions"}


@pytest.mark.parametrize("delay,lost", [("0 seconds", 1), ("6 hours", 0)])
def test_uneven_inputs_and_the_count_of_late_rows(spark, delay, lost):
    """Two inputs consumed unevenly: the slower one's row is behind the
    watermark unless the delay covers it; what is dropped is counted."""
    from chirpwave.streaming.sinks import LateRows
    base = scratch_path(spark, "uneven")
    schema = "ts timestamp, text string"
    t0 = dt.datetime(2024, 1, 1, 12)

    def land(part, *rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(f"{base}/{part}")

    land("fast", (t0, "#a"), (t0 + dt.timedelta(hours=4), "#b"))
    land("slow", (t0, "#c"))
    kind = spark.read.parquet(f"{base}/fast").schema
    both = read_parquet_stream(spark, f"{base}/fast", kind).union(read_parquet_stream(spark, f"{base}/slow", kind))
    counts = S.stream_hashtag_counts(both, "ts", "1 hour", None, delay)
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        for step in range(4):
            if step == 1:
                land("slow", (t0 + dt.timedelta(minutes=5), "#late"))
            if step == 2:
                land("fast", (t0 + dt.timedelta(days=2), "#end"))
            q = (counts.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    words = {r.word for r in spark.read.parquet(f"{base}/out").collect()}
    assert words == {"#a", "#b", "#c"} | (set() if lost else {"#late"})
    assert sum(listener.dropped.values()) == lost


def test_replay_keeps_rows_without_a_time(spark):
    from chirpwave.streaming.replay import replay
    t0 = dt.datetime(2024, 1, 1)
    rows = [("k%d" % i, '{"text":"good"}', t0 + dt.timedelta(hours=i) if i % 3 else None) for i in range(6)]
    records = spark.createDataFrame(rows, "key string, value string, timestamp timestamp")
    out = replay(spark, {"posts": (records, "timestamp", "key")}, lambda s: S.stream_classify(s["posts"]))
    assert out.count() == 6


def _tag_stream(spark, base, rows):
    df = spark.createDataFrame(rows, "ts timestamp, text string")
    df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return read_parquet_stream(spark, f"{base}/in", df.schema)


def _hours(n, tags=7, per_hour=40):
    t0 = dt.datetime(2024, 1, 1)
    return [(t0 + dt.timedelta(seconds=90 * i), f"#t{i % tags} #all") for i in range(n * per_hour)]


def _drain(df, base, name):
    """Run on what is there, twice, so that closed windows leave; the last progress of every batch."""
    progress = []
    for _ in range(2):
        q = df.writeStream.format("parquet").option("path", f"{base}/{name}").option("checkpointLocation", f"{base}/ckpt-{name}") \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        progress += q.recentProgress
    return spark_rows(df.sparkSession, f"{base}/{name}"), progress


def spark_rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=str)


def test_panes_on_a_stream(spark):
    """The same counts; a row is copied nowhere and updates one pane, not every window."""
    base = scratch_path(spark, "paned")
    rows = _hours(20)
    for hour in range(0, 6):  # a file, and so a micro-batch, an hour; the rest closes the windows
        _tag_stream(spark, base, rows[40 * hour:40 * (hour + 1)])
    _tag_stream(spark, base, rows[240:])
    stream = spark.readStream.schema("ts timestamp, text string").option("maxFilesPerTrigger", "1").parquet(f"{base}/in")
    size, slide = "12 hours", "1 hour"
    plain, plain_progress = _drain(S.stream_hashtag_counts(stream, "ts", size, slide, panes=False), base, "plain")
    paned_df = S.stream_hashtag_counts(stream, "ts", size, slide)  # twelve panes: panes by default
    paned, paned_progress = _drain(paned_df, base, "paned")
    assert plain and paned == plain
    plan = paned_df._jdf.queryExecution().analyzed().toString()
    window_copies = plan.index("Expand")  # of the panes' counts ...
    assert "Aggregate" in plan[window_copies:] and plan.count("Expand") == 1  # ... below which the rows are counted

    def updated(progress):  # state rows written by the operator that takes the rows
        return sum(p["stateOperators"][-1]["numRowsUpdated"] for p in progress if p["stateOperators"])

    assert updated(paned_progress) * 3 < updated(plain_progress)
    print("state rows updated by rows:", updated(plain_progress), "plain,", updated(paned_progress), "paned")


def test_panes_need_whole_panes(spark):
    with pytest.raises(ValueError, match="not made of several panes"):
        S.stream_hashtag_counts(spark.createDataFrame([], "ts timestamp, text string"), "ts", "3 hours", "2 hours", panes=True)


def test_in_plan_ranking_keeps_k_rows_a_window(spark):
    base = scratch_path(spark, "inplan")
    stream = _tag_stream(spark, base, _hours(12, tags=400))
    k = 3
    ranked = S.stream_trending_inplan(stream, "ts", "4 hours", "2 hours", k)
    got, progress = _drain(ranked, base, "out")
    batch = spark.read.parquet(f"{base}/in")
    from chirpwave.plans import pipelines as P
    want = P.trending_topics(batch, "ts", "4 hours", "2 hours", k)
    closed = {r[0] for r in got}
    assert len(closed) >= 4 and got == sorted((tuple(r) for r in want.collect() if r["window_start"] in closed), key=str)
    windows = want.select("window_start").distinct().count()
    states = [o for p in progress for o in p["stateOperators"] if o["operatorName"].startswith("transformWithState")]
    assert states and all(o["numRowsTotal"] <= k * windows for o in states)
    assert states[-1]["numRowsTotal"] == 0  # nothing stays of closed windows


PLAIN_SESSION = """
import datetime as dt, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[2] + "/kept").getOrCreate())
from chirpwave.plans import pipelines as P
from chirpwave.streaming import jobs as J
from chirpwave.streaming import replay as R
t0 = dt.datetime(2024, 1, 1)
rows = [(str(i), t0 + dt.timedelta(minutes=7 * i), f"#a{i % 9} #b{i % 4}", "Texas") for i in range(200)]
posts = spark.createDataFrame(rows, "id string, ts timestamp, text string, place_full_name string")
provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
R.feeds.posts = lambda spark, sf: posts
got = R.q_stream_trending_inplan(spark, "")
want = P.trending_topics(posts, "ts", *R.Q.SLIDING, R.Q.K)
ours, batch = (sorted(map(str, df.select("word", "count", "rank", F.unix_millis(F.col("window_start").cast("timestamp"))).collect()))
               for df in (got, want))
assert ours == batch and ours, (ours[:3], batch[:3])
path = sys.argv[2] + "/records"
(posts.select(F.col("id").alias("key"), F.to_json(F.struct("id", "text", "place_full_name")).alias("value"), F.col("ts").alias("timestamp"))
 .write.parquet(path))
records = J.read_parquet_stream(spark, path, spark.read.parquet(path).schema)
J.trending_job(records, J.Sink.files(path + "-out"), J.Sink.files(path + "-bad"), path + "-kept", "4 hours", "2 hours",
               trigger={"availableNow": True}, in_plan=True).await_all()
assert spark.read.parquet(path + "-out").count() > 0
assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider  # the session is left as it was
print("AS", "BATCH", len(ours))
"""


def test_in_plan_ranking_in_a_session_without_our_settings(tmp_path):
    """Spark's default state store, and workers that cannot import the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "plain.py").write_text(PLAIN_SESSION)
    run = subprocess.run([sys.executable, "plain.py", os.path.dirname(os.path.abspath(E.__file__)), str(tmp_path)],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "AS BATCH" in run.stdout, run.stderr[-3000:]


def test_top_words_are_bounded_and_ordered():
    import pandas as pd

    from chirpwave.streaming.topk import best_words
    t = pd.Timestamp("2024-01-01")
    rows = pd.DataFrame({"window_start": t, "window_end": t, "word": ["#b", "#a", "#\U0001F600", "#\uffff", "#z"], "count": [5, 5, 5, 5, 9]})
    assert best_words(rows, 4)["word"].tolist() == ["#z", "#a", "#b", "#\uffff"]  # by code point, as Spark orders


def test_live_snapshot_follows_every_slice(spark):
    from chirpwave.plans import pipelines as P
    from chirpwave.streaming.replay import live_snapshots
    steps = []

    def seen(frame, rows):
        live, batch = ({tuple(r) for r in df.collect()} for df in (frame, P.state_snapshot(rows)))
        steps.append((len(live), live == batch, rows.count()))

    last = live_snapshots(spark, SF0001, seen)
    assert len(steps) == 6 and all(n == 50 and same for n, same, _ in steps)
    assert steps[0][2] < steps[-1][2]
    res = duck(SF0001).sql(E.oracle_sql()["stream_state_snapshot_live"])
    assert canon([tuple(r) for r in last.collect()], last.columns) == canon(res.fetchall(), res.columns)


def test_live_snapshot_restarts_from_its_state(spark):
    from chirpwave.streaming import jobs as J
    base = scratch_path(spark, "live")
    schema = "key string, value string, timestamp timestamp"
    t0 = dt.datetime(2024, 1, 1)

    def land(rows):
        rows = [(None, v, t0) for v in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")

    def record(place, hour, sentiment, temperature):
        return f'{{"time":{hour * 3600000 - 1},"place":"{place}","sentiment":{sentiment},"temperature":{temperature}}}'

    land([record("TX", 1, 0.5, 20.4), record("OH", 2, 0.1, 3), record("UND", 9, 0.9, 9), "{broken", '{"place":"TX"}'])
    table = J.Sink.table("live_" + base.rpartition("-")[2])

    def run():
        stream = read_parquet_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema)
        J.snapshot_job(stream, table, J.Sink.files(f"{base}/rejects"), f"{base}/ckpt", {"availableNow": True}).await_all()
        frame = J.live_snapshot(spark, table.options["queryName"])
        rows = frame.collect()
        assert len(rows) == 50
        return {r["code"]: (r["sentiment"], r["weather"]) for r in rows if r["as_of"] is not None}

    assert run() == {"TX": (0.5, 20), "OH": (0.1, 3)}
    land([record("TX", 3, 0.7, 25), record("OH", 1, 0.9, 30), record("NY", 1, 0.2, -1)])  # one newer, one older, one new
    assert run() == {"TX": (0.7, 25), "OH": (0.1, 3), "NY": (0.2, -1)}
    assert spark.read.parquet(f"{base}/rejects").count() == 2
    with pytest.raises(ValueError, match="cannot replace"):
        J.start_snapshot(spark.createDataFrame([], "window_end timestamp, place string, sentiment double, temperature double"),
                         J.Sink.files(base), base)
