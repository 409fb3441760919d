"""The streaming jobs, end to end, with file sources and sinks."""
import json

import pytest
from pyspark.sql import functions as F

from chirpwave.functions.sentiment import model_scorer
from chirpwave.plans import pipelines as P
from chirpwave.plans.queries import corrupted_post_records
from chirpwave.session import scratch_path
from chirpwave.sources import feeds
from chirpwave.sources.tables import read_parquet_stream
from chirpwave.streaming import jobs as J
from conftest import SF0001

ONCE = {"availableNow": True}


def _landed(spark, df, base, name, sentinel_days=60):
    """Records as a file stream, plus a far-future copy of one row so
    every real window closes."""
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = f"{base}/{name}"
    df.write.parquet(path)
    late = df.limit(1).withColumn("timestamp", F.col("timestamp") + F.expr(f"INTERVAL {sentinel_days} DAYS"))
    late.write.mode("append").parquet(path)
    return read_parquet_stream(spark, path, df.schema)


def test_classify_job(spark):
    base = scratch_path(spark, "job-p1")
    recs = corrupted_post_records(spark, SF0001)
    stream = _landed(spark, recs, base, "in")
    job = J.classify_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"),
                         f"{base}/ckpt", trigger=ONCE)
    job.await_all()
    out = spark.read.parquet(f"{base}/out")
    rej = spark.read.parquet(f"{base}/rej")
    n = recs.count() + 1
    assert out.count() + rej.count() == n
    assert rej.where("reason = 'malformed'").count() >= 1
    one = json.loads(out.first().value)
    assert set(one) == {"id", "text", "place_full_name", "sentiment"}


def test_state_sentiment_job_matches_batch(spark):
    base = scratch_path(spark, "job-p2")
    stream = _landed(spark, feeds.post_records(spark, SF0001), base, "in")
    job = J.state_sentiment_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"),
                                f"{base}/ckpt", size="1 day", trigger=ONCE)
    job.await_all()
    # the first run's watermark closes nothing yet; a second run closes the windows
    job = J.state_sentiment_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"),
                                f"{base}/ckpt", size="1 day", trigger=ONCE)
    job.await_all()
    got = spark.read.parquet(f"{base}/out").select(
        F.from_json("value", "time long, place string, sentiment double, count long").alias("r")).select("r.*")
    want = P.state_sentiment(feeds.posts(spark, SF0001), "ts", "1 day").select("time", "place", "sentiment", "count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(f"{base}/rej").count() == 0


def test_trending_job_matches_batch(spark):
    base = scratch_path(spark, "job-p3")
    stream = _landed(spark, feeds.post_records(spark, SF0001), base, "in")
    for _ in range(2):
        J.trending_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"), f"{base}/ckpt",
                       size="4 hours", slide="2 hours", trigger=ONCE).await_all()
    got = spark.read.parquet(f"{base}/out").select(
        F.from_json("value", "time long, word string, count long").alias("r")).select("r.*")
    want = (P.trending_topics(feeds.posts(spark, SF0001), "ts", "4 hours", "2 hours", 5)
            .select((F.unix_millis(F.col("window_end").cast("timestamp")) - 1).alias("time"), "word", "count"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sentiment_weather_job_matches_batch(spark):
    base = scratch_path(spark, "job-p4")
    posts = _landed(spark, feeds.post_records(spark, SF0001), base, "posts")
    weather = _landed(spark, feeds.weather_records(spark, SF0001), base, "weather")
    for _ in range(2):
        J.sentiment_weather_job(posts, weather, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"),
                                f"{base}/ckpt", size="1 day", trigger=ONCE).await_all()
    got = spark.read.parquet(f"{base}/out").select(
        F.from_json("value", "time long, place string, sentiment double, temperature double").alias("r")).select("r.*")
    want = P.sentiment_weather(feeds.posts(spark, SF0001), feeds.weather(spark, SF0001), "ts", size="1 day")
    want = want.select((F.unix_millis(F.col("window_end").cast("timestamp")) - 1).alias("time"),
                       "place", "sentiment", "temperature")
    last = want.agg(F.max("time")).first()[0]
    # the far-future copies form a window of their own: not part of the data
    got_rows = sorted(map(tuple, got.where(F.col("time") <= last).collect()))
    assert got_rows == sorted(map(tuple, want.collect()))


def test_stream_state_is_evicted_after_the_watermark(spark):
    """Aggregation and join state hold only open windows: after the
    far-future rows move the watermark, the closed windows are removed."""
    base = scratch_path(spark, "job-state")
    posts = _landed(spark, feeds.post_records(spark, SF0001), base, "posts")
    weather = _landed(spark, feeds.weather_records(spark, SF0001), base, "weather")
    job = J.sentiment_weather_job(posts, weather, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"),
                                  f"{base}/ckpt", size="1 day", trigger=ONCE)
    job.await_all()
    last = job.result.recentProgress[-1]["stateOperators"]
    by_op = {}
    for op in last:
        by_op.setdefault(op["operatorName"], []).append(op["numRowsTotal"])
    assert by_op["symmetricHashJoin"] == [0]
    assert all(n <= 1 for n in by_op["stateStoreSave"])   # only the far-future window is open


def test_trending_job_raw_record_mode(spark):
    """Raw tokens of the whole JSON record (the reference's Spark variant)."""
    base = scratch_path(spark, "job-p3raw")
    recs = feeds.post_records(spark, SF0001)
    stream = _landed(spark, recs, base, "in")
    for _ in range(2):
        J.trending_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"), f"{base}/ckpt",
                       size="4 hours", slide="2 hours", mode="raw", text_col="value", trigger=ONCE).await_all()
    got = spark.read.parquet(f"{base}/out").select(
        F.from_json("value", "time long, word string, count long").alias("r")).select("r.*")
    want = (P.trending_topics(recs.withColumnRenamed("timestamp", "ts"), "ts", "4 hours", "2 hours", 5,
                              mode="raw", text_col="value")
            .select((F.unix_millis(F.col("window_end").cast("timestamp")) - 1).alias("time"), "word", "count"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where(F.col("word").contains('"')).count() > 0   # raw JSON punctuation stays in tokens


def test_classify_routes_every_record_to_one_topic(spark):
    scored = P.classify_posts(corrupted_post_records(spark, SF0001))
    rows = J.route_rows(scored, "good", "bad").collect()
    assert len(rows) == scored.count()
    for r in rows:
        record = json.loads(r.value)  # every output parses, whatever the record was
        assert r.topic == ("bad" if "reason" in record else "good")
        assert r.topic == "bad" or "sentiment" in record


def _scorer():
    """A stand-in model: long sentences get no class."""
    return model_scorer(lambda: lambda sentences: [None if len(s) > 200 else len(s) % 5 for s in sentences])


def test_model_scorer_in_the_windowed_jobs(spark):
    """Good plus rejected rows are all rows, the model's refusals included."""
    base = scratch_path(spark, "job-model")
    recs = feeds.post_records(spark, SF0001)
    posts = _landed(spark, recs, base, "posts")
    weather = _landed(spark, feeds.weather_records(spark, SF0001), base, "weather")
    scorer = _scorer()
    for _ in range(2):
        J.state_sentiment_job(posts, J.Sink.files(f"{base}/out2"), J.Sink.files(f"{base}/rej2"), f"{base}/ckpt2",
                              size="1 day", trigger=ONCE, scorer=scorer).await_all()
        J.sentiment_weather_job(posts, weather, J.Sink.files(f"{base}/out4"), J.Sink.files(f"{base}/rej4"), f"{base}/ckpt4",
                                size="1 day", trigger=ONCE, scorer=scorer).await_all()
    counts = spark.read.parquet(f"{base}/out2").select(F.get_json_object("value", "$.count").cast("long").alias("n"))
    good = counts.agg(F.sum("n")).first()[0]
    bad = spark.read.parquet(f"{base}/rej2").where(F.col("timestamp") < "2030-01-01")
    refused = bad.where("reason = 'unscored:text'").count()
    assert refused > 0
    whole = recs.count()
    future = spark.read.parquet(f"{base}/posts").count() - whole  # the far-future copy, if the model scored it, is still open
    assert whole <= good + bad.count() <= whole + future
    want = P.sentiment_weather(feeds.posts(spark, SF0001), feeds.weather(spark, SF0001), "ts", size="1 day", scorer=scorer)
    got = spark.read.parquet(f"{base}/out4").select(F.from_json("value", "time long, place string, sentiment double").alias("r")).select("r.*")
    want = want.select((F.unix_millis(F.col("window_end").cast("timestamp")) - 1).alias("time"), "place", "sentiment")
    last = want.agg(F.max("time")).first()[0]
    assert sorted(map(tuple, got.where(F.col("time") <= last).collect())) == sorted(map(tuple, want.collect()))


def test_a_model_scores_every_record_once(spark):
    """Result and rejects share one scoring pass."""
    base = scratch_path(spark, "job-once")
    log = scratch_path(spark, "calls")
    recs = feeds.post_records(spark, SF0001)
    posts = _landed(spark, recs, base, "posts")
    weather = _landed(spark, feeds.weather_records(spark, SF0001), base, "weather")

    def load():
        import os
        import uuid
        os.makedirs(log, exist_ok=True)

        def model(sentences):
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write("x" * len(sentences))
            return [None if len(s) > 200 else len(s) % 5 for s in sentences]
        return model

    def calls():
        import os
        return sum(os.path.getsize(f"{log}/{name}") for name in os.listdir(log)) if os.path.isdir(log) else 0

    texts = spark.read.parquet(f"{base}/posts").where("get_json_object(value, '$.text') <> ''").count()
    scorer = model_scorer(load)
    for _ in range(2):
        J.state_sentiment_job(posts, J.Sink.files(f"{base}/out2"), J.Sink.files(f"{base}/rej2"), f"{base}/ckpt2",
                              size="1 day", trigger=ONCE, scorer=scorer).await_all()
    assert calls() == texts
    for _ in range(2):
        J.sentiment_weather_job(posts, weather, J.Sink.files(f"{base}/out4"), J.Sink.files(f"{base}/rej4"), f"{base}/ckpt4",
                                size="1 day", trigger=ONCE, scorer=scorer).await_all()
    assert calls() == 2 * texts


def test_a_fickle_model_loses_no_record(spark):
    """A model that refuses at random: a record is in the result or in the rejects, never in both or none."""
    import random
    base = scratch_path(spark, "job-fickle")
    recs = feeds.post_records(spark, SF0001)
    posts = _landed(spark, recs, base, "posts")
    scorer = model_scorer(lambda: lambda sentences: [random.choice([None, 2]) for _ in sentences])
    for _ in range(2):
        J.state_sentiment_job(posts, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"), f"{base}/ckpt",
                              size="1 day", trigger=ONCE, scorer=scorer).await_all()
    good = spark.read.parquet(f"{base}/out").agg(F.sum(F.get_json_object("value", "$.count").cast("long"))).first()[0]
    bad = spark.read.parquet(f"{base}/rej")
    late = bad.where("timestamp >= '2030-01-01'").count()
    last = spark.read.parquet(f"{base}/posts").agg(F.max("timestamp")).first()[0]
    refused_copy = bad.where(F.col("timestamp") == F.lit(last)).count()
    assert late == 0 and bad.count() > 0
    # without the far-future copy, unless the model refused just that one: then nothing closed the last windows
    if refused_copy == 0:
        assert good + bad.count() == recs.count()


def test_trending_job_ranked_in_the_plan(spark):
    base = scratch_path(spark, "job-inplan")
    stream = _landed(spark, feeds.post_records(spark, SF0001), base, "in")
    for _ in range(2):
        J.trending_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej"), f"{base}/ckpt",
                       size="4 hours", slide="2 hours", trigger=ONCE, in_plan=True).await_all()
    got = spark.read.parquet(f"{base}/out").select(
        F.from_json("value", "time long, word string, count long").alias("r")).select("r.*")
    want = (P.trending_topics(feeds.posts(spark, SF0001), "ts", "4 hours", "2 hours", 5)
            .select((F.unix_millis(F.col("window_end").cast("timestamp")) - 1).alias("time"), "word", "count"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_model_refusals_have_their_own_reason(spark):
    df = spark.createDataFrame([("ok. " + "x" * 300, "Texas"), ("short", "Texas"), ("", "Texas"), (None, "Texas")],
                               "text string, place_full_name string")
    rows = P.score_posts(df, scorer=_scorer()).collect()
    assert [r["_reject"] for r in rows] == ["unscored:text", None, "empty:text", "empty:text"]
    bad = P.post_rejects(df, scorer=_scorer()).collect()
    assert sorted(r["reason"] for r in bad) == ["empty:text", "empty:text", "unscored:text"]


def test_a_new_checkpoint_keeps_earlier_output(spark):
    base = scratch_path(spark, "job-restart")
    stream = _landed(spark, feeds.post_records(spark, SF0001), base, "in")

    def run(checkpoint):
        for _ in range(2):
            J.trending_job(stream, J.Sink.files(f"{base}/out"), J.Sink.files(f"{base}/rej-{checkpoint}"), f"{base}/{checkpoint}",
                           size="1 day", slide="1 day", trigger=ONCE).await_all()
        return spark.read.parquet(f"{base}/out").count()

    first = run("a")
    assert first > 0 and run("a") == first       # a restart repeats nothing
    assert run("b") == 2 * first                 # a new checkpoint reads all again and overwrites nothing


class _Query:
    def __init__(self, lives, error=None):
        self.lives, self.error, self.stopped = lives, error, False

    @property
    def isActive(self):
        self.lives -= 1
        return self.lives >= 0

    def exception(self):
        return self.error

    def stop(self):
        self.stopped = True


def test_a_dead_reject_query_ends_the_job():
    result, bad = _Query(10**6), _Query(2, RuntimeError("sink lost"))
    with pytest.raises(RuntimeError, match="sink lost"):
        J.Job(result, [bad]).await_all(poll_seconds=0)
    assert result.stopped and bad.stopped


def test_command_line_parameters(tmp_path):
    base = ["--brokers", "b", "--topics", "t", "--out-topic", "o", "--checkpoint", "/c"]
    a = J.parser().parse_args(["trending", *base, "--delay", "5 seconds", "--k", "3", "--mode", "raw", "--text-col", "value",
                               "--slide", "1 second", "--size", "2 seconds", "--max-offsets-per-trigger", "1000", "--state-partitions", "16"])
    assert J.job_parameters(a) == {"delay": "5 seconds", "k": 3, "mode": "raw", "text_col": "value", "slide": "1 second", "size": "2 seconds"}
    assert (a.max_offsets_per_trigger, a.state_partitions, a.starting_offsets) == (1000, 16, "now")
    words = tmp_path / "words.json"
    words.write_text('{"fine": 2}')
    a = J.parser().parse_args(["state-sentiment", *base, "--delay", "0 seconds", "--exact", "--lexicon", str(words)])
    assert J.job_parameters(a) == {"delay": "0 seconds", "exact": True, "lexicon": {"fine": 2}}
    a = J.parser().parse_args(["classify", *base, "--model", "json:loads"])
    assert set(J.job_parameters(a)) == {"scorer"}
    for bad in (["state-sentiment"], ["classify", "--delay", "1 second"], ["sentiment-weather", "--delay", "1 second"]):
        with pytest.raises(SystemExit):
            J.job_parameters(J.parser().parse_args([bad[0], *base, *bad[1:]]))
