"""The registered queries: one per operator / pipeline, each with its
DuckDB oracle.  Every query reads the supplied tables (through the derived
post and weather feeds) in full.

Data time: the feeds average one event every few minutes, so the queries
use hours and days where the reference uses seconds; the library
defaults keep the reference's seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions.numeric import window_time_ms
from ..functions.places import state_code
from ..functions.sentiment import model_scorer, sentiment
from ..functions.text import hashtags, longest_sentence
from ..operators.topk import top_k
from ..operators.windows import window_totals
from ..sources import feeds
from ..sources.states import states_values_sql
from . import oracle as O
from . import pipelines as P

# Fixed parameters of the registered queries.
SLIDING = ("4 hours", "2 hours")
MANY_PANES = ("24 hours", "2 hours")
TUMBLING = "1 hour"
DAY = "1 day"
K = 5
CORRUPT_EVERY = 97  # every 97th record is corrupted, cycling through 5 kinds


# ---------------------------------------------------------------- C1-C3

def q_parse_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Post JSON records parsed back to typed columns (valid rows)."""
    parsed = P.parse_posts(feeds.post_records(spark, sf))
    return R.valid(parsed).select("id", F.col("timestamp").alias("ts"), "text", "place_full_name")


def q_parse_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Weather JSON records parsed back (int field from number or text)."""
    parsed = P.parse_weather(feeds.weather_records(spark, sf))
    return R.valid(parsed).select(F.col("timestamp").alias("ts"), "state", "temperature")


def corrupted_post_records(spark: SparkSession, sf: str) -> DataFrame:
    """Post records where every 97th one is damaged in one of five ways:
    closing brace lost (malformed), text missing, text a number, text
    empty, more text after the object (trailing).  Every record keeps its
    whole text."""
    p = feeds.posts(spark, sf)
    kind = (F.col("id").cast("long") % (CORRUPT_EVERY * 5))
    ok = F.to_json(F.struct("id", "text", "place_full_name"))
    value = (F.when(kind == 0, F.regexp_replace(ok, "}$", ""))
              .when(kind == CORRUPT_EVERY, F.to_json(F.struct("id", "place_full_name")))
              .when(kind == 2 * CORRUPT_EVERY, F.to_json(F.struct("id", F.length("text").alias("text"), "place_full_name")))
              .when(kind == 3 * CORRUPT_EVERY, F.to_json(F.struct("id", F.lit("").alias("text"), "place_full_name")))
              .when(kind == 4 * CORRUPT_EVERY, F.concat(ok, F.lit(" "), ok))
              .otherwise(ok))
    return p.select(F.col("id").alias("key"), value.alias("value"), F.col("ts").alias("timestamp"))


def q_reject_records(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged records and the reason each is rejected."""
    parsed = P.parse_posts(corrupted_post_records(spark, sf))
    return P.post_rejects(parsed).select("key", "reason")


# ---------------------------------------------------------------- C6

def q_state_codes(spark: SparkSession, sf: str) -> DataFrame:
    """State code of every post's place (trimmed)."""
    p = feeds.places(spark, sf)
    return p.select("id", "place_full_name", state_code("place_full_name").alias("code"))


def q_state_codes_raw(spark: SparkSession, sf: str) -> DataFrame:
    """State code with the two-letter part untrimmed (parity mode)."""
    p = feeds.places(spark, sf)
    return p.select("id", "place_full_name", state_code("place_full_name", trim=False).alias("code"))


def q_weather_state_codes(spark: SparkSession, sf: str) -> DataFrame:
    """C6 on the weather feed's place spellings, with row counts."""
    w = feeds.weather(spark, sf)
    return w.groupBy("state").agg(F.count(F.lit(1)).alias("n")).select(
        "state", state_code("state").alias("code"), "n")


# ---------------------------------------------------------------- C12

def q_longest_sentence(spark: SparkSession, sf: str) -> DataFrame:
    """Longest sentence of every post's whole text."""
    p = feeds.posts(spark, sf)
    return p.select("id", longest_sentence("text").alias("longest"))


def q_sentiment_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment -2..2 of every post."""
    p = feeds.posts(spark, sf)
    return p.select("id", sentiment("text").alias("sentiment"))


# ---------------------------------------------------------------- C4 / P1

def _read_back(df: DataFrame) -> DataFrame:
    schema = "id string, text string, place_full_name string, sentiment int"
    j = F.from_json(F.col("value"), schema)
    return df.select(j.alias("r"), F.size(F.json_object_keys("value")).alias("n_fields")).select("r.*", "n_fields")


def q_enrich_json(spark: SparkSession, sf: str) -> DataFrame:
    """C4: each post record with a sentiment field added, read back."""
    recs = feeds.post_records(spark, sf)
    enriched = recs.select(R.enrich_json("value", "sentiment", sentiment(
        F.get_json_object("value", "$.text"))).alias("value"))
    return _read_back(enriched)


def q_classify_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Classified post records, read back."""
    out = R.valid(P.classify_posts(feeds.post_records(spark, sf)))
    return _read_back(out.select("value")).drop("n_fields")


# ---------------------------------------------------------------- C9, A1, T1-T3, P3

def q_hashtags(spark: SparkSession, sf: str) -> DataFrame:
    """Hashtags of every post (normal tokenizer)."""
    p = feeds.posts(spark, sf)
    return p.select("id", F.explode(hashtags("text", "normal")).alias("tag"))


def q_hashtags_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Hashtags of every whole raw record (raw tokenizer)."""
    p = feeds.post_records(spark, sf)
    return p.select(F.col("key").alias("id"), F.explode(hashtags("value", "raw")).alias("tag"))


def q_hashtag_counts_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Hashtag counts per 4 h window sliding by 2 h."""
    return P.hashtag_counts(feeds.posts(spark, sf), "ts", *SLIDING)


def q_hashtag_counts_many_panes(spark: SparkSession, sf: str) -> DataFrame:
    """A1 over windows of twelve panes, counted by pane."""
    return P.hashtag_counts(feeds.posts(spark, sf), "ts", *MANY_PANES)


def q_hashtag_counts_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Hashtag counts per 1 h window."""
    return P.hashtag_counts(feeds.posts(spark, sf), "ts", TUMBLING, None)


def q_hashtag_window_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Hashtag occurrences per sliding window over all words."""
    return window_totals(P.tag_rows(feeds.posts(spark, sf)), "ts", *SLIDING)


def q_top_words_global(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 most frequent hashtags overall."""
    tags = P.tag_rows(feeds.posts(spark, sf))
    counts = tags.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return top_k(counts, K, P.topk_order())


def q_trending_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Top-5 hashtags of every 4 h / 2 h window."""
    return P.trending_topics(feeds.posts(spark, sf), "ts", *SLIDING, k=K)


def q_trending_topics_raw(spark: SparkSession, sf: str) -> DataFrame:
    """P3 with the raw tokenizer over whole raw records."""
    return P.trending_topics(feeds.post_records(spark, sf), "timestamp", *SLIDING, k=K, mode="raw", text_col="value")


# ---------------------------------------------------------------- P2, A5, P4, P5, C13, K1

def q_state_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Squashed mean sentiment and count per state and day."""
    return P.state_sentiment(feeds.posts(spark, sf), "ts", DAY)


def stand_in_model() -> Callable[[Column], Column]:
    """A model any test can restate: the class is the sentence's length modulo 6."""
    return model_scorer(lambda: lambda sentences: [len(s) % 6 for s in sentences])


def q_state_sentiment_model(spark: SparkSession, sf: str) -> DataFrame:
    """P2 with a user's model in place of the lexicon, over records of which
    some are corrupt."""
    posts = R.valid(P.parse_posts(corrupted_post_records(spark, sf))).withColumnRenamed("timestamp", "ts")
    return P.state_sentiment(posts, "ts", DAY, scorer=stand_in_model()).select("time", "place", "sentiment", "count")


def q_state_sentiment_no_id(spark: SparkSession, sf: str) -> DataFrame:
    """P2 from JSON records of which a third have a numeric id and a third none."""
    posts = R.valid(P.parse_posts(feeds.post_records_mixed_ids(spark, sf)))
    return P.state_sentiment(posts.withColumnRenamed("timestamp", "ts"), "ts", DAY)


def q_state_sentiment_exact(spark: SparkSession, sf: str) -> DataFrame:
    """P2 with the exact (non-integer) mean, D1."""
    return P.state_sentiment(feeds.posts(spark, sf), "ts", DAY, exact=True)


def q_state_temperature(spark: SparkSession, sf: str) -> DataFrame:
    """A5: mean temperature per state and day."""
    return P.weather_by_state(feeds.weather(spark, sf), "ts", DAY)


def q_sentiment_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Per state and day, sentiment joined with temperature."""
    return P.sentiment_weather(feeds.posts(spark, sf), feeds.weather(spark, sf), "ts", size=DAY)


def q_state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """P5: the dashboard's 50-state frame from P4."""
    return P.state_snapshot(q_sentiment_weather(spark, sf))


def q_window_time_ms(spark: SparkSession, sf: str) -> DataFrame:
    """Window end as epoch milliseconds (1 h windows)."""
    r = P.state_sentiment(feeds.posts(spark, sf), "ts", TUMBLING)
    return r.select("window_start", "window_end", "place", window_time_ms("window_end").alias("time"))


def q_state_sentiment_records(spark: SparkSession, sf: str) -> DataFrame:
    """P2 as the JSON records its sink writes ({time, place, sentiment, count})."""
    return P.state_sentiment_json(P.state_sentiment(feeds.posts(spark, sf), "ts", DAY))


def q_sentiment_weather_records(spark: SparkSession, sf: str) -> DataFrame:
    """K1: P4 as the JSON records its sink writes ({time, place, sentiment, temperature})."""
    r = q_sentiment_weather(spark, sf).withColumn("time", window_time_ms("window_end"))
    return r.select(F.to_json(F.struct("time", "place", "sentiment", "temperature")).alias("value"))


def q_kafka_rows(spark: SparkSession, sf: str) -> DataFrame:
    """K1: P3 rows shaped as Kafka key/value JSON records."""
    from ..streaming.sinks import to_kafka_rows
    r = P.trending_topics(feeds.posts(spark, sf), "ts", *SLIDING, k=K)
    r = r.withColumn("time", window_time_ms("window_end"))
    return to_kafka_rows(r, ["time", "word", "count"], key=F.col("word"))


BATCH: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_posts": q_parse_posts,
    "parse_weather": q_parse_weather,
    "reject_records": q_reject_records,
    "state_codes": q_state_codes,
    "state_codes_raw": q_state_codes_raw,
    "weather_state_codes": q_weather_state_codes,
    "longest_sentence": q_longest_sentence,
    "sentiment_scores": q_sentiment_scores,
    "enrich_json": q_enrich_json,
    "classify_posts": q_classify_posts,
    "hashtags": q_hashtags,
    "hashtags_raw": q_hashtags_raw,
    "hashtag_counts_sliding": q_hashtag_counts_sliding,
    "hashtag_counts_many_panes": q_hashtag_counts_many_panes,
    "hashtag_counts_tumbling": q_hashtag_counts_tumbling,
    "hashtag_window_totals": q_hashtag_window_totals,
    "top_words_global": q_top_words_global,
    "trending_topics": q_trending_topics,
    "trending_topics_raw": q_trending_topics_raw,
    "state_sentiment": q_state_sentiment,
    "state_sentiment_model": q_state_sentiment_model,
    "state_sentiment_no_id": q_state_sentiment_no_id,
    "state_sentiment_exact": q_state_sentiment_exact,
    "state_temperature": q_state_temperature,
    "sentiment_weather": q_sentiment_weather,
    "state_snapshot": q_state_snapshot,
    "window_time_ms": q_window_time_ms,
    "kafka_rows": q_kafka_rows,
    "state_sentiment_records": q_state_sentiment_records,
    "sentiment_weather_records": q_sentiment_weather_records,
}


# ---------------------------------------------------------------- oracle SQL

def _oracle() -> dict[str, str]:
    posts = feeds.posts_sql()
    places = feeds.places_sql()
    records = O.raw_records()
    weather = feeds.weather_sql()
    sliding, slide = SLIDING
    c = CORRUPT_EVERY
    corrupt_kind = f"CAST(id AS BIGINT) % {c * 5}"
    snapshot_src = O.sentiment_weather(DAY)
    modelled = O.scored_posts(O.model_expr(), f"CAST(id AS BIGINT) % {c} <> 0")
    return {
        "parse_posts": f"SELECT id, ts, text, place_full_name FROM {posts}",
        "parse_weather": f"SELECT ts, state, temperature FROM {weather}",
        "reject_records": f"""SELECT key, reason FROM (
  SELECT id AS key, CASE {corrupt_kind} WHEN 0 THEN 'malformed' WHEN {c} THEN 'missing:text'
    WHEN {2 * c} THEN 'type:text' WHEN {3 * c} THEN 'empty:text' WHEN {4 * c} THEN 'trailing' END AS reason FROM {posts})
  WHERE reason IS NOT NULL""",
        "state_codes": f"SELECT id, place_full_name, {O.state_code('place_full_name')} AS code FROM {places}",
        "state_codes_raw": f"SELECT id, place_full_name, {O.state_code('place_full_name', trim=False)} AS code FROM {places}",
        "weather_state_codes": f"SELECT state, {O.state_code('state')} AS code, count(*) AS n FROM {weather} GROUP BY state",
        "longest_sentence": f"SELECT id, longest FROM {O.with_longest(posts)}",
        "sentiment_scores": f"SELECT id, {O.sentiment_expr()} AS sentiment FROM {O.with_longest(posts)}",
        "enrich_json": f"SELECT id, text, place_full_name, {O.sentiment_expr()} AS sentiment, 4 AS n_fields FROM {O.with_longest(posts)}",
        "classify_posts": f"SELECT id, text, place_full_name, {O.sentiment_expr()} AS sentiment FROM {O.with_longest(posts)}",
        "hashtags": f"SELECT id, unnest({O.hashtags('text')}) AS tag FROM {posts}",
        "hashtags_raw": f"SELECT id, unnest({O.hashtags('value', 'raw')}) AS tag FROM {records}",
        "hashtag_counts_sliding": f"SELECT * FROM {O.hashtag_counts(sliding, slide)}",
        "hashtag_counts_many_panes": f"SELECT * FROM {O.hashtag_counts(*MANY_PANES)}",
        "hashtag_counts_tumbling": f"SELECT * FROM {O.hashtag_counts(TUMBLING, None)}",
        "hashtag_window_totals": f"SELECT * FROM {O.window_totals(sliding, slide)}",
        "top_words_global": f"""SELECT word, count(*) AS count
  FROM (SELECT unnest({O.hashtags('text')}) AS word FROM {posts})
  GROUP BY word ORDER BY count DESC, word ASC LIMIT {K}""",
        "trending_topics": f"SELECT * FROM {O.trending(sliding, slide, K)}",
        "trending_topics_raw": f"SELECT * FROM {O.trending(sliding, slide, K, 'raw', records, 'value')}",
        "state_sentiment": f"SELECT * FROM {O.state_sentiment(DAY)}",
        "state_sentiment_model": f"SELECT time, place, sentiment, count FROM {O.state_sentiment(DAY, scored=modelled)}",
        "state_sentiment_no_id": f"SELECT * FROM {O.state_sentiment(DAY)}",
        "state_sentiment_exact": f"SELECT * FROM {O.state_sentiment(DAY, exact=True)}",
        "state_temperature": f"SELECT * FROM {O.state_temperature(DAY)}",
        "sentiment_weather": f"SELECT * FROM {snapshot_src}",
        "state_snapshot": f"""SELECT d.state, d.code, l.sentiment, CAST(round(l.temperature) AS INTEGER) AS weather,
  d.state || '<br>temperature : ' || CAST(CAST(round(l.temperature) AS INTEGER) AS VARCHAR) || ' degree' AS text,
  l.window_end AS as_of
FROM {states_values_sql()} d LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY window_end DESC) AS rn FROM {snapshot_src})
  WHERE rn = 1) l ON l.place = d.code""",
        "window_time_ms": f"SELECT window_start, window_end, place, time FROM {O.state_sentiment(TUMBLING)}",
        "state_sentiment_records": f"""SELECT CAST(to_json({{'time': time, 'place': place, 'sentiment': sentiment,
  'count': count}}) AS VARCHAR) AS value FROM {O.state_sentiment(DAY)}""",
        "sentiment_weather_records": f"""SELECT CAST(to_json({{'time': epoch_ms(window_end) - 1, 'place': place,
  'sentiment': sentiment, 'temperature': temperature}}) AS VARCHAR) AS value FROM {snapshot_src}""",
        "kafka_rows": f"""SELECT word AS key, CAST(to_json({{'time': epoch_ms(window_end) - 1, 'word': word, 'count': count}}) AS VARCHAR) AS value
  FROM {O.trending(sliding, slide, K)}""",
    }


def oracle() -> dict[str, str]:
    return _oracle()
