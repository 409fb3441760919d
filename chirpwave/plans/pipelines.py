"""The user-level analyses P1-P5, as DataFrame -> DataFrame functions.

Each works unchanged on a batch table and on a stream (the streaming
module adds watermarks, sinks and the per-batch top-k).  Inputs are
either Kafka-shaped records ``(key, value, timestamp)`` with JSON values
(``parse_posts`` / ``parse_weather``) or already-typed frames with the
post / weather columns.

Bad rows never fail a job: every scoring step marks them in ``_reject``
and ``functions.records.valid`` / ``rejects`` split them off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import hover_label, window_time_ms
from ..functions.places import state_code
from ..functions.records import (POST_EXTRAS, POST_FIELDS, TEXT_FIELDS, WEATHER_FIELDS, add_json_field,
                                 parse_records, to_json_record, valid)
from ..functions.sentiment import sentiment
from ..functions.text import hashtags
from ..operators.joins import join_windows
from ..operators.rows import with_computed
from ..operators.topk import top_k_per_group
from ..operators.windows import MIN_PANES, pane_count, paned_counts, state_sentiment_agg, state_temperature, windowed_counts
from ..sources.states import state_dim


def topk_order() -> list[Column]:
    """Count descending, then word ascending: deterministic ties."""
    return [F.desc("count"), F.asc("word")]


# --------------------------------------------------------------------------
# parsing and scoring (row-local)

def parse_posts(records: DataFrame, keep: tuple[str, ...] = ("key", "timestamp")) -> DataFrame:
    """JSON post records -> ``text, place_full_name, id`` plus ``_reject``.
    The id is optional: no analysis reads it."""
    return parse_records(records, POST_FIELDS, keep=keep, extras=POST_EXTRAS)


def parse_weather(records: DataFrame, keep: tuple[str, ...] = ("key", "timestamp")) -> DataFrame:
    """JSON weather records -> ``state, temperature`` plus ``_reject``."""
    return parse_records(records, WEATHER_FIELDS, keep=keep)


def _add_reject(df: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    """Set ``_reject`` to the first failing check's reason; a reason set
    earlier (parsing) wins.  Checks must be cheap tests on columns that
    are already computed (fenced by ``with_computed``)."""
    reason = F.when(checks[0][0], F.lit(checks[0][1]))
    for cond, why in checks[1:]:
        reason = reason.when(cond, F.lit(why))
    if "_reject" in df.columns:
        reason = F.coalesce(F.col("_reject"), reason)
    return df.withColumn("_reject", reason)


def _text_checks(text_col: str) -> list[tuple[Column, str]]:
    """No text is ``empty``; a text that the scorer gave no class is ``unscored``."""
    return [(F.col(text_col).isNull() | (F.length(text_col) == 0), f"empty:{text_col}"),
            (F.col("sentiment").isNull(), f"unscored:{text_col}")]


def score_posts(posts: DataFrame, lexicon: dict[str, int] | None = None,
                scorer: Callable[[Column], Column] | None = None, trim: bool = True,
                text_col: str = "text", place_col: str = "place_full_name") -> DataFrame:
    """Add ``sentiment`` (-2..2) and ``place`` (state code).  NULL or empty
    text, a text the scorer gave no class, or a NULL place, marks the row in
    ``_reject``."""
    scored = with_computed(posts, sentiment=sentiment(text_col, lexicon, scorer),
                           place=state_code(place_col, trim=trim))
    return _add_reject(scored, [*_text_checks(text_col), (F.col("place").isNull(), f"missing:{place_col}")])


def post_rejects(posts: DataFrame, text_col: str = "text", place_col: str | None = "place_full_name",
                 scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows ``score_posts`` rejects, with the same reasons.

    Without a model they are found by cheap checks on the input alone: the
    lexicon sentiment is NULL exactly when the text is NULL or empty, and the
    state code exactly when the place is NULL, so this output never runs the
    sentence split.  With a ``scorer`` they come from the scored rows: only
    the model knows which texts it gives no class.  ``place_col=None`` checks
    the text only (P1)."""
    if scorer is not None:
        scored = with_computed(posts, sentiment=sentiment(text_col, None, scorer))
        checks = _text_checks(text_col)
    else:
        scored, checks = posts, [(F.col(text_col).isNull() | (F.length(text_col) == 0), f"empty:{text_col}")]
    if place_col:
        checks.append((F.col(place_col).isNull(), f"missing:{place_col}"))
    out = _add_reject(scored, checks)
    return out.where(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reason")


def weather_rejects(weather: DataFrame, state_col: str = "state") -> DataFrame:
    """The rows ``score_weather`` rejects, by the same cheap checks."""
    out = _add_reject(weather, [(F.col(state_col).isNull(), f"missing:{state_col}"),
                                (F.col("temperature").isNull(), "missing:temperature")])
    return out.where(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reason")


def score_weather(weather: DataFrame, trim: bool = True, state_col: str = "state") -> DataFrame:
    """Add ``place`` (state code); a NULL state or temperature is a reject."""
    scored = with_computed(weather, place=state_code(state_col, trim=trim))
    return _add_reject(scored, [(F.col("place").isNull(), f"missing:{state_col}"),
                                (F.col("temperature").isNull(), "missing:temperature")])


# --------------------------------------------------------------------------
# P1

def classify_posts(records: DataFrame, lexicon: dict[str, int] | None = None,
                   scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each JSON post with a ``sentiment`` field added, every other
    field kept; a rejected record's ``value`` is as it came.
    Output ``key, timestamp, value, sentiment, _reject``."""
    # P1 reads only the text; the place is neither needed nor checked
    # each record is parsed once: the enrichment reuses the parsed variant
    parsed = parse_records(records, TEXT_FIELDS, keep_variant=True)
    scored = with_computed(parsed, sentiment=sentiment("text", lexicon, scorer))
    scored = _add_reject(scored, _text_checks("text"))
    cols = [c for c in ("key", "timestamp") if c in scored.columns]
    value = F.when(F.col("_reject").isNull(), add_json_field("value", "_v", "sentiment", F.col("sentiment")))
    return scored.select(*cols, value.otherwise(F.col("value")).alias("value"), "sentiment", "_reject")


# --------------------------------------------------------------------------
# P2

def sentiment_by_state(scored: DataFrame, ts: str = "ts", size: str = "5 seconds", slide: str | None = None,
                       exact: bool = False) -> DataFrame:
    """P2 from rows that are scored already (``ts, place, sentiment``)."""
    agg = state_sentiment_agg(scored.select(ts, "place", "sentiment"), ts, size, slide, exact=exact)
    return agg.withColumn("time", window_time_ms("window_end"))


def state_sentiment(posts: DataFrame, ts: str = "ts", size: str = "5 seconds", slide: str | None = None,
                    exact: bool = False, trim: bool = True, lexicon: dict[str, int] | None = None,
                    scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Per window and state, squashed mean sentiment and post count.

    Output ``window_start, window_end, place, sentiment, count, time``
    (``time`` = last millisecond of the window).
    """
    return sentiment_by_state(valid(score_posts(posts, lexicon, scorer, trim=trim)), ts, size, slide, exact)


def state_sentiment_json(result: DataFrame) -> DataFrame:
    """P2 records as the JSON written to the sink."""
    return result.select(to_json_record("time", "place", "sentiment", "count").alias("value"))


# --------------------------------------------------------------------------
# P3

def tag_rows(posts: DataFrame, ts: str = "ts", mode: str = "normal", text_col: str = "text") -> DataFrame:
    """One row ``(ts, word)`` per hashtag occurrence."""
    return posts.select(F.col(ts), F.explode(hashtags(text_col, mode)).alias("word"))


def hashtag_counts(posts: DataFrame, ts: str = "ts", size: str = "4 seconds", slide: str | None = "2 seconds",
                   mode: str = "normal", text_col: str = "text", panes: bool | None = None) -> DataFrame:
    """Hashtag occurrences per window: ``window_start, window_end, word, count``.

    ``panes`` says whether panes are counted and added up (see
    ``paned_counts``) instead of copying every row to its windows; by default
    they are from ``MIN_PANES`` panes a window.  The counts are the same."""
    tags = tag_rows(posts, ts, mode, text_col)
    whole = pane_count(size, slide)
    if panes and not whole:
        raise ValueError(f"windows of {size} are not made of several panes of {slide}")
    if panes or (panes is None and whole >= MIN_PANES):
        return paned_counts(tags, "word", ts, size, slide)
    return windowed_counts(tags, "word", ts, size, slide)


def top_words(counts: DataFrame, k: int = 5, group: tuple[str, ...] = ("window_start", "window_end")) -> DataFrame:
    """The k most frequent words of each group (count desc, word asc)."""
    return top_k_per_group(counts, list(group), k, topk_order())


def trending_topics(posts: DataFrame, ts: str = "ts", size: str = "4 seconds", slide: str | None = "2 seconds",
                    k: int = 5, mode: str = "normal", text_col: str = "text", panes: bool | None = None) -> DataFrame:
    """Top-k hashtags of every (sliding) window:
    ``window_start, window_end, word, count, rank``."""
    return top_words(hashtag_counts(posts, ts, size, slide, mode, text_col, panes), k)


# --------------------------------------------------------------------------
# P4

def weather_by_state(weather: DataFrame, ts: str = "ts", size: str = "2 seconds", slide: str | None = None,
                     trim: bool = True) -> DataFrame:
    """A5: per window and state, mean temperature and reading count."""
    scored = valid(score_weather(weather, trim=trim)).select(ts, "place", "temperature")
    return state_temperature(scored, ts, size, slide)


def sentiment_weather(posts: DataFrame, weather: DataFrame, ts: str = "ts", weather_ts: str | None = None,
                      size: str = "2 seconds", exact: bool = False, trim: bool = True,
                      lexicon: dict[str, int] | None = None,
                      scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Per window and state, post sentiment joined with mean temperature:
    ``window_start, window_end, place, sentiment, temperature``.

    The two aggregates are joined on their own grouping keys
    ``(window, place)``: each side is already hash-partitioned on them, so
    a sort-merge join needs no further shuffle (and AQE may still
    broadcast a side it measures small).  On streams the ``window`` struct
    carries the watermark that lets Spark drop join state.
    """
    return join_weather(valid(score_posts(posts, lexicon, scorer, trim=trim)), weather, ts, weather_ts, size, exact, trim)


def join_weather(scored: DataFrame, weather: DataFrame, ts: str = "ts", weather_ts: str | None = None,
                 size: str = "2 seconds", exact: bool = False, trim: bool = True) -> DataFrame:
    """P4 from posts that are scored already (``ts, place, sentiment``)."""
    weather_ts = weather_ts or ts
    scored = scored.select(ts, "place", "sentiment")
    s = state_sentiment_agg(scored, ts, size, exact=exact, flatten=False).select("window", "place", "sentiment")
    wt = valid(score_weather(weather, trim=trim)).select(weather_ts, "place", "temperature")
    t = state_temperature(wt, weather_ts, size, flatten=False).select("window", "place", "temperature")
    j = join_windows(s, t)
    return j.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "place", "sentiment", "temperature")


# --------------------------------------------------------------------------
# P5

def parse_state_weather(records: DataFrame) -> DataFrame:
    """P4's JSON records ``{time, place, sentiment, temperature}`` as rows
    ``window_end, place, sentiment, temperature`` plus ``_reject``."""
    fields = F.from_json("value", "time bigint, place string, sentiment double, temperature double")
    cols = [c for c in ("key", "timestamp") if c in records.columns]
    rows = records.select(*cols, "value", fields.alias("_r"))
    bad = F.when(F.col("_r").isNull() | F.col("_r.time").isNull() | F.col("_r.place").isNull(), F.lit("malformed"))
    return rows.select(*cols, "value", F.timestamp_millis(F.col("_r.time") + 1).alias("window_end"), "_r.place", "_r.sentiment",
                       "_r.temperature", bad.alias("_reject"))


def newest_per_state(p4: DataFrame) -> DataFrame:
    """For each of the 50 states, its newest P4 row (at most 50 rows:
    one per place, restricted to the dimension's codes)."""
    dim = state_dim(p4.sparkSession)
    # the 50-row dimension is broadcast: rows of other places (UND, foreign
    # codes) are dropped before the per-place shuffle
    known = p4.join(dim.select(F.col("code").alias("place")), "place", "left_semi")
    return top_k_per_group(known, ["place"], 1, [F.desc("window_end")], rank_col=None)


def latest_per_state(p4: DataFrame) -> DataFrame:
    """``newest_per_state`` as an aggregate, which a stream can keep as state:
    ``place, sentiment, temperature, window_end``, at most one row (and one
    state entry) per code of the dimension, whatever the stream's length."""
    dim = state_dim(p4.sparkSession)
    known = p4.join(F.broadcast(dim.select(F.col("code").alias("place"))), "place", "left_semi")
    newest = known.groupBy("place").agg(F.max(F.struct("window_end", "sentiment", "temperature")).alias("newest"))
    return newest.select("place", "newest.sentiment", "newest.temperature", "newest.window_end")


def snapshot_frame(latest: DataFrame) -> DataFrame:
    """The dashboard's 50 rows from ``newest_per_state`` or ``latest_per_state`` output."""
    dim = state_dim(latest.sparkSession)
    # at most one row per dimension code: a proven bound of 50 rows
    snap = dim.join(F.broadcast(latest), dim.code == latest.place, "left")
    temp = F.round(F.col("temperature")).cast("int")
    return snap.select(
        "state", "code", "sentiment",
        temp.alias("weather"),
        hover_label(F.col("state"), temp).alias("text"),
        F.col("window_end").alias("as_of"),
    )


def state_snapshot(p4: DataFrame) -> DataFrame:
    """P5: the dashboard's 50-row frame ``state, code, sentiment, weather,
    text, as_of``: for each state its newest P4 row, NULLs where it has
    none."""
    return snapshot_frame(newest_per_state(p4))
