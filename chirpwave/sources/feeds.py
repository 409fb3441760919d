"""Post and weather feeds derived from the supplied tables.

The supplied tables hold no hashtags, US places or temperatures, so the
feeds are derived from ``events`` (time, user, type, value) and
``documents`` (whole texts).  Every event becomes one post; the event with
the same id as a document carries that document's whole text, so every
document is used once and the work grows with both tables.  Weather
readings are the ``view``/``click`` events.

Each feed exists twice: as DataFrame code (what the library runs) and as
SQL text (what the DuckDB oracle runs).  Both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .states import state_dim, states_values_sql
from .tables import read_table

# One sentence per event type, giving five moods.
MOODS = [
    ("purchase", "I really love this great place"),
    ("error", "What a terrible awful day today"),
    ("signup", "A good morning to everyone here"),
    ("click", "Such a bad idea to come by here"),
]
DEFAULT_MOOD = "Just walking around the town"

# Event types that are weather readings.
WEATHER_TYPES = ("view", "click")


def _mood(event_type: Column) -> Column:
    expr = F.when(event_type == MOODS[0][0], F.lit(MOODS[0][1]))
    for et, sentence in MOODS[1:]:
        expr = expr.when(event_type == et, F.lit(sentence))
    return expr.otherwise(F.lit(DEFAULT_MOOD))


def _place() -> Column:
    """Six spellings of a place, by event id."""
    k = F.col("event_id") % 6
    return (F.when(k == 0, F.col("state"))
             .when(k == 1, F.concat(F.lit("Somecity, "), F.col("code")))
             .when(k == 2, F.concat(F.col("state"), F.lit(", USA")))
             .when(k == 3, F.concat(F.lower(F.col("state")), F.lit(",")))
             .when(k == 4, F.concat(F.lit("City, County, "), F.col("code")))
             .otherwise(F.lit("Toronto, Ontario")))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id STRING, place_full_name STRING)`` of every post, without its
    text: no documents are read or joined.  Equal to the posts' columns as
    long as ``documents.doc_id`` is unique; every 60th place ends in a comma
    and a line end."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    joined = e.join(state_dim(spark), (F.col("user_id") % 50) == F.col("state_idx"), "inner")
    place = F.when(F.col("event_id") % 60 == 0, F.concat("state", F.lit(",\n"))).otherwise(_place())
    return joined.select(F.col("event_id").cast("string").alias("id"), place.alias("place_full_name"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id STRING, ts TIMESTAMP_NTZ, text STRING, place_full_name STRING)``.

    ``text`` = whole document text (if any), a mood sentence, the event
    type as a hashtag and, for large values, a comma-joined topic tag or a
    bare ``#``.  ``place_full_name`` cycles through six spellings of a
    place: name, ``city, CODE``, ``name, USA``, lower-case name with a
    trailing comma, three parts, and a foreign place.
    """
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = state_dim(spark)
    # Documents carry whole texts: never broadcast them (their compressed
    # parquet size understates their memory size several times).  A
    # sort-merge join on the id also spreads the per-text work that follows
    # (sentence split, tokenising) over all shuffle partitions.
    joined = (e.join(d.hint("merge"), e.event_id == d.doc_id, "left")
               .join(s, (e.user_id % 50) == s.state_idx, "inner"))
    tag = F.when(F.col("value") > 60,
                 F.concat(F.lit(",#Topic"), (F.col("user_id") % 7).cast("string"))).otherwise(F.lit(" #"))
    text = F.concat(F.concat_ws(". ", F.col("text"), _mood(F.col("event_type"))),
                    F.lit(". #"), F.col("event_type"), tag)
    return joined.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts"),
        text.alias("text"),
        _place().alias("place_full_name"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts TIMESTAMP_NTZ, state STRING, temperature INT)``."""
    e = (read_table(spark, sf_dir, "events")
         .where(F.col("event_type").isin(*WEATHER_TYPES))
         .select("event_id", "ts", "user_id", "value"))
    s = state_dim(spark)
    j = e.join(s, (e.user_id % 50) == s.state_idx, "inner")
    return j.select(
        F.col("ts"),
        F.when(F.col("event_id") % 2 == 0, F.col("state"))
         .otherwise(F.concat(F.col("state"), F.lit(", USA"))).alias("state"),
        (F.floor(F.col("value")).cast("int") % 50 - 10).alias("temperature"),
    )


def post_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as Kafka-shaped records ``(key, value, timestamp)``: the key is
    the post id, the value the post as a JSON object (no time field; the
    time is the record timestamp, as with a broker)."""
    p = posts(spark, sf_dir)
    return p.select(
        F.col("id").alias("key"),
        F.to_json(F.struct("id", "text", "place_full_name")).alias("value"),
        F.col("ts").alias("timestamp"),
    )


def post_records_mixed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``post_records`` where a third of the posts have a numeric id and a
    third have none."""
    p = posts(spark, sf_dir)
    kind = F.col("id").cast("bigint") % 3
    value = (F.when(kind == 0, F.to_json(F.struct("id", "text", "place_full_name")))
             .when(kind == 1, F.to_json(F.struct(F.col("id").cast("bigint").alias("id"), "text", "place_full_name")))
             .otherwise(F.to_json(F.struct("text", "place_full_name"))))
    return p.select(F.col("id").alias("key"), value.alias("value"), F.col("ts").alias("timestamp"))


def weather_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather(spark, sf_dir)
    return w.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("state", "temperature")).alias("value"),
        F.col("ts").alias("timestamp"),
    )


# ---------------------------------------------------------------------------
# The same feeds as SQL for the DuckDB oracle.

def _mood_sql() -> str:
    whens = " ".join(f"WHEN '{et}' THEN '{s}'" for et, s in MOODS)
    return f"CASE e.event_type {whens} ELSE '{DEFAULT_MOOD}' END"


PLACE_SQL = """CASE e.event_id % 6
    WHEN 0 THEN s.state
    WHEN 1 THEN concat('Somecity, ', s.code)
    WHEN 2 THEN concat(s.state, ', USA')
    WHEN 3 THEN concat(lower(s.state), ',')
    WHEN 4 THEN concat('City, County, ', s.code)
    ELSE 'Toronto, Ontario' END"""


def places_sql() -> str:
    return f"""(SELECT CAST(e.event_id AS VARCHAR) AS id,
  CASE WHEN e.event_id % 60 = 0 THEN concat(s.state, ',', chr(10)) ELSE {PLACE_SQL} END AS place_full_name
FROM events e JOIN {states_values_sql()} s ON s.state_idx = e.user_id % 50)"""


def posts_sql() -> str:
    return f"""(SELECT CAST(e.event_id AS VARCHAR) AS id, e.ts AS ts,
  concat(concat_ws('. ', d.text, {_mood_sql()}), '. #', e.event_type,
    CASE WHEN e.value > 60 THEN concat(',#Topic', CAST(e.user_id % 7 AS VARCHAR)) ELSE ' #' END) AS text,
  {PLACE_SQL} AS place_full_name
FROM events e
LEFT JOIN documents d ON d.doc_id = e.event_id
JOIN {states_values_sql()} s ON s.state_idx = e.user_id % 50)"""


def weather_sql() -> str:
    types = ", ".join(f"'{t}'" for t in WEATHER_TYPES)
    return f"""(SELECT e.ts AS ts,
  CASE WHEN e.event_id % 2 = 0 THEN s.state ELSE concat(s.state, ', USA') END AS state,
  CAST(floor(e.value) AS INT) % 50 - 10 AS temperature
FROM events e JOIN {states_values_sql()} s ON s.state_idx = e.user_id % 50
WHERE e.event_type IN ({types}))"""
