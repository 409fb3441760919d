"""DuckDB SQL twins of the library's operators, used as correctness oracles.

Each helper returns SQL text for DuckDB 2.x over the pre-registered views
(``events``, ``documents`` ...).  They restate the same rules as the
Spark code in plain SQL so that every registered query has an
independent check.  Nothing here runs on Spark.
"""

from __future__ import annotations

from ..sources.feeds import posts_sql, weather_sql

# Fixed values, restated here on purpose: an oracle that imported them from
# the code under test would agree with any mistake in them.
POSITIVE = ("love great good happy nice excellent wonderful amazing best beautiful glad fantastic").split()
NEGATIVE = ("bad terrible awful sad hate worst horrible poor angry ugly boring disappointing").split()
DEFAULT_LEXICON = {**dict.fromkeys(POSITIVE, 1), **dict.fromkeys(NEGATIVE, -1)}
WORD_DELIMITER = "[^a-z]+"
NORMAL_DELIMITER = r"[ \t\n\x0B\f\r]+|,"
SENTENCE_DELIMITER = r"[.!?\n]+"
UNDEFINED = "UND"
STATES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"), ("California", "CA"),
    ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"), ("Florida", "FL"), ("Georgia", "GA"),
    ("Hawaii", "HI"), ("Idaho", "ID"), ("Illinois", "IL"), ("Indiana", "IN"), ("Iowa", "IA"),
    ("Kansas", "KS"), ("Kentucky", "KY"), ("Louisiana", "LA"), ("Maine", "ME"), ("Maryland", "MD"),
    ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"), ("Mississippi", "MS"), ("Missouri", "MO"),
    ("Montana", "MT"), ("Nebraska", "NE"), ("Nevada", "NV"), ("New Hampshire", "NH"), ("New Jersey", "NJ"),
    ("New Mexico", "NM"), ("New York", "NY"), ("North Carolina", "NC"), ("North Dakota", "ND"), ("Ohio", "OH"),
    ("Oklahoma", "OK"), ("Oregon", "OR"), ("Pennsylvania", "PA"), ("Rhode Island", "RI"), ("South Carolina", "SC"),
    ("South Dakota", "SD"), ("Tennessee", "TN"), ("Texas", "TX"), ("Utah", "UT"), ("Vermont", "VT"),
    ("Virginia", "VA"), ("Washington", "WA"), ("West Virginia", "WV"), ("Wisconsin", "WI"), ("Wyoming", "WY"),
]

PAD = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
JAVA_TRIM_RE = r"'\A[\x00-\x20]+|[\x00-\x20]+\z'"


def jtrim(x: str) -> str:
    return f"regexp_replace({x}, {JAVA_TRIM_RE}, '', 'g')"


def state_map() -> str:
    items = ", ".join(f"'{n.lower()}': '{c}'" for n, c in STATES)
    return f"MAP {{{items}}}"


def lexicon_map(lexicon: dict[str, int] | None = None) -> str:
    items = ", ".join(f"'{w}': {int(v)}" for w, v in sorted((lexicon or DEFAULT_LEXICON).items()))
    return f"MAP {{{items}}}"


def state_code(place: str, trim: bool = True) -> str:
    parts = f"string_split(regexp_replace({place}, ',+\\z', ''), ',')"
    p1, p2 = f"({parts})[1]", f"({parts})[2]"
    two = jtrim(p2) if trim else p2
    lookup = f"coalesce({state_map()}[lower({jtrim(p1)})], '{UNDEFINED}')"
    return (f"CASE WHEN {place} IS NULL THEN NULL "
            f"WHEN len({parts}) = 2 AND length({jtrim(p2)}) = 2 THEN {two} "
            f"WHEN len({parts}) = 2 AND upper({jtrim(p2)}) = 'USA' THEN {lookup} "
            f"WHEN len({parts}) = 1 THEN {lookup} "
            f"ELSE '{UNDEFINED}' END")


def sentences(text: str) -> str:
    return f"list_transform(string_split_regex({text}, '{SENTENCE_DELIMITER}'), lambda x: trim(x, {PAD}))"


def with_longest(src: str, text: str = "text") -> str:
    """``src`` with a column ``longest`` (the first longest sentence)."""
    return f"""(SELECT * EXCLUDE (_ss, _mx),
    CASE WHEN {text} IS NULL OR length({text}) = 0 THEN NULL
         ELSE list_filter(_ss, lambda x: length(x) = _mx)[1] END AS longest
  FROM (SELECT *, list_max(list_transform(_ss, lambda x: length(x))) AS _mx
        FROM (SELECT *, {sentences(text)} AS _ss FROM {src})))"""


def lexicon_score(sentence: str, lexicon: dict[str, int] | None = None) -> str:
    words = f"string_split_regex(lower({sentence}), '{WORD_DELIMITER}')"
    total = f"coalesce(list_sum(list_transform({words}, lambda w: coalesce({lexicon_map(lexicon)}[w], 0))), 0)"
    return f"CAST(greatest(-2, least(2, {total})) AS INTEGER)"


def sentiment_expr(longest: str = "longest") -> str:
    return f"CASE WHEN {longest} IS NULL THEN NULL ELSE {lexicon_score(longest)} END"


def model_expr(longest: str = "longest") -> str:
    """The stand-in model's class, the sentence's length modulo 6, less 2; class 5 is out of range and counts as 0."""
    cls = f"(length({longest}) % 6)"
    return f"CASE WHEN {longest} IS NULL THEN NULL WHEN {cls} <= 4 THEN CAST({cls} - 2 AS INTEGER) ELSE 0 END"


def scored_posts(sentiment: str | None = None, where: str = "true") -> str:
    """posts + ``sentiment`` + ``place`` (valid rows only: text non-empty)."""
    return f"""(SELECT id, ts, text, place_full_name, {sentiment or sentiment_expr()} AS sentiment,
    {state_code('place_full_name')} AS place
  FROM {with_longest(posts_sql())} WHERE {where})"""


def hashtags(text: str, mode: str = "normal") -> str:
    if mode == "normal":
        toks = f"string_split_regex(lower({text}), '{NORMAL_DELIMITER}')"
    else:
        toks = f"string_split({text}, ' ')"
    return f"list_filter({toks}, lambda t: length(t) > 0 AND starts_with(t, '#'))"


def window_starts(ts: str, size: str, slide: str | None = None) -> str:
    """Epoch-aligned window starts containing ``ts`` (a list when sliding)."""
    if not slide:
        return f"time_bucket(INTERVAL '{size}', {ts})"
    n = _ratio(size, slide)
    starts = ", ".join(f"time_bucket(INTERVAL '{slide}', {ts}) - {k} * INTERVAL '{slide}'" for k in range(n))
    return f"unnest([{starts}])"


def _ratio(size: str, slide: str) -> int:
    def secs(s: str) -> int:
        n, unit = s.split()
        mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
        return int(n) * mult
    a, b = secs(size), secs(slide)
    if a % b:
        raise ValueError("oracle supports sizes that are multiples of the slide")
    return a // b


def squash(total: str, n: str, exact: bool = False) -> str:
    if exact:
        return f"1.0 / (1.0 + exp(CAST(-2 AS DOUBLE) * {total} / {n}))"
    return f"1.0 / (1.0 + exp(CAST((-2 * {total}) // {n} AS DOUBLE)))"


def state_sentiment(size: str, exact: bool = False, scored: str | None = None) -> str:
    return f"""(SELECT window_start, window_start + INTERVAL '{size}' AS window_end, place,
    {squash('s', 'n', exact)} AS sentiment, n AS count,
    epoch_ms(window_start + INTERVAL '{size}') - 1 AS time
  FROM (SELECT {window_starts('ts', size)} AS window_start, place,
          sum(CAST(sentiment AS BIGINT)) AS s, count(*) AS n
        FROM {scored or scored_posts()} WHERE sentiment IS NOT NULL AND place IS NOT NULL
        GROUP BY ALL))"""


def state_temperature(size: str) -> str:
    return f"""(SELECT window_start, window_start + INTERVAL '{size}' AS window_end, place,
    avg(temperature) AS temperature, count(*) AS count
  FROM (SELECT {window_starts('ts', size)} AS window_start, {state_code('state')} AS place, temperature
        FROM {weather_sql()})
  WHERE place IS NOT NULL AND temperature IS NOT NULL
  GROUP BY window_start, place)"""


def sentiment_weather(size: str) -> str:
    return f"""(SELECT s.window_start, s.window_end, s.place, s.sentiment, w.temperature
  FROM {state_sentiment(size)} s
  JOIN {state_temperature(size)} w
    ON s.window_start = w.window_start AND s.window_end = w.window_end AND s.place = w.place)"""


def raw_records() -> str:
    """The posts as JSON record texts."""
    return f"(SELECT id, ts, CAST(to_json({{'id': id, 'text': text, 'place_full_name': place_full_name}}) AS VARCHAR) AS value FROM {posts_sql()})"


def hashtag_counts(size: str, slide: str | None, mode: str = "normal", src: str | None = None, col: str = "text") -> str:
    tags = f"(SELECT ts, unnest({hashtags(col, mode)}) AS word FROM {src or posts_sql()})"
    return f"""(SELECT window_start, window_start + INTERVAL '{size}' AS window_end, word, count(*) AS count
  FROM (SELECT {window_starts('ts', size, slide)} AS window_start, word FROM {tags})
  GROUP BY window_start, word)"""


def trending(size: str, slide: str | None, k: int, mode: str = "normal", src: str | None = None, col: str = "text") -> str:
    return f"""(SELECT window_start, window_end, word, count, rank FROM
  (SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end ORDER BY count DESC, word ASC) AS INTEGER) AS rank
   FROM {hashtag_counts(size, slide, mode, src, col)}) WHERE rank <= {k})"""


def window_totals(size: str, slide: str | None, mode: str = "normal") -> str:
    tags = f"(SELECT ts, unnest({hashtags('text', mode)}) AS word FROM {posts_sql()})"
    return f"""(SELECT window_start, window_start + INTERVAL '{size}' AS window_end, count(*) AS count
  FROM (SELECT {window_starts('ts', size, slide)} AS window_start FROM {tags})
  GROUP BY window_start)"""
