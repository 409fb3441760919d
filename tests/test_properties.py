"""Brute-force models of the row rules, compared with Spark on random input.

The models are plain Python written from the rules (Java string
semantics for the place rule: ``split(",")`` drops trailing empty parts,
``trim()`` strips every char <= U+0020), independent of both the Spark
code and the DuckDB oracle.
"""
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chirpwave.functions.places import state_code
from chirpwave.functions.sentiment import DEFAULT_LEXICON, sentiment
from chirpwave.functions.text import longest_sentence
from chirpwave.sources.states import STATES

LOOKUP = {n.lower(): c for n, c in STATES}


def java_trim(s):
    i, j = 0, len(s)
    while i < j and s[i] <= " ":
        i += 1
    while j > i and s[j - 1] <= " ":
        j -= 1
    return s[i:j]


def java_split_comma(s):
    parts = s.split(",")
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_state_code(place, trim=True):
    parts = java_split_comma(place)
    if len(parts) == 2:
        t = java_trim(parts[1])
        if len(t) == 2:
            return t if trim else parts[1]
        if len(t) == 3 and t.lower() == "usa":
            return LOOKUP.get(java_trim(parts[0]).lower(), "UND")
    elif len(parts) == 1:
        return LOOKUP.get(java_trim(parts[0]).lower(), "UND")
    return "UND"


def model_longest(text):
    sents = [s.strip(" \t\x0b\f\r") for s in re.split(r"[.!?\n]+", text)]
    m = max(len(s) for s in sents)
    return next(s for s in sents if len(s) == m)


def model_sentiment(text):
    if not text:
        return None
    words = re.split(r"[^a-z]+", model_longest(text).lower())
    return max(-2, min(2, sum(DEFAULT_LEXICON.get(w, 0) for w in words)))


PLACE_PIECES = ["Texas", "new york", "OHIO", "Somecity", "USA", "usa", "TX", "fr", "DC", "a", "",
                ",", ",", ", ", " ", "\t", "\x01", "  ", "\n", "\r\n", ",\n", "\u2028", "\x85"]
TEXT_PIECES = ["love", "great", "bad", "awful", "Good", "sad day", "x", "é", " ", "  ", "\t", ".", "!", "?",
               "\n", "...", "!?", ",", "#tag", "a b c d"]


def _check(spark, pieces, n, fn_spark, fn_model):
    strat = st.lists(st.lists(st.sampled_from(pieces), max_size=12).map("".join), min_size=n, max_size=n)

    @settings(max_examples=4, deadline=None)
    @given(strat)
    def run(values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        got = [r.r for r in df.select(fn_spark(F.col("x")).alias("r")).collect()]
        want = [fn_model(v) for v in values]
        bad = [(v, g, w) for v, g, w in zip(values, got, want) if g != w]
        assert not bad, bad[:5]

    run()


def test_state_code_matches_java_rule(spark):
    _check(spark, PLACE_PIECES, 300, lambda c: state_code(c), lambda v: model_state_code(v, True))
    _check(spark, PLACE_PIECES, 300, lambda c: state_code(c, trim=False), lambda v: model_state_code(v, False))


def test_longest_sentence_matches_model(spark):
    _check(spark, TEXT_PIECES, 300, longest_sentence, lambda v: model_longest(v) if v else None)


def test_sentiment_matches_model(spark):
    _check(spark, TEXT_PIECES, 300, sentiment, model_sentiment)


def test_large_lexicon_matches_model(spark):
    """A user lexicon of thousands of words (hash-set lookups) gives the
    same scores as the brute-force model."""
    import random
    rnd = random.Random(7)
    letters = "abcdefghij"
    vocab = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(6000)})
    lex = {w: rnd.choice([-3, -2, -1, 1, 2, 3]) for w in vocab[:3000]}
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 15))) + rnd.choice([".", "!", ""]) +
             " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 8))) for _ in range(400)]

    def model(text):
        if not text:
            return None
        words = re.split(r"[^a-z]+", model_longest(text).lower())
        return max(-2, min(2, sum(lex.get(w, 0) for w in words)))

    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.r for r in df.select(sentiment(F.col("x"), lexicon=lex).alias("r")).collect()]
    assert got == [model(t) for t in texts]
