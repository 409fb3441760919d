from pyspark.sql import functions as F

from chirpwave.functions.text import hashtags, longest_sentence, sentences, tokens
from conftest import one


def test_hashtags_normal(spark):
    assert one(spark, hashtags(F.col("x"), "normal"), "Hi #A,#b  #A #") == ["#a", "#b", "#a", "#"]


def test_hashtags_raw(spark):
    assert one(spark, hashtags(F.col("x"), "raw"), "Hi #A,#b  #A #") == ["#A,#b", "#A", "#"]


def test_tokens_modes(spark):
    assert one(spark, tokens(F.col("x"), "normal"), "A b,C\tD") == ["a", "b", "c", "d"]
    assert one(spark, tokens(F.col("x"), "raw"), "A  b") == ["A", "", "b"]


def test_longest_sentence(spark):
    assert one(spark, longest_sentence(F.col("x")), "aa. bb. c") == "aa"
    assert one(spark, longest_sentence(F.col("x")), "Hi. Such a long one! ok") == "Such a long one"
    assert one(spark, longest_sentence(F.col("x")), "one\ntwo three?") == "two three"
    assert one(spark, longest_sentence(F.col("x")), "") is None
    assert one(spark, longest_sentence(F.col("x")), None) is None


def test_sentences_trimmed(spark):
    assert one(spark, sentences(F.col("x")), " a b .\t c!") == ["a b", "c", ""]


def test_hashtags_equal_filtered_tokens(spark):
    """The one-scan extractor equals 'tokens that start with #' (property
    check over random strings built from delimiters, '#' and letters)."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list(" \t\n\x0b\f\r,#aAbZé."))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet=alphabet, max_size=40), min_size=100, max_size=100))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        for mode in ("normal", "raw"):
            ref = F.filter(tokens(F.col("x"), mode), lambda t: (F.length(t) > 0) & t.startswith("#"))
            bad = df.where(~F.equal_null(hashtags(F.col("x"), mode), ref)).count()
            assert bad == 0, mode

    check()
