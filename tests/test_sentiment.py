import pytest
from pyspark.sql import functions as F

from chirpwave.functions.sentiment import class_to_sentiment, lexicon_score, model_scorer, sentiment
from conftest import one


@pytest.mark.parametrize("text,expected", [
    ("I really love this great place", 2),
    ("What a terrible awful day today", -2),
    ("A good morning to everyone here", 1),
    ("Such a bad idea to come by here", -1),
    ("Just walking around the town", 0),
    ("love great good nice happy. bad", 2),          # clamped to 2
    ("bad. I love it but it is terrible and awful", -1),  # longest sentence only
    ("Good GOOD good!", 2),
])
def test_lexicon_sentiment(spark, text, expected):
    assert one(spark, sentiment(F.col("x")), text) == expected


def test_empty_text_is_null(spark):
    assert one(spark, sentiment(F.col("x")), "") is None
    assert one(spark, sentiment(F.col("x")), None) is None


def test_custom_lexicon(spark):
    assert one(spark, sentiment(F.col("x"), lexicon={"meh": -2}), "so meh") == -2
    assert one(spark, lexicon_score(F.col("x"), {"a": 1}), "a a a") == 2


def test_class_reset_not_clamp(spark):
    df = spark.createDataFrame([(0,), (4,), (5,), (-1,), (2,)], "c int")
    got = [r.s for r in df.select(class_to_sentiment(F.col("c")).alias("s")).collect()]
    assert got == [-2, 2, 0, 0, 0]


def test_model_scorer_hook(spark):
    # a stand-in model: class = number of words, loaded once per worker
    def load():
        return lambda sents: [len(s.split()) for s in sents]
    scorer = model_scorer(load)
    df = spark.createDataFrame([("a b c. x",), ("one. two words here and more",), ("",)], "x string")
    got = [r.s for r in df.select(sentiment(F.col("x"), scorer=scorer).alias("s")).collect()]
    # 3 words -> class 3 -> 1; 5 words -> class 5 -> out of range -> 0; empty -> NULL
    assert got == [1, 0, None]


def test_two_lambda_scorers_do_not_share_a_model(spark):
    a = model_scorer(lambda: (lambda sents: [4 for _ in sents]))
    b = model_scorer(lambda: (lambda sents: [0 for _ in sents]))
    df = spark.createDataFrame([("some text",)], "x string")
    r = df.select(sentiment(F.col("x"), scorer=a).alias("a"), sentiment(F.col("x"), scorer=b).alias("b")).first()
    assert (r.a, r.b) == (2, -2)
