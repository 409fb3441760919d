import pytest
from pyspark.sql import functions as F

from chirpwave.functions.numeric import hover_label, int_div, squash, window_time_ms


@pytest.mark.parametrize("s,n,default,exact", [
    (3, 4, 0.7310585786300049, 0.8175744761936437),
    (-3, 4, 0.2689414213699951, 0.18242552380635635),
    (1, 3, 0.5, 0.6607563687658172),
    (8, 4, 0.9820137900379085, 0.9820137900379085),
    (0, 5, 0.5, 0.5),
])
def test_squash(spark, s, n, default, exact):
    df = spark.createDataFrame([(s, n)], "s long, n long")
    r = df.select(squash("s", "n").alias("a"), squash("s", "n", exact=True).alias("b")).first()
    assert r.a == pytest.approx(default, rel=1e-15)
    assert r.b == pytest.approx(exact, rel=1e-15)


def test_int_div_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-7, 2), (7, -2), (7, 2), (-8, 4)], "a long, b long")
    got = [r.q for r in df.select(int_div(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [-3, -3, 3, -2]


def test_window_time_ms(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 01:00:00' AS e")
    assert df.select(window_time_ms("e").alias("t")).first().t == 1704070800000 - 1


def test_hover_label(spark):
    df = spark.createDataFrame([("Texas", 25)], "s string, t int")
    assert df.select(hover_label("s", "t").alias("l")).first().l == "Texas<br>temperature : 25 degree"
