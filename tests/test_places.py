import pytest
from pyspark.sql import functions as F

from chirpwave.functions.places import state_code
from conftest import one

# input, trim=False (parity), default
CASES = [
    ("Austin, TX", " TX", "TX"),
    ("Austin,TX", "TX", "TX"),
    ("Austin, TX,", " TX", "TX"),
    ("Paris, fr", " fr", "fr"),
    ("Washington, DC", " DC", "DC"),
    (",TX", "TX", "TX"),
    ("Minnesota, USA", "MN", "MN"),
    ("minnesota , usa", "MN", "MN"),
    ("Minneapolis, USA", "UND", "UND"),
    (", USA", "UND", "UND"),
    ("New York, New York", "UND", "UND"),
    ("Texas", "TX", "TX"),
    ("  tExas ", "TX", "TX"),
    ("\tTexas\t", "TX", "TX"),
    ("Texas,", "TX", "TX"),
    ("Texas,,", "TX", "TX"),
    ("", "UND", "UND"),
    (",", "UND", "UND"),
    ("A, B, TX", "UND", "UND"),
    ("District of Columbia", "UND", "UND"),
    ("new hampshire", "NH", "NH"),
    ("West Virginia, usa", "WV", "WV"),
]


@pytest.mark.parametrize("place,raw,default", CASES)
def test_state_code(spark, place, raw, default):
    assert one(spark, state_code(F.col("x"), trim=False), place) == raw
    assert one(spark, state_code(F.col("x")), place) == default


def test_state_code_null(spark):
    assert one(spark, state_code(F.col("x")), None) is None


def test_state_dim(spark):
    from chirpwave.sources.states import state_dim
    d = state_dim(spark)
    assert d.count() == 50
    assert d.select("code").distinct().count() == 50
    assert d.where("code = 'DC'").count() == 0
