import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chirpwave.session import local_session
    s = local_session(shuffle_partitions=8)
    yield s


def one(spark, col, value=None, schema="x string"):
    """Evaluate a Column expression over a one-column, one-row frame."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col.alias("r")).first()["r"]
