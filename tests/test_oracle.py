"""Every registered batch query equals its DuckDB oracle (sf0.001)."""
import pytest

import __spark_entry__ as E
from chirpwave.plans import queries as Q
from chirpwave.streaming.replay import STREAM
from conftest import SF0001
from oracle_compare import canon, duck

BATCH = [k for k in Q.BATCH]


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert canon(rows, df.columns) == canon(res.fetchall(), res.columns)


def test_every_query_has_an_oracle():
    """The queries of the optional subpackage have their own tests."""
    assert set(Q.BATCH) | set(STREAM) <= set(E.oracle_sql())
    assert set(Q.BATCH) | set(STREAM) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "word", "count", "rank"]
    assert df.count() > 0
