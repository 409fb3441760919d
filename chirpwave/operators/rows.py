"""Row-local helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add computed columns that are evaluated exactly once per row.

    A filter on a plain computed column is pushed below its projection
    with the expression substituted, so an expensive expression (JSON
    parse, sentence split) would run once in the filter and again in the
    projection.  Emitting the columns through a one-element ``inline``
    (a generator) fences them: filters on generator output stay above
    it.  One input row gives exactly one output row.
    """
    packed = F.struct(*[c.alias(name) for name, c in cols.items()])
    return df.select("*", F.inline(F.array(packed)))
