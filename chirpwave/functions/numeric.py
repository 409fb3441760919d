"""Numeric and formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    """Integer division of bigints truncating toward zero (Java ``/`` on
    ints, SQL ``div``), exact over the whole range."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def squash(total: Column | str, n: Column | str, exact: bool = False) -> Column:
    """``1 / (1 + exp(-2 * total / n))``.

    By default the mean is an integer division, as the reference computes
    it (results take few distinct values); ``exact=True`` uses the real
    mean.
    """
    total = F.col(total) if isinstance(total, str) else total
    n = F.col(n) if isinstance(n, str) else n
    if exact:
        arg = F.lit(-2.0) * total / n
    else:
        arg = int_div(F.lit(-2) * total, n).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(arg))


def window_time_ms(window_end: Column | str) -> Column:
    """Epoch milliseconds of the last instant of a window (end - 1 ms)."""
    window_end = F.col(window_end) if isinstance(window_end, str) else window_end
    return F.unix_millis(window_end.cast("timestamp")) - F.lit(1)


def hover_label(state: Column | str, temperature: Column | str) -> Column:
    """Dashboard label ``<state><br>temperature : <t> degree``."""
    state = F.col(state) if isinstance(state, str) else state
    temperature = F.col(temperature) if isinstance(temperature, str) else temperature
    return F.concat(state, F.lit("<br>temperature : "), temperature.cast("string"), F.lit(" degree"))
