"""Exact calendar-point lookups (value k months back, value at a given day).

A gap must give null, not the previous available row, so these are equi
joins on the shifted period and never ``lag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pct_change


def value_months_back(df: DataFrame, keys: Sequence[str], period: str, value: str,
                      months_back: int, out: str) -> DataFrame:
    """Add ``out`` = the value at exactly ``period - months_back`` months (same keys)."""
    prior = df.select(*keys, F.add_months(F.col(period), months_back).alias(period),
                      F.col(value).alias(out))
    return df.join(prior, [*keys, period], "left")


def exact_change(df: DataFrame, keys: Sequence[str], period: str, value: str,
                 months_back: int, out: str) -> DataFrame:
    """Percent change against exactly ``months_back`` months earlier; null on a gap."""
    tmp = f"_{out}_prior"
    return (value_months_back(df, keys, period, value, months_back, tmp)
            .withColumn(out, pct_change(F.col(value), F.col(tmp)))
            .drop(tmp))


def value_at(probe: DataFrame, series: DataFrame, keys: Sequence[str], probe_day: str,
             series_day: str, value: str, out: str) -> DataFrame:
    """Value observed exactly on ``probe_day`` (left join, null if absent)."""
    s = series.select(*keys, F.col(series_day).alias(probe_day), F.col(value).alias(out))
    return probe.join(s, [*keys, probe_day], "left")
