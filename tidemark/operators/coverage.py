"""Coverage and share statistics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def span_by_key(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """min / max / count of ``col`` per key (count as bigint)."""
    return df.groupBy(*keys).agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"),
                                 F.count(col).alias("n"))


def share_report(df: DataFrame, keys: Sequence[str], entity: str, covered: Column,
                 weight: str) -> DataFrame:
    """Rows, distinct entities, share of covered rows and of covered weight.

    ``value_share`` is ``sum(weight where covered) / sum(weight)``; null when the
    denominator is 0 or null (``try_divide``), never an error.
    """
    cov = covered.cast("int")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(entity).alias("n_entities"),
        F.avg(cov).alias("row_share"),
        F.try_divide(F.coalesce(F.sum(F.when(covered, F.col(weight))), F.lit(0)),
                     F.sum(weight)).alias("value_share"),
    )
