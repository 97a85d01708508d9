"""Effective versions: which filings of a manager make up the final state.

Per key, order the versions by ``order_cols`` (nulls first). The *base* is
the last version that replaces everything before it; the base and every
later (additive) version are kept. Without any replacing version, all are
kept.

Spark form: the base is a plain ``max`` of the ordering struct over the
replacing rows (partial aggregation before the shuffle, so a key holding a
third of all rows still combines map-side), joined back on the key and
compared. No window sorts a whole key inside one task, and AQE's skew-join
splitting handles a hot key on the probe side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def effective_versions(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                       is_replacement: Column) -> DataFrame:
    order = F.struct(*[F.col(c) for c in order_cols])
    base = (df.where(is_replacement)
              .groupBy(*keys)
              .agg(F.max(order).alias("_base")))
    b = base.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_base")
    cond = [df[k].eqNullSafe(b[f"_k_{k}"]) for k in keys]
    joined = df.join(b, cond, "left")
    return (joined.where(F.col("_base").isNull() | (order >= F.col("_base")))
                  .drop("_base", *[f"_k_{k}" for k in keys]))
