"""Keep one row per key (first feed wins, newest version wins, ...).

Implemented as an aggregation of a row struct, not as ``row_number`` over
a key window: ``min``/``max`` of a struct combines partially on the map
side, so a key with a third of all rows costs one small row per task before
the shuffle instead of one task sorting all of them. The ordering struct is
followed by every column, so ties resolve deterministically.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             first: bool = True) -> DataFrame:
    """One row per ``keys``: the smallest (``first``) or largest by ``order``."""
    payload = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    row = F.struct(rank.alias("_rank"), F.struct(*payload).alias("_row"))
    agg = F.min(row) if first else F.max(row)
    out = df.groupBy(*keys).agg(agg.alias("_pick"))
    return out.select(*keys, *[F.col(f"_pick._row.{c}").alias(c) for c in payload])


def merge_latest(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union old and new rows (columns aligned by name); the new row wins per key."""
    cols = new.columns
    both = (old.select(*cols).withColumn("_src", F.lit(0))
               .unionByName(new.withColumn("_src", F.lit(1))))
    return keep_one(both, keys, [F.col("_src")], first=False).drop("_src")
