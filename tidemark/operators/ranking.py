"""Global ranking and request batching without a single-task window.

``row_number()`` over an un-partitioned window moves every row into one
task. ``global_rank`` instead range-partitions by the ordering (sampled
bounds, balanced partitions), numbers the sorted rows of each partition and
adds the row count of all earlier partitions. The numbered rows are written once to the
shared folder: the bounds are sampled anew by every run of the exchange, so the
sizes and the output must come from the same one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the total order ``order`` (make it unique)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_no", F.monotonically_increasing_id())
    numbered = checkpointed(numbered)
    # the id holds the partition above bit 33 and the row's place below it
    part, place = F.shiftright("_no", 33), F.col("_no").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    # one row for each partition
    return (numbered.withColumn("_pid", part).join(F.broadcast(offsets), "_pid")
                    .withColumn(out, (F.col("_off") + place + 1).cast("long"))
                    .drop("_pid", "_no", "_off"))


def batch_number(rank: Column, size: int) -> Column:
    """0-based batch of a 1-based rank for batches of ``size``."""
    return F.floor((rank - 1) / F.lit(size)).cast("long")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows by ``order``; distributed top-k. ``n = 0`` means no limit."""
    out = df.orderBy(*order)
    return out.limit(n) if n else out
