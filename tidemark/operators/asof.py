"""Backward as-of join with a tolerance.

For every left row: the latest right row of the same key whose time is on
or before the left time and at most ``tolerance`` older; null otherwise.

Spark has no public as-of join. Left and right rows are put into one order, by key, time
and side, and cut into ranges of about ``ROWS`` rows by a range partitioning, written
once. Inside a range the match is the last right row before a left row, by a window. What comes
from earlier ranges is the last right row of theirs: one row a range by an
aggregate, carried forward over that small table. So neither a hot key nor a
tolerance that spans all rows sets the size of a task: a key may fill many ranges.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed

#: rows of both sides in a range
ROWS = 4_000_000


def _ordinal(df: DataFrame, col: str):
    """Time column as a long in its natural unit (days for dates, micros else)."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(col)).cast("long"), "days"
    return F.unix_micros(F.col(col).cast("timestamp")), "micros"


def _units(tolerance: _dt.timedelta, unit: str) -> int:
    if unit == "days":
        return tolerance.days
    return int(tolerance.total_seconds() * 1_000_000)


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str,
                  right_on: str, tolerance: _dt.timedelta, right_cols: Sequence[str],
                  prefix: str = "match_") -> DataFrame:
    """Left rows plus ``prefix + c`` for each right column and ``prefix + right_on``.

    Of right rows at the same time the one with the largest values counts. A null key or time matches nothing.
    """
    lt, unit = _ordinal(left, left_on)
    rt, unit_r = _ordinal(right, right_on)
    if unit != unit_r:
        raise ValueError("left and right time columns must both be dates or both timestamps")
    width = _units(tolerance, unit)
    if width <= 0:
        raise ValueError("tolerance must be positive")

    payload_fields = [right_on, *right_cols]
    usable = rt.isNotNull()
    for k in by:
        usable = usable & F.col(k).isNotNull()
    r = right.where(usable).select(*by, rt.alias("_t"), F.struct(*[F.col(c) for c in payload_fields]).alias("_p")).withColumn("_side", F.lit(0))
    l = left.withColumns({"_t": lt, "_side": F.lit(1), "_p": F.lit(None).cast(r.schema["_p"].dataType)})
    both = l.unionByName(r, allowMissingColumns=True)
    # rows that tie in everything else still spread over ranges
    plain = [f.name for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*by, "_t", "_side", "_p", F.xxhash64(*plain)]
    ranges = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // ROWS))
    placed = both.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    placed = checkpointed(placed)

    # one row a range: the last right row of all earlier ones
    here = F.when(F.col("_side") == 0, F.struct(*by, "_t", "_p"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy("_range").agg(F.max(here).alias("_last")).select("_range", F.max("_last").over(before).alias("_before"))
    placed = placed.join(F.broadcast(carried), "_range")

    w = Window.partitionBy("_range").orderBy(*by, "_t", "_side", "_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.coalesce(F.last(here, ignorenulls=True).over(w), F.col("_before"))
    found = placed.withColumn("_m", last).where(F.col("_side") == 1)
    keep = F.col("_t") - F.col("_m._t") <= F.lit(width)
    for k in by:
        keep = keep & (F.col(k) == F.col(f"_m.{k}"))
    outs = [F.when(keep, F.col("_m._p").getField(c)).alias(prefix + c) for c in payload_fields]
    return found.select(*left.columns, *outs)
