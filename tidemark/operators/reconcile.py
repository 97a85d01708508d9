"""Two-source reconciliation of a keyed value (price series against price series)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left_only", "right_only"


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], a_value: str,
              b_value: str) -> DataFrame:
    """Full outer join on ``keys`` (keys coalesced), match status, abs / pct difference.

    ``pct_diff`` is ``|(a-b)/b*100|``; null when b is 0 (no error under ANSI).
    """
    j = a.select(*keys, a_value).join(b.select(*keys, b_value), list(keys), "full")
    av, bv = F.col(a_value), F.col(b_value)
    status = (F.when(av.isNotNull() & bv.isNotNull(), F.lit(BOTH))
               .when(bv.isNull(), F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY)))
    both = status == BOTH
    return j.select(*keys, a_value, b_value, status.alias("match_status"),
                    F.when(both, F.abs(av - bv)).alias("abs_diff"),
                    F.when(both, F.abs(F.try_divide(av - bv, bv) * 100)).alias("pct_diff"))


def reconcile_stats(rec: DataFrame, a_value: str, b_value: str, tolerance: float = 0.01, day: str | None = None) -> DataFrame:
    """One row: per-source and per-status counts, diff statistics, mismatches.

    With ``day``, a key column, also the first and last day of each source.
    """
    st = F.col("match_status")
    ranges = []
    for side, value in (("left", a_value), ("right", b_value)) if day else ():
        own = F.when(F.col(value).isNotNull(), F.col(day))
        ranges += [F.min(own).alias(f"{side}_from"), F.max(own).alias(f"{side}_to")]
    return rec.agg(
        *ranges,
        F.count(a_value).alias("n_left"),
        F.count(b_value).alias("n_right"),
        F.count(F.when(st == BOTH, 1)).alias("n_both"),
        F.count(F.when(st == LEFT_ONLY, 1)).alias("n_left_only"),
        F.count(F.when(st == RIGHT_ONLY, 1)).alias("n_right_only"),
        F.max("abs_diff").alias("max_abs"),
        F.avg("abs_diff").alias("mean_abs"),
        F.max("pct_diff").alias("max_pct"),
        F.avg("pct_diff").alias("mean_pct"),
        F.count(F.when(F.col("abs_diff") > tolerance, 1)).alias("n_mismatch"),
    )


def mismatches(rec: DataFrame, keys: Sequence[str], tolerance: float = 0.01,
               top: int | None = None) -> DataFrame:
    """Rows with ``abs_diff > tolerance``, largest first (keys break ties).

    All of them by default; with ``top`` this is a distributed top-k (TakeOrderedAndProject)."""
    out = rec.where(F.col("abs_diff") > tolerance).orderBy(F.desc("abs_diff"), *keys)
    return out.limit(top) if top else out


def one_sided(rec: DataFrame, keys: Sequence[str], status: str, top: int | None = None) -> DataFrame:
    out = rec.where(F.col("match_status") == status).orderBy(*keys)
    return out.limit(top) if top else out
