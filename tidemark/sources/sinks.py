"""Writers: date-partitioned parquet with dynamic overwrite, single tables,
text rows, and a manifest of processed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str],
                      sort_within: Sequence[Column] | None = None,
                      compression: str = "zstd", one: bool = False) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite).

    Rows are clustered by the partition keys first so each task writes few
    files; ``sort_within`` orders rows inside each file (no global sort). With ``one`` all
    rows have the same keys, so that each task writes one file where its rows are.
    Never write to a path the same plan reads from.
    """
    # AQE splits the partitions of large days and joins those of small ones
    out = df if one else df.hint("rebalance", *keys)
    if sort_within:
        out = out.sortWithinPartitions(*[F.col(k) for k in keys], *sort_within)
    (out.write.mode("overwrite").option("compression", compression).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path))


def write_table(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_text_rows(df: DataFrame, path: str) -> None:
    """CSV with one header per file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_manifest(keys: DataFrame, path: str) -> None:
    """Record processed keys, including keys that produced no rows (a
    partitioned write creates no folder for an empty key)."""
    keys.distinct().write.mode("append").parquet(path)


def existing_keys(spark, path: str, keys: Sequence[str]) -> DataFrame | None:
    """Partition keys already present under ``path`` (None when nothing exists)."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.select(*keys).distinct()
