"""Incremental build of the quarterly holdings from their archives."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import joins_by_hash, scratch, shuffles_removed
from ..sources.readers import read_zip_member
from ..sources.schemas import MEMBERS
from ..sources.sinks import existing_keys, write_manifest, write_partitioned, write_table
from ..sources.zips import archive_sizes
from .holdings import holdings_13f, output_order
from .periods import filing_window, missing_keys

_MANIFEST = "period date, n_rows long"
T = TypeVar("T")

#: bytes of archives that one plan reads; a larger archive has a plan of its own
BATCH_BYTES = 64 << 20
#: plans that run at once, so that the cores which one leaves idle have work
AT_ONCE = 2


def batches(items: Sequence[T], size: Callable[[T], int], most: int) -> list[list[T]]:
    """The items in order, in lists of at most ``most`` together; one that is larger is alone."""
    out: list[list[T]] = []
    held = 0
    for x in items:
        if not out or held + size(x) > most:
            out.append([])
            held = 0
        out[-1].append(x)
        held += size(x)
    return out


def planned(spark: SparkSession, periods: DataFrame, manifest: str, force: bool = False) -> DataFrame:
    """The wanted periods that the manifest does not list, or all with ``force``; sorted."""
    done = existing_keys(spark, manifest, ["period"])
    todo = periods.select("period").distinct() if done is None else missing_keys(periods, done, ["period"], force)
    return todo.orderBy("period")


def build_holdings(spark: SparkSession, zips: str, out: str, manifest: str, periods: DataFrame,
                   symbols: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Build the periods that are missing, and return what was built: (period, n_rows).

    Only the archives of those periods are read, up to ``BATCH_BYTES`` of them by one plan, ``AT_ONCE`` plans
    at a time, so that the disk for shuffles grows with the largest archive and not with all of them. Each plan
    reads ``symbols``: a stored table. Its filings are stored, too, as long as it runs. The table is
    partitioned by period, each file sorted by ``output_order``. The manifest gets
    a period after its data is committed, so a run that is lost in between is
    repeated and overwrites its own partitions. A period without a filing has
    no partition; the manifest lists it with no rows.
    """
    # one row a quarter
    rows = planned(spark, periods, manifest, force).select("period", filing_window(F.col("period"))[2].alias("name")).collect()
    if not rows:
        return spark.createDataFrame([], _MANIFEST)
    todo = spark.createDataFrame([(r["period"],) for r in rows], "period date")
    sizes = {a.rpartition("/")[2]: n for a, n in archive_sizes(zips, [r["name"] for r in rows]).items()}

    def members(some: list[Row]) -> list[DataFrame]:
        names = sorted({r["name"] for r in some})
        # an archive is known by its name: all are of one folder
        return [read_zip_member(spark, zips, member, cols, names=names).withColumn("archive", F.substring_index("archive", "/", -1))
                for member, cols in MEMBERS.items()]

    def build(some: list[Row], sub: DataFrame, cov: DataFrame, info: DataFrame, om2: DataFrame) -> None:
        own = spark.range(1).select(F.explode(F.array(*[F.lit(r["period"]) for r in some])).alias("period"))
        with scratch(spark) as place:
            def stored(df: DataFrame) -> DataFrame:
                write_table(df, place)
                return spark.read.schema(df.schema).parquet(place)
            df = holdings_13f(sub, cov, info, om2, own, symbols, stored=stored)
            write_partitioned(df, out, ["period_of_report"], output_order(), "zstd", len(some) == 1)

    with shuffles_removed(spark), joins_by_hash(spark), ThreadPoolExecutor(AT_ONCE) as pool:
        run = inheritable_thread_target(spark)(build)
        running = [pool.submit(run, some, *members(some)) for some in batches(rows, lambda r: sizes.get(r["name"], 0), BATCH_BYTES)]
        try:
            for r in running:
                r.result()
        finally:
            # after a failure no other plan begins
            pool.shutdown(cancel_futures=True)
    there = existing_keys(spark, out, ["period_of_report"])
    counts = todo.withColumn("n_rows", F.lit(0).cast("long"))
    if there is not None:
        built = spark.read.parquet(out).groupBy(F.col("period_of_report").alias("period")).agg(F.count(F.lit(1)).alias("n"))
        counts = todo.join(built, "period", "left").select("period", F.coalesce("n", F.lit(0)).alias("n_rows"))
    # one row a quarter
    counts = spark.createDataFrame(counts.orderBy("period").collect(), _MANIFEST)
    write_manifest(counts, manifest)
    return counts
