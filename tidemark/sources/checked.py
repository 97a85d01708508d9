"""Payloads that are checked as they are read.

A check reads its files once and gives every row either its fields or a reason
why it cannot be used, with the file and the raw text. ``good`` and
``rejects`` are the two halves; ``written`` stores both by one run of the
plan, counted on the way by ``DataFrame.observe``, so that the source is read
once however often the halves are used. A bad payload never fails the job and
never disappears.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import try_double, try_long
from .schemas import BLS_JSON, FRED_CSV, FRED_RELEASE_DATES_JSON, TREASURY_AUCTION

_TRACE = ["file", "reason", "raw"]
_CORRUPT = "_corrupt_record"


class Checked:
    """Rows with ``columns`` where they are usable, else with ``file``, ``reason`` and ``raw``."""

    def __init__(self, rows: DataFrame, columns: Sequence[str], counts: dict[str, int] | None = None):
        self.rows, self.columns, self.counts = rows, list(columns), counts

    @property
    def good(self) -> DataFrame:
        return self.rows.where("reason IS NULL").select(*self.columns)

    @property
    def rejects(self) -> DataFrame:
        return self.rows.where("reason IS NOT NULL").select(*_TRACE)

    def written(self, place: str) -> Checked:
        """Both halves as one table under ``place``, in a partition each; ``counts`` has the rows of each half."""
        seen = Observation()
        rows = self.rows.observe(seen, F.count_if(F.col("reason").isNull()).alias("good"), F.count("reason").alias("rejected"))
        rows.withColumn("rejected", F.col("reason").isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(place)
        back = self.rows.sparkSession.read.schema(self.rows.withColumn("rejected", F.lit(True)).schema).parquet(place)
        return Checked(back.drop("rejected"), self.columns, dict(seen.get))


def _reason(*cases: tuple[str, Column]) -> Column:
    """The first reason whose condition holds, null where none does."""
    out = F.when(cases[0][1], cases[0][0])
    for text, condition in cases[1:]:
        out = out.when(condition, text)
    return out


def _lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(raw, file, name) of every line that is not blank, or of every whole file."""
    text = spark.read.text(path, wholetext=whole)
    return (text.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"))
                .where(F.trim("raw") != ""))


def _parsed(raw: Column, schema: T.DataType) -> Column:
    return F.from_json(raw, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return schema if _CORRUPT in schema.names else T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def check_release_dates(spark: SparkSession, path: str) -> Checked:
    """(release, year, d) of release schedules, a payload a line; an empty schedule is a row without ``d``.

    Rejected: text that is no payload, payloads without dates, and with a date that does not parse (the whole payload).
    """
    rows = _lines(spark, path).withColumn("p", _parsed(F.col("raw"), _with_corrupt(FRED_RELEASE_DATES_JSON)))
    bad = F.exists("p.release_dates", lambda x: F.try_to_date(x["date"], "yyyy-MM-dd").isNull())
    rows = rows.withColumn("reason", _reason(
        ("not JSON", F.col("p").isNull() | F.col(f"p.{_CORRUPT}").isNotNull()),
        ("no release dates", F.col("p.release_dates").isNull() | F.col("p.release").isNull() | F.col("p.year").isNull()),
        ("bad date", bad)))
    # a rejected payload stays one row
    dates = F.when(F.col("reason").isNull(), F.col("p.release_dates"))
    rows = rows.select("*", F.explode_outer(dates).alias("x"))
    return Checked(rows.select(F.col("p.release").alias("release"), F.col("p.year").alias("year"),
                               F.try_to_date(F.col("x.date"), "yyyy-MM-dd").alias("d"), *_TRACE), ["release", "year", "d"])


def check_auctions(spark: SparkSession, feeds: dict[str, str], payload_lines: bool = False) -> Checked:
    """The auctions of the feeds, in the given order, each with ``feed``, ``feed_rank``, ``file`` and its ``place`` in the payload.

    A payload is an array of auctions: a file, or with ``payload_lines`` a line. Rejected: payloads
    that are no array (whole), and single auctions that are no object or have no day (``auctionDate`` from its first ten characters).
    """
    fields = [n for n in TREASURY_AUCTION.names if n != _CORRUPT]
    out = None
    for rank, (feed, path) in enumerate(feeds.items()):
        # nested objects keep their text
        payload = _lines(spark, path, not payload_lines).withColumn("items", F.from_json("raw", "array<string>", {"mode": "PERMISSIVE"}))
        payload = payload.withColumn("whole", F.col("items").isNotNull())
        items = payload.select("file", "raw", "whole", F.posexplode_outer("items").alias("place", "item")).where("NOT whole OR place IS NOT NULL")
        one = items.withColumn("p", _parsed(F.col("item"), _with_corrupt(TREASURY_AUCTION)))
        one = one.withColumn("reason", _reason(
            ("not an array of auctions", ~F.col("whole")),
            ("not an auction", F.col("p").isNull() | F.col(f"p.{_CORRUPT}").isNotNull()),
            ("bad auction date", F.try_to_date(F.substring("p.auctionDate", 1, 10), "yyyy-MM-dd").isNull())))
        one = one.select(*[F.col(f"p.{n}").alias(n) for n in fields], F.lit(feed).alias("feed"), F.lit(rank).alias("feed_rank"),
                         "place", "file", "reason", F.when(F.col("whole"), F.col("item")).otherwise(F.col("raw")).alias("raw"))
        out = one if out is None else out.unionByName(one)
    return Checked(out, [*fields, "feed", "feed_rank", "file", "place"])


def check_bls_series(spark: SparkSession, path: str) -> Checked:
    """(series, year, month, value) of series payloads, one a line; yearly periods and values that are no number are left out.

    Rejected: text that is no payload, and payloads that did not succeed.
    """
    rows = _lines(spark, path).withColumn("p", _parsed(F.col("raw"), _with_corrupt(BLS_JSON)))
    rows = rows.withColumn("reason", _reason(
        ("not JSON", F.col("p").isNull() | F.col(f"p.{_CORRUPT}").isNotNull()),
        ("not succeeded", ~F.col("p.status").eqNullSafe("REQUEST_SUCCEEDED"))))
    usable = F.col("reason").isNull()
    rows = rows.select(*_TRACE, F.explode_outer(F.when(usable, F.col("p.Results.series"))).alias("s"))
    rows = rows.select(*_TRACE, F.col("s.seriesID").alias("series"), F.explode_outer("s.data").alias("x"))
    rows = rows.select("series", try_long(F.col("x.year")).cast("int").alias("year"), try_long(F.substring(F.col("x.period"), 2, 2)).cast("int").alias("month"),
                       try_double(F.col("x.value")).alias("value"), F.col("x.period").alias("period"), *_TRACE)
    month = F.col("period").startswith("M") & (F.col("period") != "M13")
    known = month & F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("value").isNotNull()
    return Checked(rows.where(F.col("reason").isNotNull() | known).drop("period"), ["series", "year", "month", "value"])


def check_fred_csv(spark: SparkSession, path: str) -> Checked:
    """(series, d, value) of ``observation_date,value`` files named ``<SERIES>.csv``; empty and ``.`` values are left out.

    Rejected: every line of a file without that header (an error page, say), and lines whose date or value does not parse.
    """
    lines = _lines(spark, path).withColumn("x", F.from_csv("raw", FRED_CSV, {"mode": "PERMISSIVE"}))
    header = F.col("raw").startswith("observation_date")
    files = lines.where(header).select("file").distinct().withColumn("headed", F.lit(True))
    rows = lines.where(~header).join(files, "file", "left")
    day, number = F.try_to_date("x.observation_date", "yyyy-MM-dd"), F.trim("x.value").try_cast("double")
    missing = F.coalesce(F.trim("x.value"), F.lit("")).isin("", ".")
    rows = rows.withColumn("reason", _reason(("no header", F.col("headed").isNull()), ("bad date", day.isNull()), ("bad value", ~missing & number.isNull())))
    rows = rows.where(F.col("reason").isNotNull() | ~missing)
    return Checked(rows.select(F.regexp_extract("name", r"^([^.]+)", 1).alias("series"), day.alias("d"), number.alias("value"), *_TRACE), ["series", "d", "value"])
