"""Readers for the landed files. Every reader takes a directory or glob, so
many dates / quarters / years are read in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .checked import check_auctions, check_bls_series, check_fred_csv, check_release_dates
from .schemas import FIGI_REPLY, FRED_RELEASE_JSON, all_strings
from .zips import list_archives, read_members

#: fixed value: the column that only newer archives have
LATER_COLUMNS = ("FIGI",)


def file_date(pattern: str = r"(\d{4}-\d{2}-\d{2})", path_col: str = "_metadata.file_path") -> Column:
    """Date taken from the file path (``.../2024/01/2024-01-02.csv.gz``).

    ``path_col`` names a column holding the path when ``_metadata`` is not
    available.
    """
    return F.to_date(F.regexp_extract(F.col(path_col), pattern, 1), "yyyy-MM-dd")


def read_csv_typed(spark: SparkSession, path: str | list[str], ddl: str, sep: str = ",",
                   header: bool = True) -> DataFrame:
    return spark.read.schema(ddl).option("header", header).option("sep", sep).csv(path)


def read_sec_tsv(spark: SparkSession, path: str | list[str], cols: list[str]) -> DataFrame:
    """Extracted tab-separated member files: no quoting, all strings.

    Extra fields are dropped, missing trailing fields are null, a quote
    character stays part of the value, undecodable bytes become U+FFFD.
    Columns are bound by position to ``cols`` (the header is skipped).
    """
    return (spark.read.schema(all_strings(cols)).option("sep", "\t").option("quote", "")
                 .option("escape", "").option("header", True).option("mode", "PERMISSIVE")
                 .csv(path))


def read_zip_member(spark: SparkSession, zips: str, member: str, cols: list[str],
                    optional: tuple[str, ...] = LATER_COLUMNS, names: list[str] | None = None) -> DataFrame:
    """``archive`` and ``cols``, all strings, of one member of many zip archives.

    ``zips`` is an archive, a folder or a pattern; ``names`` leaves only archives called so. The
    member is matched whatever its case, inside a folder or not; an archive
    without it fails the job. An archive is read by one task, its member only, a
    chunk of lines at a time (see ``zips``). Columns are found by each archive's own
    header: those in ``optional`` are null where the header lacks them, any other
    missing column fails the job. Fields beyond the header are left out, missing
    ones are null, empty lines are skipped, undecodable bytes become U+FFFD.
    """
    return read_members(spark, list_archives(zips, names), [member], cols, optional).drop("member")


def read_cot_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Yearly comma-separated report files, all strings, header names from the files.

    Every file's own header line is skipped; columns bind by position.
    """
    return spark.read.option("header", True).option("inferSchema", False).csv(paths)


def read_figi_replies(spark: SparkSession, path: str) -> DataFrame:
    """(cusip, pass_no, hit): ``hit`` = first element of ``data`` or null (a miss)."""
    r = spark.read.schema(FIGI_REPLY).json(path)
    return r.select("cusip", "pass_no", F.get(F.col("data"), 0).alias("hit"))


def read_fred_release_names(spark: SparkSession, path: str) -> DataFrame:
    r = spark.read.schema(FRED_RELEASE_JSON).json(path)
    return r.select("release_id", F.get(F.col("releases"), 0)["name"].alias("name"))


def read_fred_release_dates(spark: SparkSession, path: str) -> DataFrame:
    """(release, year, d); a payload that does not parse yields no row for its
    (release, year), i.e. "schedule not available"; one date that does not
    parse makes its whole payload unusable (``check_release_dates`` lists them)."""
    return check_release_dates(spark, path).good


def read_treasury_auctions(spark: SparkSession, feeds: dict[str, str]) -> DataFrame:
    """Union of the auction feeds with a ``feed_rank`` in the given order, and each auction's ``file`` and ``place``.

    ``check_auctions`` lists what is left out."""
    return check_auctions(spark, feeds).good


def read_bls_series(spark: SparkSession, path: str) -> DataFrame:
    """(series, year, month, value) of successful payloads; keeps M01..M12 and
    numeric values only (``M13``, ``Q01``, ``-`` are dropped)."""
    return check_bls_series(spark, path).good


def read_fred_csv(spark: SparkSession, path: str) -> DataFrame:
    """(series, d, value) from ``observation_date,value`` files named ``<SERIES>.csv``;
    empty and ``.`` values are dropped, ``check_fred_csv`` lists what is unusable (files without that header, bad lines)."""
    return check_fred_csv(spark, path).good
