"""Quarterly report periods, their filing windows and incremental run planning."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First report period of the quarterly data sets, and the period
# after which the sets switched from receipt-quarter files to 3-month windows.
EARLIEST_PERIOD = _dt.date(2013, 3, 31)
LAST_RECEIPT_QUARTER_PERIOD = _dt.date(2023, 9, 30)
TRANSITION_PERIOD = _dt.date(2023, 12, 31)
TRANSITION_ARCHIVE = "01jan2024-29feb2024_form13f.zip"


def quarter_ends(start: Column, end: Column) -> Column:
    """Array of quarter-end dates between two dates (inclusive)."""
    first = F.last_day(F.add_months(F.trunc(start, "quarter"), 2))
    n = F.floor(F.months_between(F.trunc(end, "quarter"), F.trunc(start, "quarter")) / 3).cast("int")
    return F.transform(F.sequence(F.lit(0), n),
                       lambda i: F.last_day(F.add_months(first, i * 3)))


def _mon(d: Column) -> Column:
    return F.lower(F.date_format(d, "MMM"))


def _stamp(d: Column) -> Column:
    return F.concat(F.date_format(d, "dd"), _mon(d), F.date_format(d, "yyyy"))


def filing_window(period: Column) -> tuple[Column, Column, Column]:
    """(window_start, window_end, archive_name) of a quarter-end ``period``.

    Through 2023-09-30 the archive is the calendar quarter of receipt (the
    quarter after the period); 2023-12-31 has a two-month transition file;
    later periods use the windows Mar-May, Jun-Aug, Sep-Nov and Dec-Feb.
    """
    y = F.year(period)
    m = F.month(period)
    receipt_start = F.date_add(period, 1)
    receipt_end = F.last_day(F.add_months(period, 3))
    receipt_name = F.concat(F.year(receipt_start).cast("string"), F.lit("q"),
                            F.quarter(receipt_start).cast("string"), F.lit("_form13f.zip"))
    win_start = F.make_date(y, m, F.lit(1))
    win_end = F.last_day(F.add_months(win_start, 2))
    win_name = F.concat(_stamp(win_start), F.lit("-"), _stamp(win_end), F.lit("_form13f.zip"))
    old = period <= F.lit(LAST_RECEIPT_QUARTER_PERIOD)
    trans = period == F.lit(TRANSITION_PERIOD)
    start = F.when(old, receipt_start).when(trans, F.lit(_dt.date(2024, 1, 1))).otherwise(win_start)
    end = F.when(old, receipt_end).when(trans, F.lit(_dt.date(2024, 2, 29))).otherwise(win_end)
    name = F.when(old, receipt_name).when(trans, F.lit(TRANSITION_ARCHIVE)).otherwise(win_name)
    return start, end, name


def period_dim(spark: SparkSession, start: _dt.date | Column, end: _dt.date | Column,
               today: _dt.date | None = None,
               earliest: _dt.date | None = EARLIEST_PERIOD) -> DataFrame:
    """One row per report period in [start, end]: period, window, archive name.

    Periods before the first data set or not yet over (>= today) are left out.
    """
    s = F.lit(start) if isinstance(start, _dt.date) else start
    e = F.lit(end) if isinstance(end, _dt.date) else end
    df = spark.range(1).select(F.explode(quarter_ends(s, e)).alias("period"))
    return periods_with_windows(df, today, earliest)


def periods_with_windows(df: DataFrame, today: _dt.date | None = None,
                         earliest: _dt.date | None = EARLIEST_PERIOD) -> DataFrame:
    p = F.col("period")
    ws, we, name = filing_window(p)
    out = df.where(p >= F.lit(earliest)) if earliest else df
    if today is not None:
        out = out.where(p < F.lit(today))
    return out.select("period", ws.alias("window_start"), we.alias("window_end"),
                      name.alias("archive_name"))


def window_months(periods: DataFrame) -> DataFrame:
    """(period, month) for every month a filing window covers (2-3 rows per period)."""
    return periods.select(
        "period",
        F.explode(F.sequence(F.trunc("window_start", "MM"), F.trunc("window_end", "MM"),
                             F.expr("interval 1 month"))).alias("month"))


def missing_keys(wanted: DataFrame, existing: DataFrame, keys: list[str],
                 force: bool = False) -> DataFrame:
    """Keys still to build: everything when ``force``, else wanted minus existing."""
    w = wanted.select(*keys).distinct()
    return w if force else w.join(existing.select(*keys).distinct(), keys, "left_anti")
