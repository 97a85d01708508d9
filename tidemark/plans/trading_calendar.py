"""NYSE session calendar as a table: one row per day with session flags and
the nearest sessions on either side.

Holidays come from public exchange rules (weekend observance, Good Friday
from the Easter computus, Juneteenth from 2022, MLK day from 1998) plus a
fixed list of unscheduled closures. The table has one row per calendar day
of the requested range, so its size is bounded by the time span, never by
the data; its prev/next-session windows run over that bounded table only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import last_weekday, nth_weekday

# Unscheduled full-day NYSE closures.
SPECIAL_CLOSURES = [
    "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14",
    "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30",
    "2018-12-05", "2025-01-09",
]


def _d(y: Column, m: int, day: int) -> Column:
    return F.make_date(y, F.lit(m), F.lit(day))


def _observed(d: Column, saturday_to_friday: bool = True) -> Column:
    """Saturday -> Friday (unless disabled), Sunday -> Monday."""
    wd = F.weekday(d)
    sat = F.date_sub(d, 1) if saturday_to_friday else F.lit(None).cast("date")
    return F.when(wd == 5, sat).when(wd == 6, F.date_add(d, 1)).otherwise(d)


def easter_sunday(y: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus)."""
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100)
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4)
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4)
    k = F.pmod(c, F.lit(4))
    ll = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * ll) / 451)
    n = h + ll - 7 * m + 114
    return F.make_date(y, F.floor(n / 31).cast("int"), (F.pmod(n, F.lit(31)) + 1).cast("int"))


def holiday_dates(y: Column) -> Column:
    """Array of the rule-based NYSE holidays of year ``y`` (nulls for none)."""
    jan1 = _d(y, 1, 1)
    return F.array(
        _observed(jan1, saturday_to_friday=False),
        F.when(y >= 1998, nth_weekday(jan1, 0, 3)),
        nth_weekday(_d(y, 2, 1), 0, 3),
        F.date_sub(easter_sunday(y), 2),
        last_weekday(_d(y, 5, 1), 0),
        F.when(y >= 2022, _observed(_d(y, 6, 19))),
        _observed(_d(y, 7, 4)),
        nth_weekday(_d(y, 9, 1), 0, 1),
        nth_weekday(_d(y, 11, 1), 3, 4),
        _observed(_d(y, 12, 25)),
    )


def holidays(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """(d) closures between ``start`` and ``end``: rule holidays + special closures."""
    years = spark.range(1).select(F.explode(F.sequence(F.year(start), F.year(end))).alias("y"))
    rules = years.select(F.explode(holiday_dates(F.col("y"))).alias("d")).where(F.col("d").isNotNull())
    special = spark.createDataFrame([(s,) for s in SPECIAL_CLOSURES], "s string").select(
        F.to_date("s").alias("d"))
    return rules.unionByName(special).where(F.col("d").between(start, end)).distinct()


def session_calendar(spark: SparkSession, start: _dt.date | Column, end: _dt.date | Column,
                     pad_days: int = 45, trim: bool = True) -> DataFrame:
    """Calendar of every day in [start, end].

    Columns: d, is_session, prev_session (on or before d), next_session (on or
    after d), month, session_no (1-based within the month, sessions only),
    first_session/last_session of d's month. The range is padded by
    ``pad_days`` on both sides internally so shifts near the edges resolve.
    """
    s = F.lit(start) if isinstance(start, _dt.date) else start
    e = F.lit(end) if isinstance(end, _dt.date) else end
    lo, hi = F.date_sub(F.trunc(s, "MM"), pad_days), F.date_add(F.last_day(e), pad_days)
    days = spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("d"))
    closed = holidays(spark, lo, hi).withColumn("_closed", F.lit(True))
    # holidays: about ten rows per year of the range
    cal = (days.join(F.broadcast(closed), "d", "left")
               .select("d", ((F.weekday("d") < 5) & F.col("_closed").isNull()).alias("is_session")))
    out = with_session_columns(cal)
    return out.where(F.col("d").between(s, e)) if trim else out


def with_session_columns(cal: DataFrame) -> DataFrame:
    """Add prev/next session and per-month session numbering to (d, is_session)."""
    sess = F.when(F.col("is_session"), F.col("d"))
    back = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = Window.orderBy("d").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    month = Window.partitionBy("month")
    ordered = Window.partitionBy("month", "is_session").orderBy("d")
    return (cal.withColumn("prev_session", F.last(sess, ignorenulls=True).over(back))
               .withColumn("next_session", F.first(sess, ignorenulls=True).over(fwd))
               .withColumn("month", F.trunc("d", "MM"))
               .withColumn("session_no", F.when(F.col("is_session"), F.row_number().over(ordered)))
               .withColumn("first_session", F.min(sess).over(month))
               .withColumn("last_session", F.max(sess).over(month)))


def shift_lookup(cal: DataFrame) -> DataFrame:
    """(d, is_session, ps, ns): the join side for "session on/before" and "on/after"."""
    return cal.select("d", "is_session", F.col("prev_session").alias("ps"),
                      F.col("next_session").alias("ns"))


def within_calendar(rows: DataFrame, column: str, cal: DataFrame) -> DataFrame:
    """``rows``, with a check in the plan: a day outside the range of the calendar fails the job. A null day passes."""
    # two values reach the driver; a calendar has a row for every day between them
    first, last = cal.agg(F.min("d"), F.max("d")).first()
    day = F.col(column)
    inside = day.between(F.lit(first), F.lit(last)) if first else F.lit(False)
    message = F.concat(F.lit(f"outside the calendar of {first} to {last}: "), day.cast("string"))
    return rows.withColumn(column, F.when(day.isNull() | inside, day).otherwise(F.raise_error(message).cast(rows.schema[column].dataType)))


def session_of(rows: DataFrame, column: str, cal: DataFrame, side: str, out: str) -> DataFrame:
    """``rows`` with the session on or before (``side`` = prev) or on or after (next) a day; a day outside the calendar fails the job."""
    if side not in ("prev", "next"):
        raise ValueError(f"side is prev or next, not {side}")
    # one row a day of the range
    lookup = F.broadcast(cal.select(F.col("d").alias("_day"), F.col(f"{side}_session").alias(out)))
    return within_calendar(rows, column, cal).join(lookup, F.col(column) == F.col("_day"), "left").drop("_day")
