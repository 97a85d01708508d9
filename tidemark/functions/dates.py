"""Calendar arithmetic as Column expressions (weekday: Monday = 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c

NEW_YORK = "America/New_York"


def month_start(d: Column | str) -> Column:
    return F.trunc(_c(d), "MM")


def nth_weekday(month_first: Column | str, weekday: int, n: int) -> Column:
    """n-th (1-based) ``weekday`` of the month starting at ``month_first``."""
    f = _c(month_first)
    return F.date_add(f, F.pmod(F.lit(weekday) - F.weekday(f), F.lit(7)) + F.lit(7 * (n - 1)))


def last_weekday(month_first: Column | str, weekday: int) -> Column:
    last = F.last_day(_c(month_first))
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)))


def day_of_month(month_first: Column | str, day: int) -> Column:
    return F.date_add(_c(month_first), day - 1)


def month_label(d: Column | str) -> Column:
    """``"May 2026"``."""
    return F.date_format(_c(d), "MMMM yyyy")


def prev_month_label(d: Column | str) -> Column:
    return month_label(F.add_months(month_start(d), -1))


def quarter_label(q: Column, year: Column) -> Column:
    return F.concat(F.lit("Q"), q.cast("string"), F.lit(" "), year.cast("string"))


def sec_date_text(d: Column | str) -> Column:
    """Date as upper-case ``DD-MON-YYYY`` (``31-MAR-2025``)."""
    return F.upper(F.date_format(_c(d), "dd-MMM-yyyy"))


def parse_sec_date(c: Column | str) -> Column:
    """Parse ``31-MAR-2025`` / ``31-Mar-2025``; unparsable -> null."""
    return F.try_to_date(_c(c), "dd-MMM-yyyy")


def parse_iso_prefix(c: Column | str) -> Column:
    """Date from the first ten characters (``2025-01-30T00:00:00`` -> 2025-01-30)."""
    return F.try_to_date(F.substring(_c(c), 1, 10), "yyyy-MM-dd")


def wall_clock(d: Column | str, hour: int | Column, minute: int | Column = 0, tz: str = NEW_YORK) -> Column:
    """Instant of the wall-clock time ``hour:minute`` in ``tz`` on day ``d``."""
    col = _c(d)
    return F.make_timestamp(F.year(col), F.month(col), F.dayofmonth(col),
                            F.lit(hour), F.lit(minute), F.lit(0), F.lit(tz))


def wall_clock_utc(d: Column | str, hour: int, minute: int = 0, tz: str = NEW_YORK) -> Column:
    """Same instant as a UTC ``timestamp_ntz`` (independent of the session zone)."""
    local = F.make_timestamp_ntz(F.year(_c(d)), F.month(_c(d)), F.dayofmonth(_c(d)),
                                 F.lit(hour), F.lit(minute), F.lit(0))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def month_floor_ntz(ts: Column | str) -> Column:
    """Truncate to the month and keep a time-zone-free timestamp."""
    return F.trunc(_c(ts).cast("date"), "MM").cast("timestamp_ntz")


def years_back(d: Column | str, years: int) -> Column:
    """Same day ``years`` earlier; 29 February clamps to the 28th."""
    return F.add_months(_c(d), -12 * years)
