import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tidemark.plans.trading_calendar import session_calendar, session_of, within_calendar

D = dt.date


def test_a_day_beyond_the_range_fails(spark):
    cal = session_calendar(spark, D(2025, 6, 1), D(2025, 6, 30))
    days = spark.createDataFrame([(D(2025, 6, 1),), (D(2025, 6, 30),), (None,)], "d date")
    assert within_calendar(days, "d", cal).count() == 3
    for day in (D(2025, 5, 31), D(2025, 7, 1)):
        with pytest.raises(PySparkException, match="outside the calendar"):
            within_calendar(days.union(spark.createDataFrame([(day,)], "d date")), "d", cal).collect()
    with pytest.raises(PySparkException, match="outside the calendar"):
        within_calendar(days, "d", cal.limit(0)).collect()


def test_session_on_a_side(spark):
    cal = session_calendar(spark, D(2025, 6, 1), D(2025, 6, 30))
    days = spark.createDataFrame([(1, D(2025, 6, 19)), (2, D(2025, 6, 20)), (3, None)], "n int, day date")
    for side, want in (("prev", {1: D(2025, 6, 18), 2: D(2025, 6, 20), 3: None}), ("next", {1: D(2025, 6, 20), 2: D(2025, 6, 20), 3: None})):
        assert {r.n: r.s for r in session_of(days, "day", cal, side, "s").collect()} == want
    with pytest.raises(PySparkException, match="outside the calendar"):
        session_of(spark.createDataFrame([(D(2026, 1, 1),)], "day date"), "day", cal, "prev", "s").collect()
