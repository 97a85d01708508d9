import datetime as dt

from tidemark.operators import reconcile, reconcile_stats
from tidemark.plans.periods import period_dim

D = dt.date


def test_windows_change_after_the_third_quarter_of_2023(spark):
    rows = {r.period: r for r in period_dim(spark, D(2023, 7, 1), D(2024, 12, 31), today=D(2024, 7, 1)).collect()}
    assert sorted(rows) == [D(2023, 9, 30), D(2023, 12, 31), D(2024, 3, 31), D(2024, 6, 30)]
    assert rows[D(2023, 9, 30)].archive_name == "2023q4_form13f.zip"
    assert (rows[D(2023, 12, 31)].window_start, rows[D(2023, 12, 31)].window_end) == (D(2024, 1, 1), D(2024, 2, 29))
    assert rows[D(2023, 12, 31)].archive_name == "01jan2024-29feb2024_form13f.zip"
    assert rows[D(2024, 3, 31)].archive_name == "01mar2024-31may2024_form13f.zip"


def test_periods_before_the_first_data_set_are_left_out(spark):
    assert [r.period for r in period_dim(spark, D(2012, 1, 1), D(2013, 6, 30)).collect()] == [D(2013, 3, 31), D(2013, 6, 30)]


def test_ranges_of_each_source(spark):
    days = [D(2025, 1, k) for k in range(1, 6)]
    a = spark.createDataFrame([(days[1], 1.0), (days[3], 2.0)], "date date, a double")
    b = spark.createDataFrame([(days[0], 1.0), (days[4], None)], "date date, b double")
    s = reconcile_stats(reconcile(a, b, ["date"], "a", "b"), "a", "b", day="date").first()
    assert (s.left_from, s.left_to, s.right_from, s.right_to) == (days[1], days[3], days[0], days[0])
