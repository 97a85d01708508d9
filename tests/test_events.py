import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans.events import all_events, market_events, uncovered_years
from tidemark.plans.trading_calendar import session_calendar


def _events(spark, start, end, **kw):
    cal = session_calendar(spark, start, end, trim=False)
    ev = all_events(spark, cal, start=F.lit(start), end=F.lit(end), **kw)
    return {(r.d, r.sym): r for r in ev.collect()}


def test_worked_dates(spark):
    ev = _events(spark, dt.date(2025, 4, 1), dt.date(2026, 12, 31))
    keys = set(ev)
    assert (dt.date(2026, 6, 18), "TRIPLE_WITCHING") in keys          # Juneteenth Friday
    assert (dt.date(2025, 5, 23), "RUSSELL_PRELIM") in keys
    assert (dt.date(2026, 5, 22), "RUSSELL_PRELIM") in keys
    assert (dt.date(2026, 12, 11), "RUSSELL_RECON") in keys
    assert not any(s == "RUSSELL_RECON" and d.year == 2025 and d.month == 12 for d, s in keys)
    assert (dt.date(2025, 4, 30), "ADP") not in keys                   # lost at the month edge
    assert (dt.date(2025, 5, 2), "NFP") in keys
    assert (dt.date(2025, 11, 26), "JOBLESS_CLAIMS") in keys          # Thanksgiving week
    assert (dt.date(2025, 11, 27), "JOBLESS_CLAIMS") not in keys
    fomc = ev[(dt.date(2025, 6, 18), "FOMC")]
    assert fomc.event_name.endswith("(dot plot)") and fomc.schedule_source == "official"
    assert ev[(dt.date(2025, 7, 9), "FOMC_MINUTES")].event_name == "FOMC minutes of the June 2025 meeting"


def test_years_without_an_embedded_calendar(spark):
    cal = session_calendar(spark, dt.date(2024, 1, 1), dt.date(2027, 12, 31))
    got = {tuple(r) for r in uncovered_years(cal).collect()}
    assert got == {("ECB", 2024), ("BOJ", 2024), ("QRA", 2024), *((c, 2027) for c in ("FOMC", "ECB", "BOJ", "QRA"))}


def test_adp_kept_in_april(spark):
    ev = _events(spark, dt.date(2025, 4, 1), dt.date(2025, 4, 30))
    assert (dt.date(2025, 4, 2), "ADP") in ev


def test_schedule_three_valued(spark):
    d = dt.date
    sched = spark.createDataFrame([("CPI", 2025, d(2025, 3, 12))], "release string, year int, d date")
    cov = spark.createDataFrame([("CPI", 2025), ("PPI", 2025)], "release string, year int")
    ev = _events(spark, d(2025, 3, 1), d(2025, 3, 31), schedules=sched, coverage=cov)
    assert ev[(d(2025, 3, 12), "CPI")].schedule_source == "fred"
    assert not any(s == "PPI" for _, s in ev)                          # available, not listed
    assert any(s == "NFP" and v.schedule_source == "rule" for (_, s), v in ev.items())


def test_summaries_and_status(spark):
    d = dt.date
    cal = session_calendar(spark, d(2025, 6, 1), d(2025, 6, 30), trim=False)
    obs = spark.createDataFrame(
        [("CUSR0000SA0", d(2025, 5, 1), 101.0), ("CUSR0000SA0", d(2025, 4, 1), 100.0),
         ("DFEDTARU", d(2025, 6, 10), 4.5), ("DFEDTARU", d(2025, 6, 19), 4.25),
         ("DFEDTARL", d(2025, 6, 19), 4.0)], "series string, d date, value double")
    ev = market_events(spark, cal, dt.datetime(2025, 6, 20), observations=obs,
                       start=F.lit(d(2025, 6, 1)), end=F.lit(d(2025, 6, 30)))
    rows = {r.sym: r for r in ev.collect()}
    assert rows["CPI"].summarize == "CPI May 2025: m/m +1.0% (BLS)."
    assert rows["FOMC"].summarize == "FOMC cut rates 25bp to 4.00–4.25% (upper bound was 4.50%)."
    assert rows["PPI"].summarize.startswith("Producer Price Index (final demand) for May 2025 released")
    assert rows["UMICH_FINAL"].event_date_type == "expected" and rows["UMICH_FINAL"].summarize is None


def test_adp_follows_the_rule_where_the_schedule_is_not_covered(spark):
    d = dt.date
    sched = spark.createDataFrame([("NFP", 2025, d(2025, 3, 21))], "release string, year int, d date")
    cov = spark.createDataFrame([("CPI", 2025)], "release string, year int")
    ev = _events(spark, d(2025, 3, 1), d(2025, 3, 31), schedules=sched, coverage=cov)
    assert (d(2025, 3, 5), "ADP") in ev and (d(2025, 3, 19), "ADP") not in ev


def test_repeated_observations_do_not_multiply_events(spark):
    d = dt.date
    cal = session_calendar(spark, d(2025, 6, 1), d(2025, 6, 30), trim=False)
    rows = [("CUSR0000SA0", d(2025, 5, 1), 101.0), ("CUSR0000SA0", d(2025, 4, 1), 100.0)]
    obs = spark.createDataFrame(rows * 2, "series string, d date, value double")
    ev = market_events(spark, cal, dt.datetime(2025, 7, 20), observations=obs, start=F.lit(d(2025, 6, 1)), end=F.lit(d(2025, 6, 30)))
    assert ev.columns == ["time", "sym", "event_name", "release_for", "event_date_type", "summarize", "schedule_source"]
    got = ev.collect()
    assert len([r for r in got if r.sym == "CPI"]) == 1
    assert [(r.time, r.sym) for r in got] == sorted((r.time, r.sym) for r in got)


def test_a_bad_date_makes_the_payload_unusable(spark, tmpdir_path):
    import json

    from tidemark.sources.readers import read_fred_release_dates
    with open(f"{tmpdir_path}/x.json", "w") as f:
        for year, second in ((2025, "soon"), (2026, "2026-02-11")):
            f.write(json.dumps({"release": "CPI", "year": year, "release_dates": [{"date": f"{year}-01-10"}, {"date": second}]}) + "\n")
    assert {(r.year, r.d.day) for r in read_fred_release_dates(spark, tmpdir_path).collect()} == {(2026, 10), (2026, 11)}
