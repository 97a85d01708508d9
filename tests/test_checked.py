import json
import os

import datetime as dt
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans.events import coupon_auctions, treasury_events
from tidemark.plans.trading_calendar import session_calendar
from tidemark.sources.checked import check_auctions, check_bls_series, check_fred_csv, check_release_dates


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return folder


def _auction(cusip, day="2025-06-10T00:00:00", **more):
    return {"type": "Note", "originalSecurityTerm": "10-Year", "auctionDate": day, "cusip": cusip, **more}


def _feeds(tmp):
    announced = [_auction("A", offeringAmount="39000000000"), _auction("A", offeringAmount="1"), _auction("B", "soon"), "text", _auction("C", None)]
    return {"announced": _put(f"{tmp}/announced", "a.json", json.dumps(announced, indent=1)),
            "notes": _put(f"{tmp}/notes", "b.json", json.dumps([_auction("A", highYield="4.1", bidToCoverRatio="2.5"), _auction("D", highYield="4.2")])),
            "bonds": _put(f"{tmp}/bonds", "c.json", '[{"type": "Bond"')}


def test_auctions_that_cannot_be_used_are_listed(spark, tmpdir_path):
    check = check_auctions(spark, _feeds(tmpdir_path))
    assert sorted(r.cusip for r in check.good.collect()) == ["A", "A", "A", "D"]
    got = sorted((os.path.basename(r.file), r.reason, r.raw) for r in check.rejects.collect())
    assert [g[:2] for g in got] == [("a.json", "bad auction date"), ("a.json", "bad auction date"), ("a.json", "not an auction"), ("c.json", "not an array of auctions")]
    assert json.loads(got[0][2])["cusip"] in "BC" and got[3][2] == '[{"type": "Bond"'


def test_first_to_arrive_or_results_first(spark, tmpdir_path):
    good = check_auctions(spark, _feeds(tmpdir_path)).good
    first = {r.cusip: r for r in coupon_auctions(good).collect()}
    # inside a feed the order of arrival decides, not the values
    assert (first["A"].feed_rank, first["A"].offeringAmount, first["A"].highYield) == (0, "39000000000", None)
    results = {r.cusip: r for r in coupon_auctions(good, prefer="results").collect()}
    assert (results["A"].feed_rank, results["A"].highYield, results["D"].feed_rank) == (1, "4.1", 1)
    with pytest.raises(ValueError):
        coupon_auctions(good, prefer="last")


def test_a_bad_day_that_was_not_checked_fails(spark):
    cal = session_calendar(spark, dt.date(2025, 6, 1), dt.date(2025, 6, 30), trim=False)
    rows = spark.createDataFrame([("Note", "10-Year", d, "A", "No", "1", None, None, 0) for d in ("2025-06-10", "soon")],
                                 "type string, originalSecurityTerm string, auctionDate string, cusip string, reopening string, offeringAmount string, "
                                 "highYield string, bidToCoverRatio string, feed_rank int")
    assert treasury_events(spark, cal, rows.limit(1)).where(F.col("sym") == "AUCTION_10Y").count() == 1
    with pytest.raises(PySparkException, match="bad date"):
        treasury_events(spark, cal, rows).collect()


def test_each_payload_is_read_or_listed_once(spark, tmpdir_path):
    release = [{"release": "CPI", "year": 2025, "release_dates": [{"date": "2025-01-10"}, {"date": "2025-02-10"}]},
               {"release": "PPI", "year": 2025, "release_dates": []}, {"release": "GDP", "year": 2025, "release_dates": [{"date": "2025-13-01"}]}, {"error": "x"}]
    check = check_release_dates(spark, _put(f"{tmpdir_path}/r", "x.json", "\n".join(map(json.dumps, release)) + "\n\n<html>\n")).written(f"{tmpdir_path}/out")
    assert {(r.release, r.d) for r in check.good.collect()} == {("CPI", dt.date(2025, 1, 10)), ("CPI", dt.date(2025, 2, 10)), ("PPI", None)}
    assert sorted(r.reason for r in check.rejects.collect()) == ["bad date", "no release dates", "not JSON"]
    assert check.counts == {"good": 3, "rejected": 3}
    none = check_release_dates(spark, _put(f"{tmpdir_path}/e", "x.json", "")).written(f"{tmpdir_path}/none")
    assert none.good.count() == none.rejects.count() == 0 and none.counts == {"good": 0, "rejected": 0}


def test_series_payloads_and_files(spark, tmpdir_path):
    data = [{"year": "2025", "period": p, "value": v} for p, v in (("M01", "1.5"), ("M13", "9"), ("M02", "-"))]
    good = {"status": "REQUEST_SUCCEEDED", "Results": {"series": [{"seriesID": "S", "data": data}]}}
    lines = [json.dumps(good), json.dumps({**good, "status": "REQUEST_NOT_PROCESSED"}), json.dumps({"Results": None}), "{"]
    check = check_bls_series(spark, _put(f"{tmpdir_path}/b", "x.json", "\n".join(lines)))
    assert [tuple(r) for r in check.good.collect()] == [("S", 2025, 1, 1.5)]
    assert sorted(r.reason for r in check.rejects.collect()) == ["not JSON", "not succeeded", "not succeeded"]
    _put(f"{tmpdir_path}/c", "ICSA.csv", "observation_date,ICSA\n2025-01-04,203000\n2025-01-11,.\n2025-01-18,\n2025-01-25,many\nlater,3\n")
    check = check_fred_csv(spark, _put(f"{tmpdir_path}/c", "GDP.csv", "<html>,x\n2025-01-01,5\n"))
    assert [tuple(r) for r in check.good.collect()] == [("ICSA", dt.date(2025, 1, 4), 203000.0)]
    assert sorted((os.path.basename(r.file), r.reason, r.raw) for r in check.rejects.collect()) == [
        ("GDP.csv", "no header", "2025-01-01,5"), ("GDP.csv", "no header", "<html>,x"), ("ICSA.csv", "bad date", "later,3"), ("ICSA.csv", "bad value", "2025-01-25,many")]
