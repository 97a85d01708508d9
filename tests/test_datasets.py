import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import mismatches, reconcile, reconcile_stats
from tidemark.plans.holdings import coverage_report, holdings_13f
from tidemark.plans.stocks import stock_day
from tidemark.plans.cot import cot_filter, cot_typed, cot_monthly
from tidemark.sources.schemas import (COVERPAGE_COLS, INFOTABLE_COLS, OTHERMANAGER2_COLS, SUBMISSION_COLS,
                                      all_strings)


def _frame(spark, cols, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], all_strings(cols))


def test_holdings_end_to_end(spark):
    sub = _frame(spark, SUBMISSION_COLS, [
        dict(ACCESSION_NUMBER="a1", FILING_DATE="01-MAY-2025", SUBMISSIONTYPE="13F-HR", CIK="1", PERIODOFREPORT="31-MAR-2025"),
        dict(ACCESSION_NUMBER="a2", FILING_DATE="02-MAY-2025", SUBMISSIONTYPE=" 13F-HR/A ", CIK="1", PERIODOFREPORT="31-MAR-2025"),
        dict(ACCESSION_NUMBER="a3", FILING_DATE="02-MAY-2025", SUBMISSIONTYPE="13F-NT", CIK="2", PERIODOFREPORT="31-MAR-2025"),
        dict(ACCESSION_NUMBER="a4", FILING_DATE="02-MAY-2025", SUBMISSIONTYPE="13F-HR", CIK="3", PERIODOFREPORT=" 31-MAR-2025"),
        dict(ACCESSION_NUMBER="a5", FILING_DATE="02-MAY-2025", SUBMISSIONTYPE="13F-HR", CIK="4", PERIODOFREPORT="31-DEC-2024"),
    ])
    cov = _frame(spark, COVERPAGE_COLS, [
        dict(ACCESSION_NUMBER="a1", ISAMENDMENT="N", FILINGMANAGER_NAME="M1"),
        dict(ACCESSION_NUMBER="a2", ISAMENDMENT="Y", AMENDMENTNO="1", AMENDMENTTYPE="NEW HOLDINGS", FILINGMANAGER_NAME="M1"),
    ])
    info = _frame(spark, [c for c in INFOTABLE_COLS if c != "FIGI"], [
        dict(ACCESSION_NUMBER="a1", CUSIP=" abc ", VALUE="12.4", SSHPRNAMT="2.5", OTHERMANAGER="5,1", VOTING_AUTH_SOLE="7.9"),
        dict(ACCESSION_NUMBER="a2", CUSIP="def", VALUE=None, SSHPRNAMT="x", OTHERMANAGER=None),
        dict(ACCESSION_NUMBER="a4", CUSIP="zzz", VALUE="1"),
    ])
    om2 = _frame(spark, OTHERMANAGER2_COLS, [
        dict(ACCESSION_NUMBER="a1", SEQUENCENUMBER="1", NAME=" B ", CIK="11"),
        dict(ACCESSION_NUMBER="a1", SEQUENCENUMBER="5", NAME="A", CIK="55"),
    ])
    periods = spark.createDataFrame([(dt.date(2025, 3, 31),)], "period date")
    h = holdings_13f(sub, cov, info, om2, periods)
    rows = {r.accession_number: r for r in h.collect()}
    assert set(rows) == {"a1", "a2"} and len(h.columns) == 27
    a1 = rows["a1"]
    assert (a1.cusip, a1.value, a1.shares, a1.voting_sole) == ("ABC", 12, 2, 7)
    assert (a1.other_manager_names, a1.other_manager_ciks, a1.figi) == ("B; A", "11; 55", None)
    assert rows["a2"].amendment_type == "NEW HOLDINGS" and rows["a2"].value is None
    assert rows["a1"].amendment_type is None
    rep = coverage_report(h).first()
    assert (rep.n_rows, rep.n_entities, rep.row_share, rep.value_share) == (2, 1, 0.0, 0.0)


def test_stock_day_fanout_and_sum(spark):
    d = dt.date(2025, 1, 2)
    bars = spark.createDataFrame([("A", d, 1.0), ("B", d, 2.0)], "ticker string, date date, volume double")
    splits = spark.createDataFrame([("A", d, 1.0, 2.0), ("A", d, 1.0, 3.0)],
                                   "ticker string, date date, split_from double, split_to double")
    divs = spark.createDataFrame([("B", d, 0.1), ("B", d, 0.2)], "ticker string, date date, cash_amount double")
    tick = spark.createDataFrame([("A", "CS", "Common")], "ticker string, type string, type_desc string")
    out = stock_day(bars, splits, divs, tick).collect()
    assert sorted((r.ticker, r.split) for r in out) == [("A", 2.0), ("A", 3.0), ("B", None)]
    assert [round(r.dividend, 6) for r in out if r.ticker == "B"] == [0.3]


def test_reconcile_statuses(spark):
    d = [dt.date(2025, 1, i) for i in range(1, 6)]
    a = spark.createDataFrame([(d[0], 1.0), (d[1], 2.0), (d[3], 5.005), (d[4], 3.0)], "date date, a double")
    b = spark.createDataFrame([(d[0], 1.0), (d[2], 2.0), (d[3], 5.0), (d[4], 0.0)], "date date, b double")
    rec = reconcile(a, b, ["date"], "a", "b")
    st = {r.date: (r.match_status, r.pct_diff) for r in rec.collect()}
    assert st[d[1]][0] == "left_only" and st[d[2]][0] == "right_only" and st[d[4]] == ("both", None)
    s = reconcile_stats(rec, "a", "b").first()
    assert (s.n_both, s.n_left_only, s.n_right_only, s.n_mismatch) == (3, 1, 1, 1)
    assert [r.date for r in mismatches(rec, ["date"]).collect()] == [d[4]]


def test_cot_filter_and_typing(spark):
    raw = spark.createDataFrame([
        ("E-MINI S&P 500 - CME", "2025-01-07", " 12 ", "12.5", ""),
        ("MICRO E-MINI S&P 500 - CME", "2025-01-07", "1", "1", "1"),
        ("e-mini s&p 500", "2025-01-07", "1", "1", "1"),
        ("E-MINI S&P 500 - CME", "2025-02-04", "20", ".", "3")],
        "Market_and_Exchange_Names string, `Report_Date_as_YYYY-MM-DD` string, Open_Interest_All string, "
        "Pct_of_OI_Dealer_Long_All string, Change_in_Open_Interest_All string")
    typed = cot_typed(cot_filter(raw))
    rows = typed.orderBy("date").collect()
    assert len(rows) == 2
    assert (rows[0].Open_Interest_All, rows[0].Pct_of_OI_Dealer_Long_All, rows[0].Change_in_Open_Interest_All) == (12, 12.5, None)
    assert rows[1].Pct_of_OI_Dealer_Long_All is None and rows[0].sym == "E-MINI S&P 500 - CME"
    m = cot_monthly(typed, "Open_Interest_All").collect()
    assert [r.Open_Interest_All for r in m] == [12.0, 20.0]
