"""Scheduled market-moving events over any date range, as one plan.

The source evaluates every rule day by day with the tested day's year and
month; here all rules are one table (``Rule``), exploded over a month table,
and the session shifts of all of them are two equi-joins to the session calendar (columns
``d, is_session, ps, ns``). A rule date that falls outside the month it was
computed for is dropped, which is exactly what the day-by-day evaluation
does (``keep_month_edge=False``). Texts come from one table by key, with their fields filled in.

All inputs are bounded by the time span (one row per day or per month)
except the optional release schedules and auctions, which are joined on
(release, date) / date keys.
"""

from __future__ import annotations

import datetime as _dt
import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.casts import try_double
from ..functions.dates import last_weekday, month_label, nth_weekday, wall_clock
from ..functions.numbers import py_fixed
from ..functions.strings import strip_chars
from ..session import checkpointed
from ..operators.dedup import keep_one

#: fixed values: the columns of the event table
MARKET_EVENT_COLUMNS = ["time", "sym", "event_name", "release_for", "event_date_type", "summarize", "schedule_source"]
_REF_TYPES = {"ref_year": "int", "ref_month": "int", "ref_day2": "date", "ref_decision": "date",
              "ref_q": "int", "ref_qy": "int", "ref_estimate": "string", "ref_week_ending": "date",
              "auction_term": "string", "auction_kind": "string", "auction_reopen": "boolean",
              "auction_amount": "string", "auction_high_yield": "string", "auction_btc": "string"}

# Embedded central-bank calendars (FOMC day1/day2; ECB decision
# days; BOJ decision days in JST) and quarterly refunding statement dates.
FOMC_MEETINGS = [
    ("2024-01-30", "2024-01-31"), ("2024-03-19", "2024-03-20"),
    ("2024-04-30", "2024-05-01"), ("2024-06-11", "2024-06-12"),
    ("2024-07-30", "2024-07-31"), ("2024-09-17", "2024-09-18"),
    ("2024-11-06", "2024-11-07"), ("2024-12-17", "2024-12-18"),
    ("2025-01-28", "2025-01-29"), ("2025-03-18", "2025-03-19"),
    ("2025-05-06", "2025-05-07"), ("2025-06-17", "2025-06-18"),
    ("2025-07-29", "2025-07-30"), ("2025-09-16", "2025-09-17"),
    ("2025-10-28", "2025-10-29"), ("2025-12-09", "2025-12-10"),
    ("2026-01-27", "2026-01-28"), ("2026-03-17", "2026-03-18"),
    ("2026-04-28", "2026-04-29"), ("2026-06-16", "2026-06-17"),
    ("2026-07-28", "2026-07-29"), ("2026-09-15", "2026-09-16"),
    ("2026-10-27", "2026-10-28"), ("2026-12-08", "2026-12-09"),
]
ECB_DECISIONS = [
    "2025-01-30", "2025-03-06", "2025-04-17", "2025-06-05",
    "2025-07-24", "2025-09-11", "2025-10-30", "2025-12-18",
    "2026-02-05", "2026-03-19", "2026-04-30", "2026-06-11",
    "2026-07-23", "2026-09-10", "2026-10-29", "2026-12-17",
]
BOJ_DECISIONS_JST = [
    "2025-01-24", "2025-03-19", "2025-05-01", "2025-06-17",
    "2025-07-31", "2025-09-19", "2025-10-30", "2025-12-19",
    "2026-01-23", "2026-03-19", "2026-04-28", "2026-06-16",
    "2026-07-31", "2026-09-18", "2026-10-30", "2026-12-18",
]
QRA_DATES = [
    "2025-02-05", "2025-04-30", "2025-07-30", "2025-11-05",
    "2026-02-04", "2026-05-06", "2026-08-05",
]
AUCTION_TERMS = ["2-Year", "3-Year", "5-Year", "7-Year", "10-Year", "20-Year", "30-Year"]
# Release keys of the exact schedules and the phrase their
# published name must contain.
RELEASES = {
    "CPI": (10, "consumer price index"),
    "PPI": (46, "producer price index"),
    "NFP": (50, "employment situation"),
    "GDP": (53, "gross domestic product"),
    "PCE": (54, "personal income"),
    "JOLTS": (192, "job openings"),
    "RETAIL": (9, "advance monthly sales"),
}

# Event names and fallback texts ({...} are filled per event).
TEXT = {
    "FOMC": ("FOMC rate decision (statement 14:00 ET, press conference 14:30 ET)",
             "FOMC statement released at 14:00 ET."),
    "FOMC_SEP": " — includes Summary of Economic Projections (dot plot)",
    "FOMC_MINUTES": ("FOMC minutes of the {meeting} meeting",
                     "Minutes of the {meeting} FOMC meeting released at 14:00 ET."),
    "JACKSON_HOLE": ("Jackson Hole symposium — Fed Chair keynote (~10:00 ET; exact time set days ahead)",
                     "Fed Chair spoke at the Jackson Hole economic symposium."),
    "ECB": ("ECB rate decision (statement 08:15 ET / 14:15 CET, press conference 08:45 ET)",
            "ECB monetary policy decision released at 08:15 ET."),
    "BOJ": ("Bank of Japan rate decision (overnight ET, ~23:00-01:30; time approximate)",
            "Bank of Japan policy decision announced overnight ET (midday JST)."),
    "SPY_REBAL_ANNOUNCE": ("S&P 500 quarterly rebalance announcement (S&P DJI press release after close)",
                           "S&P DJI announced quarterly index changes after the close (see spglobal.com)."),
    "SPY_REBAL_EFFECTIVE": ("S&P 500 quarterly rebalance effective at the close",
                            "S&P 500 quarterly rebalance: tracking funds trade at today's close."),
    "TRIPLE_WITCHING": ("Triple witching: stock index futures, index options and stock options expire",
                        "Quarterly triple-witching expiration; elevated volume into the close."),
    "QQQ_RECON_ANNOUNCE": ("Nasdaq-100 annual reconstitution announcement (after close)",
                           "Nasdaq announced annual Nasdaq-100 reconstitution after the close (see nasdaq.com)."),
    "QQQ_RECON_EFFECTIVE": ("Nasdaq-100 reconstitution: changes effective next open; tracking funds trade at this close",
                            "Nasdaq-100 reconstitution trades at today's close, effective at the next open."),
    "MSCI_REVIEW_ANNOUNCE": ("MSCI index review announcement (~23:00 CET; date approximate)",
                             "MSCI announced index review results (see msci.com/index-review)."),
    "MSCI_REVIEW_EFFECTIVE": ("MSCI index review changes effective at the close",
                              "MSCI index review rebalance: tracking funds trade at today's close."),
    "RUSSELL_PRELIM": ("Russell reconstitution preliminary add/delete lists (after 18:00 ET)",
                       "FTSE Russell posted preliminary reconstitution lists (lseg.com/russell-reconstitution)."),
    "RUSSELL_RECON_JUNE": ("Russell indexes reconstitution effective at the close (June)",
                           "Russell reconstitution: rebalance trades in today's closing auction."),
    "RUSSELL_RECON_DEC": ("Russell indexes semi-annual reconstitution effective at the close (December)",
                          "Russell semi-annual reconstitution: rebalance trades in today's closing auction."),
    "OPEX": ("Monthly options expiration (third Friday)",
             "Monthly option expiration; elevated volume into the close."),
    "VIX_EXP": ("VIX futures/options expiration (settlement value from SPX opening prints)",
                "VIX expiration: settlement printed off the SPX open."),
    "QUARTER_END": ("Quarter-end close (rebalance flows, window dressing)",
                    "Quarter-end close; month/quarter-end rebalance flows."),
    "US_ELECTION": ("US {kind} election day (results overnight)",
                    "US {kind} elections held; results drove the overnight session."),
    "CPI": ("Consumer Price Index for {ref}, 08:30 ET",
            "Consumer Price Index for {ref} released at 08:30 ET (actuals unavailable)."),
    "PPI": ("Producer Price Index (final demand) for {ref}, 08:30 ET",
            "Producer Price Index (final demand) for {ref} released at 08:30 ET (actuals unavailable)."),
    "NFP": ("Employment Situation (nonfarm payrolls, unemployment rate) for {ref}, 08:30 ET",
            "Employment Situation (nonfarm payrolls, unemployment rate) for {ref} released at 08:30 ET (actuals unavailable)."),
    "GDP": ("GDP Q{q} {qy} ({estimate} estimate), 08:30 ET",
            "BEA GDP release (Q{q} {qy}, {estimate} estimate) at 08:30 ET."),
    "PCE": ("Personal income & outlays for {ref} (PCE price index), 08:30 ET",
            "PCE price index for {ref} released at 08:30 ET (actuals unavailable)."),
    "JOLTS": ("JOLTS job openings for {ref}, 10:00 ET",
              "JOLTS report for {ref} released at 10:00 ET."),
    "RETAIL_SALES": ("Advance retail sales for {ref}, 08:30 ET",
                     "Advance retail sales for {ref} released at 08:30 ET (actuals unavailable)."),
    "ADP": ("ADP private employment for {ref}, 08:15 ET",
            "ADP private payrolls report for {ref} released at 08:15 ET."),
    "UMICH_PRELIM": ("U. Michigan consumer sentiment for {cur} (preliminary, incl. inflation expectations), 10:00 ET",
                     "U. Michigan preliminary sentiment for {cur} released at 10:00 ET."),
    "UMICH_FINAL": ("U. Michigan consumer sentiment for {cur} (final), 10:00 ET",
                    "U. Michigan final sentiment for {cur} released at 10:00 ET."),
    "DURABLE_GOODS": ("Durable goods orders for {ref} (advance), 08:30 ET",
                      "Durable goods orders for {ref} released at 08:30 ET (actuals unavailable)."),
    "ECI": ("Employment Cost Index Q{q} {qy}, 08:30 ET",
            "Employment Cost Index for Q{q} {qy} released at 08:30 ET."),
    "CB_CONFIDENCE": ("Conference Board consumer confidence for {cur}, 10:00 ET",
                      "Conference Board consumer confidence for {cur} released at 10:00 ET."),
    "JOBLESS_CLAIMS": ("Initial jobless claims (week ending {week_ending}), 08:30 ET",
                       "Weekly initial jobless claims released at 08:30 ET."),
    "ISM_MFG": ("ISM Manufacturing PMI for {ref}, 10:00 ET",
                "ISM Manufacturing PMI for {ref} released at 10:00 ET."),
    "ISM_SVC": ("ISM Services PMI for {ref}, 10:00 ET",
                "ISM Services PMI for {ref} released at 10:00 ET."),
    "QRA": ("Treasury quarterly refunding statement (auction sizes), 08:30 ET",
            "Treasury quarterly refunding statement released (coupon auction sizes)."),
    "AUCTION": ("Treasury {term}-year {kind}{reopen} auction ({amount}), results ~13:02 ET",
                "Treasury {term}-year {kind} auction completed at 13:00 ET."),
}


def fmt(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` fields of a fixed text with string Columns."""
    parts = []
    for lit, field, _spec, _conv in string.Formatter().parse(template):
        if lit:
            parts.append(F.lit(lit))
        if field is not None:
            parts.append(cols[field].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


# ----------------------------------------------------------------- month table

def month_table(cal: DataFrame) -> DataFrame:
    """One row per month of the calendar: m (first day), y, mo."""
    return (cal.select(F.trunc("d", "MM").alias("m")).distinct()
               .select("m", F.year("m").alias("y"), F.month("m").alias("mo")))


# ----------------------------------------------------------------- rules

class Rule(NamedTuple):
    """One event a month: ``day`` (of the month table), moved to the session ``first``, by ``step`` days, and to the session ``second``.

    A session is ``ps`` (on or before), ``ns`` (on or after) or none. ``key`` names the texts, ``when`` the
    months that have the event, ``release`` the published schedule that takes the rule's place where it is available.
    """
    sym: str
    day: Column
    hour: int
    minute: int
    first: str | None = None
    step: int = 0
    second: str | None = None
    when: Column | None = None
    key: str | None = None
    source: str = "rule"
    release: str | None = None


def _in(*months: int) -> Column:
    return F.col("mo").isin(*months)


def central_bank_rules() -> list[Rule]:
    return [Rule("JACKSON_HOLE", nth_weekday(F.col("m"), 4, 4), 10, 0, when=_in(8))]


def index_rules() -> list[Rule]:
    m, quarter = F.col("m"), _in(3, 6, 9, 12)
    third, last = nth_weekday(m, 4, 3), F.last_day("m")
    close = {"hour": 16, "minute": 0, "first": "ps", "source": "official"}
    election = F.date_add(nth_weekday(m, 0, 1), 1)
    return [
        Rule("SPY_REBAL_ANNOUNCE", nth_weekday(m, 4, 1), 17, 15, when=quarter),
        Rule("SPY_REBAL_EFFECTIVE", third, when=quarter, **close),
        Rule("TRIPLE_WITCHING", third, when=quarter, **close),
        Rule("QQQ_RECON_ANNOUNCE", nth_weekday(m, 4, 2), 20, 0, when=_in(12)),
        Rule("QQQ_RECON_EFFECTIVE", third, when=_in(12), **close),
        Rule("MSCI_REVIEW_ANNOUNCE", nth_weekday(m, 1, 2), 17, 0, when=_in(2, 5, 8, 11)),
        Rule("MSCI_REVIEW_EFFECTIVE", last, when=_in(2, 5, 8, 11), **close),
        Rule("RUSSELL_RECON", nth_weekday(m, 4, 2), when=_in(12) & (F.col("y") >= 2026), key="RUSSELL_RECON_DEC", **close),
        Rule("OPEX", third, when=_in(1, 2, 4, 5, 7, 8, 10, 11), **close),
        Rule("QUARTER_END", last, when=quarter, **close),
        # the lists come 35 days before the reconstitution of June
        Rule("RUSSELL_PRELIM", nth_weekday(F.add_months(m, 1), 4, 4), 18, 0, first="ps", step=-35, when=_in(5)),
        Rule("RUSSELL_RECON", nth_weekday(m, 4, 4), when=_in(6), key="RUSSELL_RECON_JUNE", **close),
        # 30 days before the expiration of the next month
        Rule("VIX_EXP", nth_weekday(F.add_months(m, 1), 4, 3), 9, 30, first="ps", step=-30, second="ps", source="official"),
        Rule("US_ELECTION", election, 20, 0, when=_in(11) & (F.pmod("y", F.lit(2)) == 0), source="official"),
    ]


def macro_rules() -> list[Rule]:
    m = F.col("m")
    december = F.col("mo") == 12
    early = {"hour": 8, "minute": 30}

    def on(day: int) -> Column:
        return F.date_add(m, day - 1)

    return [
        Rule("CPI", on(10), first="ns", release="CPI", **early),
        Rule("PPI", on(10), first="ns", step=1, second="ns", release="PPI", **early),
        Rule("NFP", _nfp_raw(m), first="ps", release="NFP", **early),
        Rule("GDP", F.when(december, on(23)).otherwise(last_weekday(m, 3)), first="ps", release="GDP", **early),
        Rule("PCE", F.when(december, on(22)).otherwise(last_weekday(m, 4)), first="ps", release="PCE", **early),
        Rule("RETAIL_SALES", on(15), first="ns", release="RETAIL", **early),
        # its step starts from the month's NFP day, see ``_moved``
        Rule("ADP", _nfp_raw(m), 8, 15, first="ps", second="ps"),
        Rule("UMICH_PRELIM", nth_weekday(m, 4, 2), 10, 0, first="ps"),
        Rule("UMICH_FINAL", last_weekday(m, 4), 10, 0, first="ps"),
        Rule("DURABLE_GOODS", on(25), first="ns", **early),
        Rule("ECI", F.last_day("m"), first="ps", when=_in(1, 4, 7, 10), **early),
        Rule("CB_CONFIDENCE", last_weekday(m, 1), 10, 0, first="ps"),
    ]


#: what a published schedule gives events for: release, symbol, hour, minute
_SCHEDULED = [("CPI", "CPI", 8, 30), ("PPI", "PPI", 8, 30), ("NFP", "NFP", 8, 30), ("GDP", "GDP", 8, 30), ("PCE", "PCE", 8, 30),
              ("JOLTS", "JOLTS", 10, 0), ("RETAIL", "RETAIL_SALES", 8, 30)]

_ROW = "sym string, key string, release string, day date, first string, step int, second string, hour int, minute int, source string"


def _monthly(cal: DataFrame, rules: list[Rule]) -> DataFrame:
    """(m, anchor) and the fields of every rule in every month that has it."""
    def row(r: Rule) -> Column:
        values = (r.sym, r.key or r.sym, r.release, r.day, r.first, r.step, r.second, r.hour, r.minute, r.source)
        fields = [(v if isinstance(v, Column) else F.lit(v)).cast(f.split()[1]).alias(f.split()[0]) for v, f in zip(values, _ROW.split(", "))]
        return F.when(F.lit(True) if r.when is None else r.when, F.struct(*fields))

    rows = F.filter(F.array(*map(row, rules)), lambda x: x.isNotNull())
    return month_table(cal).select("m", F.lit(None).cast("date").alias("anchor"), F.explode(rows).alias("x")).select("m", "anchor", "x.*")


def _fixed(spark: SparkSession, *syms: str) -> DataFrame:
    """The rows of the embedded calendars, with the day that an event is about as ``anchor`` and no month."""
    meetings = [last for _, last in FOMC_MEETINGS]
    lists = {"FOMC": (meetings, 0, None, 14, 0, "official"), "FOMC_MINUTES": (meetings, 21, "ps", 14, 0, "rule"),
             "ECB": (ECB_DECISIONS, 0, None, 8, 15, "official"), "BOJ": (BOJ_DECISIONS_JST, -1, None, 23, 0, "official"),
             "QRA": (QRA_DATES, 0, None, 8, 30, "official")}
    rows = [(_dt.date.fromisoformat(day), s, s, None, _dt.date.fromisoformat(day), None, step, second, hour, minute, source)
            for s in syms for days, step, second, hour, minute, source in [lists[s]] for day in days]
    return spark.createDataFrame(rows, f"anchor date, {_ROW}").withColumn("m", F.lit(None).cast("date"))


def _to_session(rows: DataFrame, lk: DataFrame, kind: str) -> DataFrame:
    """``day`` moved to the session that the column ``kind`` asks for."""
    # the calendar is one row per day of the range: bounded, broadcast
    side = F.broadcast(lk.select(F.col("d").alias("day"), "ps", "ns"))
    moved = F.when(F.col(kind) == "ps", F.col("ps")).when(F.col(kind) == "ns", F.col("ns")).otherwise(F.col("day"))
    return rows.join(side, "day", "left").withColumn("day", moved).drop("ps", "ns")


def _moved(rows: DataFrame, lk: DataFrame, schedules: DataFrame | None, available: DataFrame | None) -> DataFrame:
    """The rows on their final days: one join with the calendar for the first sessions of all rules, one for the second."""
    rows = _to_session(rows, lk, "first")
    nfp = F.col("day")
    if schedules is not None:
        # the month's published NFP day where its schedule is available
        listed = (schedules.where((F.col("release") == "NFP") & (F.year("d") == F.col("year")))
                           .groupBy(F.trunc("d", "MM").alias("m")).agg(F.min("d").alias("listed")))
        known = available.where("release = 'NFP'").select(F.col("year").alias("nfp_year"), F.lit(True).alias("known"))
        rows = rows.join(listed, "m", "left").join(known, F.year("m") == F.col("nfp_year"), "left")
        nfp = F.when(F.col("known"), F.col("listed")).otherwise(F.col("day"))
    # the Wednesday strictly before
    wednesday = F.date_sub(nfp, F.pmod(F.weekday(nfp) - 2 + 6, F.lit(7)) + 1)
    rows = rows.withColumn("day", F.when(F.col("key") == "ADP", wednesday).otherwise(F.date_add("day", F.col("step"))))
    return _to_session(rows, lk, "second").drop("listed", "nfp_year", "known")


def _nfp_raw(m: Column) -> Column:
    """Rule date before the session shift: Saturday on/after the 12th of the
    previous month, + 20 days, + 7 when that lands on 1-5 January."""
    ref_day = F.date_add(F.add_months(m, -1), 11)
    sat = F.date_add(ref_day, F.pmod(F.lit(5) - F.weekday(ref_day), F.lit(7)))
    rel = F.date_add(sat, 20)
    return F.when((F.month(rel) == 1) & (F.dayofmonth(rel) <= 5), F.date_add(rel, 7)).otherwise(rel)


def _listed(cal: DataFrame, schedules: DataFrame, available: DataFrame) -> DataFrame:
    """The published days of the available schedules, those of the year that the schedule is for."""
    spark = cal.sparkSession
    days = schedules.where(F.year("d") == F.col("year")).join(available, ["release", "year"], "left_semi").select("release", F.col("d").alias("day")).distinct()
    events = spark.createDataFrame(_SCHEDULED, "release string, sym string, hour int, minute int")
    return (days.join(F.broadcast(events), "release")
                .select("day", F.trunc("day", "MM").alias("m"), "sym", F.col("sym").alias("key"), "hour", "minute", F.lit("fred").alias("source")))


def _session_days(cal: DataFrame) -> DataFrame:
    """Events of a day of the calendar itself: the first and third session of a month, and the Thursdays of the jobless claims.

    Claims come on Thursday sessions but 11 November, else on the Wednesday before.
    """
    def veterans(c: Column) -> Column:
        return (F.month(c) == 11) & (F.dayofmonth(c) == 11)

    tomorrow = F.date_add("d", 1)
    # one row a day of the range
    days = cal.withColumn("open_tomorrow", F.coalesce(F.lead("is_session").over(Window.orderBy("d")), F.lit(False)))
    claims = (((F.weekday("d") == 3) & F.col("is_session") & ~veterans(F.col("d")))
              | ((F.weekday("d") == 2) & (~F.col("open_tomorrow") | veterans(tomorrow))))
    kinds = [("ISM_MFG", 10, 0, F.col("session_no") == 1), ("ISM_SVC", 10, 0, F.col("session_no") == 3), ("JOBLESS_CLAIMS", 8, 30, claims)]
    rows = F.array(*[F.when(c, F.struct(F.lit(s).alias("sym"), F.lit(h).alias("hour"), F.lit(n).alias("minute"))) for s, h, n, c in kinds])
    return (days.select(F.col("d").alias("day"), F.trunc("d", "MM").alias("m"), F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x"))
                .select("day", "m", "x.*", F.col("x.sym").alias("key"), F.lit("rule").alias("source")))


#: events about the month before, about their own month, and about a quarter
_PREVIOUS = ["CPI", "PPI", "NFP", "PCE", "RETAIL_SALES", "ADP", "DURABLE_GOODS", "ISM_MFG", "ISM_SVC", "JOLTS"]
_CURRENT = ["UMICH_PRELIM", "UMICH_FINAL", "CB_CONFIDENCE"]
_OBSERVED = ["CPI", "PPI", "NFP", "PCE", "RETAIL_SALES", "DURABLE_GOODS"]


def _named(rows: DataFrame) -> DataFrame:
    """Events of rows (day, m, sym, key, hour, minute, source, anchor): time, texts and what they refer to."""
    spark = rows.sparkSession
    texts = spark.createDataFrame([(k, *v) for k, v in TEXT.items() if k != "FOMC_SEP"], "key string, name string, fallback string")
    key, m, day = F.col("key"), F.coalesce("m", F.trunc("day", "MM")), F.col("day")
    mo, y = F.month(m), F.year(m)
    before = F.add_months(m, F.when(key == "JOLTS", -2).otherwise(-1))
    # releases about a quarter come in the next one
    quarter = F.floor((mo - 1) / 3).cast("int")
    q, qy = F.when(quarter == 0, 4).otherwise(quarter), F.when(mo > 3, y).otherwise(y - 1)
    estimate = F.element_at(F.array(*map(F.lit, ("advance", "second", "third"))), (F.pmod(mo - 1, F.lit(3)) + 1).cast("int"))
    week = F.date_sub(day, F.pmod(F.weekday(day) - 5, F.lit(7)))
    fields = {"ref": month_label(before), "cur": month_label(m), "q": q.cast("string"), "qy": qy.cast("string"), "estimate": estimate,
              "week_ending": F.date_format(week, "yyyy-MM-dd"), "meeting": month_label(F.col("anchor")),
              "kind": F.when(F.pmod(y, F.lit(4)) == 0, "presidential").otherwise("midterm")}

    def filled(text: Column) -> Column:
        for name, value in fields.items():
            text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
        return text

    release_for = (F.when(key.isin(*_PREVIOUS), fields["ref"]).when(key.isin(*_CURRENT), fields["cur"]).when(key == "JOBLESS_CLAIMS", fields["week_ending"])
                    .when(key.isin("GDP", "ECI"), F.concat(F.lit("Q"), fields["q"], F.lit(" "), fields["qy"])))
    dots = F.when((key == "FOMC") & F.month(day).isin(3, 6, 9, 12), F.lit(TEXT["FOMC_SEP"])).otherwise(F.lit(""))
    gdp = key == "GDP"
    refs = {"ref_year": F.when(key.isin(*_OBSERVED), F.year(before)), "ref_month": F.when(key.isin(*_OBSERVED), F.month(before)),
            "ref_day2": F.when(key == "FOMC", F.col("anchor")), "ref_decision": F.when(key == "ECB", F.col("anchor")),
            "ref_q": F.when(gdp, q), "ref_qy": F.when(gdp, qy), "ref_estimate": F.when(gdp, estimate), "ref_week_ending": F.when(key == "JOBLESS_CLAIMS", week)}
    # a row for each text
    return _event(rows.join(F.broadcast(texts), "key"), F.col("sym"), day, F.col("hour"), F.col("minute"), F.concat(filled(F.col("name")), dots),
                  filled(F.col("fallback")), F.col("source"), release_for, **refs)


def _event(df: DataFrame, sym: Column, d: Column, hour: Column, minute: Column, name: Column, fallback: Column, source: Column,
           release_for: Column, **refs: Column) -> DataFrame:
    cols = [d.alias("d"), wall_clock(d, hour, minute).alias("time"), sym.alias("sym"), name.alias("event_name"),
            release_for.cast("string").alias("release_for"), source.alias("schedule_source"), fallback.alias("summary_fallback")]
    return df.select(*cols, *[refs.get(k, F.lit(None)).cast(t).alias(k) for k, t in _REF_TYPES.items()])


def rule_events(cal: DataFrame, lk: DataFrame, rules: list[Rule], fixed: Sequence[str] = (), session_days: bool = False,
                schedules: DataFrame | None = None, coverage: DataFrame | None = None, keep_month_edge: bool = False) -> DataFrame:
    """The events of month rules, embedded calendars, session days and published schedules, as one plan.

    A rule day that falls outside its month is dropped, unless ``keep_month_edge``. ``schedules`` has the published
    days (release, year, d), ``coverage`` the available schedules (release, year). Where the schedule of a rule's release
    is available for the year of its day, the rule gives nothing, and the published days count, however few they are.
    """
    spark = cal.sparkSession
    if schedules is None or coverage is None:
        schedules = available = None
    else:
        available = coverage.select("release", "year").distinct()
    rows = _monthly(cal, rules) if rules else None
    if fixed:
        days = _fixed(spark, *fixed)
        rows = days if rows is None else rows.unionByName(days)
    rows = _moved(rows, lk, schedules, available)
    if not keep_month_edge:
        rows = rows.where(F.col("m").isNull() | (F.trunc("day", "MM") == F.col("m")))
    if available is not None:
        covered = available.withColumnsRenamed({"release": "covered", "year": "covered_year"})
        rows = rows.join(covered, (F.col("release") == F.col("covered")) & (F.year("day") == F.col("covered_year")), "left_anti")
    out = rows.drop("release", "first", "step", "second")
    if available is not None:
        out = out.unionByName(_listed(cal, schedules, available), allowMissingColumns=True)
    if session_days:
        out = out.unionByName(_session_days(cal), allowMissingColumns=True)
    # days of the calendar only
    return _named(out.join(F.broadcast(cal.select(F.col("d").alias("day"))), "day", "left_semi"))


# ----------------------------------------------------------------- families

CENTRAL_BANKS = ("FOMC", "FOMC_MINUTES", "ECB", "BOJ")


def central_bank_events(spark: SparkSession, cal: DataFrame, lk: DataFrame) -> DataFrame:
    return rule_events(cal, lk, central_bank_rules(), CENTRAL_BANKS)


def uncovered_years(cal: DataFrame) -> DataFrame:
    """(calendar, year): years of ``cal`` for which an embedded calendar has no day.

    The events of that calendar are silent in such a year.
    """
    held = {"FOMC": [last for _, last in FOMC_MEETINGS], "ECB": ECB_DECISIONS, "BOJ": BOJ_DECISIONS_JST,
            "QRA": QRA_DATES}
    covered = sorted({(name, int(day[:4])) for name, days in held.items() for day in days})
    years = cal.select(F.year("d").alias("year")).distinct()
    wanted = years.select(F.explode(F.array(*map(F.lit, held))).alias("calendar"), "year")
    return wanted.join(cal.sparkSession.createDataFrame(covered, "calendar string, year int"),
                       ["calendar", "year"], "left_anti")


def index_events(cal: DataFrame, lk: DataFrame, keep_month_edge: bool = False) -> DataFrame:
    return rule_events(cal, lk, index_rules(), keep_month_edge=keep_month_edge)


def macro_events(cal: DataFrame, lk: DataFrame, schedules: DataFrame | None = None,
                 coverage: DataFrame | None = None, keep_month_edge: bool = False) -> DataFrame:
    """CPI, PPI, NFP, GDP, PCE, JOLTS, retail, ADP, UMich, durables, ECI, CB, claims, ISM."""
    return rule_events(cal, lk, macro_rules(), (), True, schedules, coverage, keep_month_edge)


def coupon_auctions(auctions: DataFrame, prefer: str = "first") -> DataFrame:
    """One row per (auction day ``d``, cusip) of the coupon auctions of the feeds.

    ``auctions``: the union of the feeds with ``feed_rank`` (0 = announced), and where the
    reader gives them ``file`` and ``place``: the order of arrival inside a feed. The
    first auction to arrive wins; with ``prefer="results"`` the first of the
    result feeds, and the announced one only where there is none. A day that does not parse
    fails the job: ``check_auctions`` has taken such rows out and lists them.
    """
    if prefer not in ("first", "results"):
        raise ValueError(f"prefer is first or results, not {prefer}")
    text = F.coalesce(F.substring("auctionDate", 1, 10), F.lit(""))
    day = F.try_to_date(text, "yyyy-MM-dd")
    bad = F.raise_error(F.concat(F.lit("auction with a bad date: "), text))
    a = (auctions.where(F.col("type").isin("Note", "Bond") & F.col("originalSecurityTerm").isin(*AUCTION_TERMS))
                 .withColumn("d", F.when(day.isNull(), bad.cast("date")).otherwise(day))
                 .select("d", "cusip", *[c for c in auctions.columns if c in _AUCTION_COLUMNS]))
    arrival = [F.col(c) for c in ("feed_rank", "file", "place") if c in a.columns]
    if prefer == "results":
        arrival.insert(0, F.col("feed_rank") == 0)
    return keep_one(a, ["d", "cusip"], arrival)


#: what the events need of an auction, and its order of arrival
_AUCTION_COLUMNS = ("type", "originalSecurityTerm", "reopening", "offeringAmount", "highYield", "bidToCoverRatio", "feed_rank", "file", "place")


def treasury_events(spark: SparkSession, cal: DataFrame, auctions: DataFrame | None = None, prefer: str = "first") -> DataFrame:
    """QRA statements and one event per de-duplicated coupon auction (see ``coupon_auctions``)."""
    from .trading_calendar import shift_lookup
    out = rule_events(cal, shift_lookup(cal), [], ("QRA",))
    return out if auctions is None else out.unionByName(auction_events(cal, auctions, prefer))


def auction_events(cal: DataFrame, auctions: DataFrame, prefer: str = "first") -> DataFrame:
    """The event of each coupon auction on a day of the calendar."""
    a = coupon_auctions(auctions, prefer).join(F.broadcast(cal.select("d")), "d", "left_semi")
    term = F.split_part(F.col("originalSecurityTerm"), F.lit("-"), F.lit(1))
    kind = F.when(F.col("type") == "Note", F.lit("note")).otherwise(F.lit("bond"))
    reopen = F.coalesce(F.col("reopening") == "Yes", F.lit(False))
    size = F.try_divide(try_double(strip_chars(F.col("offeringAmount"))), F.lit(1e9))
    amount = F.coalesce(F.concat(F.lit("$"), py_fixed(size, 0), F.lit("B")), F.lit("size TBA"))
    fields = {"term": term, "kind": kind, "reopen": F.when(reopen, F.lit(" reopening")).otherwise(F.lit("")), "amount": amount}
    name, fallback = (fmt(t, **fields) for t in TEXT["AUCTION"])
    return _event(a, F.concat(F.lit("AUCTION_"), term, F.lit("Y")), F.col("d"), F.lit(13), F.lit(0), name, fallback, F.lit("official"), F.lit(None),
                  auction_term=term, auction_kind=kind, auction_reopen=reopen, auction_amount=F.col("offeringAmount"),
                  auction_high_yield=F.col("highYield"), auction_btc=F.col("bidToCoverRatio"))


def all_events(spark: SparkSession, cal: DataFrame, schedules: DataFrame | None = None,
               coverage: DataFrame | None = None, auctions: DataFrame | None = None,
               keep_month_edge: bool = False, start: Column | None = None,
               end: Column | None = None, prefer: str = "first") -> DataFrame:
    """Every event family over the calendar's days.

    ``cal`` comes from ``session_calendar(..., trim=False)`` (padded, so shifts
    near the edges resolve); ``start``/``end`` bound the emitted days.
    """
    from .trading_calendar import shift_lookup
    # the rules read the calendar more than once: it is computed once
    cal = checkpointed(cal)
    rules = [*central_bank_rules(), *index_rules(), *macro_rules()]
    out = rule_events(cal, shift_lookup(cal), rules, (*CENTRAL_BANKS, "QRA"), True, schedules, coverage, keep_month_edge)
    if auctions is not None:
        out = out.unionByName(auction_events(cal, auctions, prefer))
    if start is not None and end is not None:
        out = out.where(F.col("d").between(start, end))
    return out


def release_coverage(names: DataFrame, dates: DataFrame) -> DataFrame:
    """(release, year) whose schedule is usable: the fetched release name
    contains the expected phrase (case-insensitive) and the dates parsed.

    ``names``: (release_id, name); ``dates``: (release, year, d).
    """
    spark = names.sparkSession
    exp = spark.createDataFrame([(k, v[0], v[1]) for k, v in RELEASES.items()],
                                "release string, release_id long, phrase string")
    ok = (names.join(F.broadcast(exp), "release_id")
               .where(F.lower(F.col("name")).contains(F.col("phrase"))).select("release"))
    return dates.select("release", "year").distinct().join(ok, "release", "left_semi")


def market_events(spark: SparkSession, cal: DataFrame, now: _dt.datetime | Column,
                  schedules: DataFrame | None = None, coverage: DataFrame | None = None,
                  auctions: DataFrame | None = None, observations: DataFrame | None = None,
                  keep_month_edge: bool = False, start: Column | None = None,
                  end: Column | None = None) -> DataFrame:
    """The seven-column event table for the calendar's range, by time and symbol.

    ``event_date_type`` is ``actual`` when the event time is not after ``now``;
    ``summarize`` is filled for actual events only (data-driven text, else the
    fallback text, else the name).
    """
    from .summaries import summarize
    ev = all_events(spark, cal, schedules, coverage, auctions, keep_month_edge, start, end)
    now_c = F.lit(now) if isinstance(now, _dt.datetime) else now
    happened = F.col("time") <= now_c
    ev = ev.withColumn("event_date_type", F.when(happened, F.lit("actual")).otherwise(F.lit("expected")))
    ev = summarize(ev, observations)
    ev = ev.withColumn("summarize", F.when(F.col("event_date_type") == "actual", F.col("summarize")))
    # the sort samples its input first: written once, the plan runs once
    return checkpointed(ev.select(*MARKET_EVENT_COLUMNS)).orderBy("time", "sym")
