"""Calendar arithmetic, session calendar and event rules over the orders' date span.

The calendar and the rule events are bounded by the span of order dates;
each query joins back to the orders (counts per day/month) so its work
grows with the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.dates import last_weekday, month_label, nth_weekday, wall_clock_utc
from ..plans.events import (BOJ_DECISIONS_JST, ECB_DECISIONS, FOMC_MEETINGS, QRA_DATES, RELEASES, TEXT, central_bank_events,
                            index_events, macro_events, market_events, release_coverage, treasury_events, uncovered_years)
from ..plans.trading_calendar import session_calendar, shift_lookup, within_calendar
from ..session import checkpointed
from ..sources.readers import read_fred_release_dates, read_fred_release_names
from .base import Tables
from .io_q import _stage

NOW = _dt.datetime(1998, 6, 30, 12, 0, 0)


def _order_days(t: Tables):
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n_orders"))


def _span(t: Tables):
    return _span_of(t.orders.select(F.col("o_orderdate").alias("day")))


def _span_of(days):
    """First and last day, from one scan; two values reach the driver."""
    day = F.col("day").cast("date")
    return [F.lit(x).cast("date") for x in days.agg(F.min(day), F.max(day)).first()]


def q_nth_weekday(spark, sf):
    t = Tables(spark, sf)
    m = (t.orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
          .agg(F.count(F.lit(1)).alias("n_orders")))
    return m.select("month", "n_orders", nth_weekday("month", 4, 3).alias("third_friday"),
                    nth_weekday("month", 1, 2).alias("second_tuesday"),
                    nth_weekday("month", 0, 1).alias("first_monday"))


def _nth_sql(f: str, w: int, n: int) -> str:
    return f"CAST({f} + INTERVAL (((({w} - (isodow({f}) - 1)) % 7 + 7) % 7) + {7 * (n - 1)}) DAY AS DATE)"


def _last_sql(f: str, w: int) -> str:
    return f"CAST(last_day({f}) - INTERVAL ((((isodow(last_day({f})) - 1 - {w}) % 7 + 7) % 7)) DAY AS DATE)"


SQL_NTH_WEEKDAY = f"""
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT month, n_orders, {_nth_sql('month', 4, 3)} AS third_friday, {_nth_sql('month', 1, 2)} AS second_tuesday,
       {_nth_sql('month', 0, 1)} AS first_monday
FROM m
"""


def q_last_weekday(spark, sf):
    t = Tables(spark, sf)
    m = t.orders.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).distinct()
    return m.select("month", last_weekday("month", 4).alias("last_friday"),
                    last_weekday("month", 3).alias("last_thursday"),
                    last_weekday("month", 1).alias("last_tuesday"))


SQL_LAST_WEEKDAY = f"""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
SELECT month, {_last_sql('month', 4)} AS last_friday, {_last_sql('month', 3)} AS last_thursday,
       {_last_sql('month', 1)} AS last_tuesday
FROM m
"""


def _cal(spark, t: Tables, trim: bool = True, days=None):
    """The calendar over the span of the orders, or of the column ``day`` of ``days``."""
    lo, hi = _span(t) if days is None else _span_of(days)
    # written once: every rule reads it
    return checkpointed(session_calendar(spark, lo, hi, trim=trim)), lo, hi


def q_session_fill(spark, sf):
    t = Tables(spark, sf)
    cal, _, _ = _cal(spark, t)
    return (within_calendar(_order_days(t), "d", cal).join(cal, "d")
            .select("d", "n_orders", "is_session", "prev_session", "next_session", "session_no",
                    "first_session", "last_session"))


# The same NYSE rules, written independently in SQL (Easter computus,
# weekend observance, MLK from 1998, Juneteenth from 2022, closures list).
_SQL_CAL = f"""
span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
yrs AS (SELECT unnest(generate_series(year(lo) - 1, year(hi) + 1)) AS y FROM span),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
e2 AS (SELECT *, b // 4 AS dd, b % 4 AS e, (b + 8) // 25 AS f FROM e1),
e3 AS (SELECT *, (b - f + 1) // 3 AS g, c // 4 AS i, c % 4 AS k FROM e2),
e4 AS (SELECT *, (19 * a + b - dd - g + 15) % 30 AS h FROM e3),
e5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM e4),
e6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS mm FROM e5),
ys AS (SELECT y, make_date(y, CAST((h + l - 7 * mm + 114) // 31 AS INT), CAST((h + l - 7 * mm + 114) % 31 + 1 AS INT)) AS easter,
              make_date(y, 1, 1) AS jan1, make_date(y, 2, 1) AS feb1, make_date(y, 5, 1) AS may1,
              make_date(y, 6, 19) AS jun19, make_date(y, 7, 4) AS jul4, make_date(y, 9, 1) AS sep1,
              make_date(y, 11, 1) AS nov1, make_date(y, 12, 25) AS xmas FROM e6),
hol AS (
  SELECT CASE WHEN isodow(jan1) = 7 THEN jan1 + 1 WHEN isodow(jan1) = 6 THEN NULL ELSE jan1 END AS d FROM ys
  UNION ALL SELECT CASE WHEN y >= 1998 THEN {_nth_sql('jan1', 0, 3)} END FROM ys
  UNION ALL SELECT {_nth_sql('feb1', 0, 3)} FROM ys
  UNION ALL SELECT CAST(easter - 2 AS DATE) FROM ys
  UNION ALL SELECT {_last_sql('may1', 0)} FROM ys
  UNION ALL SELECT CASE WHEN y >= 2022 THEN CASE isodow(jun19) WHEN 6 THEN jun19 - 1 WHEN 7 THEN jun19 + 1 ELSE jun19 END END FROM ys
  UNION ALL SELECT CASE isodow(jul4) WHEN 6 THEN jul4 - 1 WHEN 7 THEN jul4 + 1 ELSE jul4 END FROM ys
  UNION ALL SELECT {_nth_sql('sep1', 0, 1)} FROM ys
  UNION ALL SELECT {_nth_sql('nov1', 3, 4)} FROM ys
  UNION ALL SELECT CASE isodow(xmas) WHEN 6 THEN xmas - 1 WHEN 7 THEN xmas + 1 ELSE xmas END FROM ys
  UNION ALL SELECT CAST(x AS DATE) FROM (VALUES ('2001-09-11'), ('2001-09-12'), ('2001-09-13'), ('2001-09-14'),
        ('2004-06-11'), ('2007-01-02'), ('2012-10-29'), ('2012-10-30'), ('2018-12-05'), ('2025-01-09')) v(x)),
days AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS DATE) - INTERVAL 45 DAY,
                                           CAST(last_day(hi) AS TIMESTAMP) + INTERVAL 45 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
cal0 AS (SELECT d, isodow(d) <= 5 AND d NOT IN (SELECT d FROM hol WHERE d IS NOT NULL) AS is_session,
                CAST(date_trunc('month', d) AS DATE) AS month FROM days),
cal AS (SELECT d, is_session, month,
          last_value(CASE WHEN is_session THEN d END IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev_session,
          first_value(CASE WHEN is_session THEN d END IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_session,
          CASE WHEN is_session THEN row_number() OVER (PARTITION BY month, is_session ORDER BY d) END AS session_no,
          min(CASE WHEN is_session THEN d END) OVER (PARTITION BY month) AS first_session,
          max(CASE WHEN is_session THEN d END) OVER (PARTITION BY month) AS last_session
        FROM cal0)
"""

SQL_SESSION_FILL = f"""
WITH {_SQL_CAL},
od AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT od.d, n_orders, is_session, prev_session, next_session, session_no, first_session, last_session
FROM od JOIN cal USING (d)
"""


def q_wall_clock(spark, sf):
    od = _order_days(Tables(spark, sf))
    return od.select("d", wall_clock_utc(F.col("d"), 8, 30).alias("release_utc"),
                     wall_clock_utc(F.col("d"), 14, 0).alias("decision_utc"))


SQL_WALL_CLOCK = """
WITH od AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT d, ((CAST(d AS TIMESTAMP) + INTERVAL 510 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS release_utc,
       ((CAST(d AS TIMESTAMP) + INTERVAL 14 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS decision_utc
FROM od
"""


def q_period_labels(spark, sf):
    t = Tables(spark, sf)
    m = t.orders.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).distinct()
    mo = F.month("month")
    q = F.when(F.floor((mo - 1) / 3) == 0, F.lit(4)).otherwise(F.floor((mo - 1) / 3)).cast("int")
    qy = F.when(mo > 3, F.year("month")).otherwise(F.year("month") - 1)
    est = F.element_at(F.array(F.lit("advance"), F.lit("second"), F.lit("third")),
                       (F.pmod(mo - 1, F.lit(3)) + 1).cast("int"))
    return m.select("month", month_label(F.add_months("month", -1)).alias("prev_month_name"),
                    F.concat(F.lit("Q"), q.cast("string"), F.lit(" "), qy.cast("string")).alias("quarter_label"),
                    est.alias("estimate"))


SQL_PERIOD_LABELS = """
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
SELECT month, strftime(month - INTERVAL 1 MONTH, '%B %Y') AS prev_month_name,
       'Q' || CAST(CASE WHEN (month(month) - 1) // 3 = 0 THEN 4 ELSE (month(month) - 1) // 3 END AS VARCHAR) || ' ' ||
       CAST(CASE WHEN month(month) > 3 THEN year(month) ELSE year(month) - 1 END AS VARCHAR) AS quarter_label,
       CASE (month(month) - 1) % 3 WHEN 0 THEN 'advance' WHEN 1 THEN 'second' ELSE 'third' END AS estimate
FROM m
"""


def q_event_status(spark, sf):
    od = _order_days(Tables(spark, sf))
    t = wall_clock_utc(F.col("d"), 14, 0)
    return od.select("d", "n_orders", F.when(t <= F.lit(NOW), F.lit("actual")).otherwise(F.lit("expected"))
                     .alias("event_date_type"))


SQL_EVENT_STATUS = f"""
WITH od AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT d, n_orders, CASE WHEN ((CAST(d AS TIMESTAMP) + INTERVAL 14 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC'
                         <= TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' THEN 'actual' ELSE 'expected' END AS event_date_type
FROM od
"""


def _with_counts(t: Tables, ev, *more):
    return (ev.join(_order_days(t), "d", "left")
              .select("d", "sym", "schedule_source", *more, F.coalesce("n_orders", F.lit(0)).alias("n_orders")))


def q_calendar_rules(spark, sf):
    t = Tables(spark, sf)
    cal, lo, hi = _cal(spark, t, trim=False)
    ev = index_events(cal, shift_lookup(cal)).where(F.col("d").between(lo, hi))
    return _with_counts(t, ev, F.col("time").cast("timestamp_ntz").alias("time"), "event_name", "summary_fallback")


def _rule_sql(sym: str, months: tuple[int, ...] | None, date_sql: str, shift: str | None, source: str,
              extra: str = "") -> str:
    where = f"WHERE month(m) IN ({', '.join(map(str, months))})" if months else "WHERE true"
    base = f"SELECT m, {date_sql} AS raw FROM mt {where} {extra}"
    d = f"c.{shift}" if shift else "b.raw"
    join = "JOIN cal c ON c.d = b.raw" if shift else ""
    return (f"SELECT '{sym}' AS sym, {d} AS d, '{source}' AS schedule_source FROM ({base}) b {join} "
            f"WHERE date_trunc('month', {d}) = b.m")


_Q = (3, 6, 9, 12)
_SQL_RULES = " UNION ALL ".join([
    _rule_sql("SPY_REBAL_ANNOUNCE", _Q, _nth_sql("m", 4, 1), None, "rule"),
    _rule_sql("SPY_REBAL_EFFECTIVE", _Q, _nth_sql("m", 4, 3), "prev_session", "official"),
    _rule_sql("TRIPLE_WITCHING", _Q, _nth_sql("m", 4, 3), "prev_session", "official"),
    _rule_sql("QQQ_RECON_ANNOUNCE", (12,), _nth_sql("m", 4, 2), None, "rule"),
    _rule_sql("QQQ_RECON_EFFECTIVE", (12,), _nth_sql("m", 4, 3), "prev_session", "official"),
    _rule_sql("MSCI_REVIEW_ANNOUNCE", (2, 5, 8, 11), _nth_sql("m", 1, 2), None, "rule"),
    _rule_sql("MSCI_REVIEW_EFFECTIVE", (2, 5, 8, 11), "CAST(last_day(m) AS DATE)", "prev_session", "official"),
    _rule_sql("RUSSELL_RECON", (12,), _nth_sql("m", 4, 2), "prev_session", "official", "AND year(m) >= 2026"),
    _rule_sql("OPEX", (1, 2, 4, 5, 7, 8, 10, 11), _nth_sql("m", 4, 3), "prev_session", "official"),
    _rule_sql("QUARTER_END", _Q, "CAST(last_day(m) AS DATE)", "prev_session", "official"),
    _rule_sql("US_ELECTION", (11,), f"CAST({_nth_sql('m', 0, 1)} + 1 AS DATE)", None, "official",
              "AND year(m) % 2 = 0"),
])

#: fixed values: New York minutes of the day of each rule event
_RULE_MINUTES = {"SPY_REBAL_ANNOUNCE": 1035, "SPY_REBAL_EFFECTIVE": 960, "TRIPLE_WITCHING": 960, "QQQ_RECON_ANNOUNCE": 1200,
                 "QQQ_RECON_EFFECTIVE": 960, "MSCI_REVIEW_ANNOUNCE": 1020, "MSCI_REVIEW_EFFECTIVE": 960, "RUSSELL_PRELIM": 1080,
                 "RUSSELL_RECON_JUNE": 960, "RUSSELL_RECON_DEC": 960, "OPEX": 960, "VIX_EXP": 570, "QUARTER_END": 960, "US_ELECTION": 1200}


def _text_sql(key: str) -> tuple[str, str]:
    return tuple("'" + x.replace("'", "''") + "'" for x in TEXT[key])


_SQL_RULE_TEXTS = "(VALUES " + ", ".join(f"('{k}', {m}, {', '.join(_text_sql(k))})" for k, m in _RULE_MINUTES.items()) + ")"

SQL_CALENDAR_RULES = f"""
WITH {_SQL_CAL},
mt AS (SELECT DISTINCT month AS m FROM cal),
june AS (SELECT mt.m, c.prev_session AS recon FROM mt JOIN cal c
           ON c.d = {_nth_sql("make_date(year(mt.m), 6, 1)", 4, 4)} WHERE month(mt.m) IN (5, 6)),
vix AS (SELECT mt.m, c2.prev_session AS d FROM mt
          JOIN cal c1 ON c1.d = {_nth_sql("CAST(mt.m + INTERVAL 1 MONTH AS DATE)", 4, 3)}
          JOIN cal c2 ON c2.d = CAST(c1.prev_session - 30 AS DATE)),
ev AS ({_SQL_RULES}
  UNION ALL SELECT 'RUSSELL_PRELIM', CAST(recon - 35 AS DATE), 'rule' FROM june WHERE date_trunc('month', recon - 35) = m
  UNION ALL SELECT 'RUSSELL_RECON', recon, 'official' FROM june WHERE date_trunc('month', recon) = m
  UNION ALL SELECT 'VIX_EXP', d, 'official' FROM vix WHERE date_trunc('month', d) = m),
od AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
tx AS (SELECT * FROM {_SQL_RULE_TEXTS} v(key, mi, event_name, fallback)),
kind AS (SELECT ev.*, CASE WHEN sym = 'RUSSELL_RECON' THEN CASE WHEN month(d) = 6 THEN 'RUSSELL_RECON_JUNE' ELSE 'RUSSELL_RECON_DEC' END
                           ELSE sym END AS key, CASE WHEN year(d) % 4 = 0 THEN 'presidential' ELSE 'midterm' END AS k FROM ev)
SELECT kind.d, kind.sym, kind.schedule_source, coalesce(od.n, 0) AS n_orders,
       ((CAST(kind.d AS TIMESTAMP) + to_minutes(tx.mi)) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS time,
       replace(tx.event_name, '{{kind}}', k) AS event_name, replace(tx.fallback, '{{kind}}', k) AS summary_fallback
FROM kind LEFT JOIN tx USING (key) LEFT JOIN od USING (d), span WHERE kind.d BETWEEN span.lo AND span.hi
"""


def q_macro_rules(spark, sf):
    """Macro releases by rule (no exact schedules available) over the orders' span."""
    t = Tables(spark, sf)
    cal, lo, hi = _cal(spark, t, trim=False)
    ev = macro_events(cal, shift_lookup(cal)).where(F.col("d").between(lo, hi))
    return _macro_columns(t, ev)


def _macro_columns(t: Tables, ev):
    return _with_counts(t, ev, F.col("time").cast("timestamp_ntz").alias("time"), "event_name", "summary_fallback", "release_for")


def _auction_feeds(t: Tables):
    li = t.lineitem
    rec = li.select(
        F.when(F.col("l_returnflag") == "N", F.lit("Note")).otherwise(F.lit("Bond")).alias("type"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("-Year")).alias("originalSecurityTerm"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'00:00:00").alias("auctionDate"),
        F.col("l_partkey").cast("string").alias("cusip"),
        F.when(F.col("l_discount") > 0.05, F.lit("Yes")).otherwise(F.lit("No")).alias("reopening"),
        F.when(F.col("l_returnflag") != "R", (F.col("l_partkey") * 1000000000).cast("string")).alias("offeringAmount"),
        F.when(F.col("l_linestatus") == "F", F.format_number(F.col("l_tax") * 100, 3)).alias("highYield"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("string")).alias("bidToCoverRatio"),
        F.when(F.col("l_linestatus") == "O", F.lit(0)).otherwise(F.lit(1)).alias("feed_rank"))
    return rec


def q_auction_rows(spark, sf):
    t = Tables(spark, sf)
    cal, lo, hi = _cal(spark, t, days=t.lineitem.select(F.col("l_shipdate").alias("day")))
    from ..plans.summaries import _auction_text
    ev = treasury_events(spark, cal, _auction_feeds(t)).where(F.col("sym").startswith("AUCTION_"))
    return ev.select("d", "sym", "event_name", _auction_text().alias("results_text"))


SQL_AUCTION_ROWS = """
WITH span AS (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem),
f AS (SELECT CASE WHEN l_returnflag = 'N' THEN 'Note' ELSE 'Bond' END AS type,
             CAST(l_linenumber AS VARCHAR) || '-Year' AS term_txt, CAST(l_shipdate AS DATE) AS d,
             CAST(l_partkey AS VARCHAR) AS cusip,
             CASE WHEN l_discount > 0.05 THEN 'Yes' ELSE 'No' END AS reopening,
             CASE WHEN l_returnflag <> 'R' THEN l_partkey * 1000000000 END AS amount_num,
             CASE WHEN l_returnflag <> 'R' THEN CAST(l_partkey * 1000000000 AS VARCHAR) END AS offering,
             CASE WHEN l_linestatus = 'F' THEN format('{:,.3f}', l_tax * 100) END AS high_yield,
             CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS VARCHAR) END AS btc,
             CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS feed_rank
      FROM lineitem WHERE l_linenumber IN (2, 3, 5, 7)),
k AS (SELECT *, row_number() OVER (PARTITION BY d, cusip ORDER BY feed_rank, type, term_txt, reopening NULLS FIRST,
                                   offering NULLS FIRST, high_yield NULLS FIRST, btc NULLS FIRST) AS rn FROM f),
e AS (SELECT k.*, split_part(term_txt, '-', 1) AS term, CASE WHEN type = 'Note' THEN 'note' ELSE 'bond' END AS kind,
             CASE WHEN reopening = 'Yes' THEN ' reopening' ELSE '' END AS reopen
      FROM k, span WHERE rn = 1 AND d BETWEEN span.lo AND span.hi)
SELECT d, 'AUCTION_' || term || 'Y' AS sym,
       'Treasury ' || term || '-year ' || kind || reopen || ' auction (' ||
         coalesce('$' || format('{:.0f}', amount_num / 1e9) || 'B', 'size TBA') || '), results ~13:02 ET' AS event_name,
       CASE WHEN high_yield IS NOT NULL AND btc IS NOT NULL THEN
         'Treasury ' || term || '-year ' || kind || reopen || ': high yield ' ||
         format('{:.3f}', CAST(replace(high_yield, ',', '') AS DOUBLE)) || '%, bid-to-cover ' ||
         format('{:.2f}', CAST(btc AS DOUBLE)) || coalesce(', $' || format('{:.0f}', amount_num / 1e9) || 'B', '') || '.'
       END AS results_text
FROM e
"""


_SQL_MACRO_SIMPLE = " UNION ALL ".join([
    _rule_sql("CPI", None, "CAST(m + INTERVAL 9 DAY AS DATE)", "next_session", "rule"),
    _rule_sql("RETAIL_SALES", None, "CAST(m + INTERVAL 14 DAY AS DATE)", "next_session", "rule"),
    _rule_sql("GDP", None, f"CASE WHEN month(m) = 12 THEN make_date(year(m), 12, 23) ELSE {_last_sql('m', 3)} END",
              "prev_session", "rule"),
    _rule_sql("PCE", None, f"CASE WHEN month(m) = 12 THEN make_date(year(m), 12, 22) ELSE {_last_sql('m', 4)} END",
              "prev_session", "rule"),
    _rule_sql("UMICH_PRELIM", None, _nth_sql("m", 4, 2), "prev_session", "rule"),
    _rule_sql("UMICH_FINAL", None, _last_sql("m", 4), "prev_session", "rule"),
    _rule_sql("DURABLE_GOODS", None, "CAST(m + INTERVAL 24 DAY AS DATE)", "next_session", "rule"),
    _rule_sql("ECI", (1, 4, 7, 10), "CAST(last_day(m) AS DATE)", "prev_session", "rule"),
    _rule_sql("CB_CONFIDENCE", None, _last_sql("m", 1), "prev_session", "rule"),
])

#: fixed values: New York minutes of the day of each macro release
_MACRO_MINUTES = {"CPI": 510, "PPI": 510, "NFP": 510, "GDP": 510, "PCE": 510, "JOLTS": 600, "RETAIL_SALES": 510, "ADP": 495, "UMICH_PRELIM": 600, "UMICH_FINAL": 600,
                  "DURABLE_GOODS": 510, "ECI": 510, "CB_CONFIDENCE": 600, "ISM_MFG": 600, "ISM_SVC": 600, "JOBLESS_CLAIMS": 510}
_SQL_MACRO_TEXTS = "(VALUES " + ", ".join(f"('{k}', {m}, {', '.join(_text_sql(k))})" for k, m in _MACRO_MINUTES.items()) + ")"
_FIELDS = ("ref", "cur", "q", "qy", "estimate", "week_ending")


def _filled_sql(text: str) -> str:
    for field in _FIELDS:
        text = f"replace({text}, '{{{field}}}', {field})"
    return text


def _macro_sql(listed: str, avail: str) -> str:
    """The macro events where ``avail`` (release, y) are the available schedules and ``listed`` (release, y, d) their days."""
    return f"""
WITH {_SQL_CAL},
mt AS (SELECT DISTINCT month AS m FROM cal),
names(release, sym) AS (VALUES ('CPI', 'CPI'), ('PPI', 'PPI'), ('NFP', 'NFP'), ('GDP', 'GDP'), ('PCE', 'PCE'), ('JOLTS', 'JOLTS'), ('RETAIL', 'RETAIL_SALES')),
om AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(min(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY 1),
avail AS ({avail}), listed AS ({listed}),
ppi AS (SELECT mt.m, c2.next_session AS d FROM mt
          JOIN cal c1 ON c1.d = CAST(mt.m + INTERVAL 9 DAY AS DATE)
          JOIN cal c2 ON c2.d = CAST(c1.next_session + 1 AS DATE)),
nr AS (SELECT m, CAST(m - INTERVAL 1 MONTH + INTERVAL 11 DAY AS DATE) AS ref_day FROM mt),
ns AS (SELECT m, CAST(ref_day + INTERVAL (((5 - (isodow(ref_day) - 1)) % 7 + 7) % 7) DAY + INTERVAL 20 DAY AS DATE) AS rel FROM nr),
nfp AS (SELECT ns.m, c.prev_session AS d FROM ns JOIN cal c
          ON c.d = CASE WHEN month(rel) = 1 AND day(rel) <= 5 THEN CAST(rel + 7 AS DATE) ELSE rel END),
pub AS (SELECT CAST(date_trunc('month', d) AS DATE) AS m, min(d) AS d FROM listed WHERE release = 'NFP' GROUP BY 1),
nfp2 AS (SELECT nfp.m, CASE WHEN EXISTS (SELECT 1 FROM avail a WHERE a.release = 'NFP' AND a.y = year(nfp.m)) THEN pub.d ELSE nfp.d END AS d
         FROM nfp LEFT JOIN pub ON pub.m = nfp.m),
adp AS (SELECT nfp2.m, c.prev_session AS d FROM nfp2 JOIN cal c
          ON c.d = CAST(nfp2.d - INTERVAL ((((isodow(nfp2.d) - 1) - 2 + 6) % 7 + 7) % 7 + 1) DAY AS DATE)),
claims AS (SELECT c.d FROM cal c LEFT JOIN cal t ON t.d = CAST(c.d + 1 AS DATE)
           WHERE (isodow(c.d) = 4 AND c.is_session AND NOT (month(c.d) = 11 AND day(c.d) = 11))
              OR (isodow(c.d) = 3 AND (NOT coalesce(t.is_session, false)
                                       OR (month(c.d + 1) = 11 AND day(c.d + 1) = 11)))),
rules AS ({_SQL_MACRO_SIMPLE}
  UNION ALL SELECT 'PPI', d, 'rule' FROM ppi WHERE date_trunc('month', d) = m
  UNION ALL SELECT 'NFP', d, 'rule' FROM nfp WHERE date_trunc('month', d) = m
  UNION ALL SELECT 'ADP', d, 'rule' FROM adp WHERE date_trunc('month', d) = m
  UNION ALL SELECT 'ISM_MFG', d, 'rule' FROM cal WHERE session_no = 1
  UNION ALL SELECT 'ISM_SVC', d, 'rule' FROM cal WHERE session_no = 3
  UNION ALL SELECT 'JOBLESS_CLAIMS', d, 'rule' FROM claims),
ev AS (SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM names n JOIN avail a ON a.release = n.release WHERE n.sym = r.sym AND a.y = year(r.d))
  UNION ALL SELECT DISTINCT n.sym, l.d, 'fred' FROM listed l JOIN names n USING (release)),
f AS (SELECT *, CAST(date_trunc('month', d) AS DATE) AS m, (month(d) - 1) // 3 AS q0 FROM ev),
g AS (SELECT *, strftime(m - CASE WHEN sym = 'JOLTS' THEN INTERVAL 2 MONTH ELSE INTERVAL 1 MONTH END, '%B %Y') AS ref, strftime(m, '%B %Y') AS cur,
             CAST(CASE WHEN q0 = 0 THEN 4 ELSE q0 END AS VARCHAR) AS q, CAST(CASE WHEN month(m) > 3 THEN year(m) ELSE year(m) - 1 END AS VARCHAR) AS qy,
             ['advance', 'second', 'third'][(month(m) - 1) % 3 + 1] AS estimate,
             strftime(CAST(d - INTERVAL (((isodow(d) - 1 - 5) % 7 + 7) % 7) DAY AS DATE), '%Y-%m-%d') AS week_ending FROM f),
od AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
tx AS (SELECT * FROM {_SQL_MACRO_TEXTS} v(sym, mi, event_name, fallback))
SELECT g.d, g.sym, g.schedule_source, coalesce(od.n, 0) AS n_orders,
       ((CAST(g.d AS TIMESTAMP) + to_minutes(tx.mi)) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS time,
       {_filled_sql("event_name")} AS event_name, {_filled_sql("fallback")} AS summary_fallback,
       CASE WHEN g.sym IN ('GDP', 'ECI') THEN 'Q' || q || ' ' || qy WHEN g.sym IN ('UMICH_PRELIM', 'UMICH_FINAL', 'CB_CONFIDENCE') THEN cur
            WHEN g.sym = 'JOBLESS_CLAIMS' THEN week_ending ELSE ref END AS release_for
FROM g JOIN tx USING (sym) LEFT JOIN od USING (d), span WHERE g.d BETWEEN span.lo AND span.hi
"""


SQL_MACRO_RULES = _macro_sql("SELECT '' AS release, 0 AS y, DATE '1900-01-01' AS d WHERE false", "SELECT '' AS release, 0 AS y WHERE false")


def q_macro_scheduled(spark, sf):
    """Macro releases with landed schedules: for a release and year either days, an empty list, a broken payload or none.

    The name fetched for one release is not the expected one, so its schedules do not count.
    """
    t = Tables(spark, sf)
    cal, lo, hi = _cal(spark, t, trim=False)
    base = _stage(spark)
    numbered = [(k, r, *v) for k, (r, v) in enumerate(RELEASES.items())]
    releases = spark.createDataFrame(numbered, "k int, release string, release_id long, phrase string")
    every = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).alias("release")) for k, r, _, _ in numbered]))
    name = F.when(F.col("release") == "PCE", F.lit("Something Else")).otherwise(F.concat(F.lit("The "), F.initcap("phrase"), F.lit(" Report")))
    releases.select("release_id", F.array(F.struct(name.alias("name"))).alias("releases")).write.json(f"{base}/names")
    months = t.orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m")).agg(F.min(F.col("o_orderdate").cast("date")).alias("first_day"))
    # twelve days a payload at most
    payload = (months.select("*", every).withColumn("year", F.year("m"))
                     .groupBy("release", "k", "year").agg(F.sort_array(F.collect_list(F.struct(F.date_add("first_day", F.col("k")).cast("string").alias("date")))).alias("days")))
    kind = (F.col("k") + F.col("year")) % 3
    text = F.to_json(F.struct("release", "year", F.when(kind == 1, F.col("days")).otherwise(F.filter("days", lambda x: F.lit(False))).alias("release_dates")))
    payload = payload.where((kind != 0) | (F.col("year") % 2 == 0))
    payload.select(F.when(kind == 0, F.substring(text, 1, 20)).otherwise(text).alias("value")).write.text(f"{base}/dates")
    dates = checkpointed(read_fred_release_dates(spark, f"{base}/dates"))
    coverage = release_coverage(read_fred_release_names(spark, f"{base}/names"), dates)
    ev = macro_events(cal, shift_lookup(cal), dates, coverage).where(F.col("d").between(lo, hi))
    return _macro_columns(t, ev)


_SQL_RELEASES = "(VALUES " + ", ".join(f"({k}, '{r}')" for k, r in enumerate(RELEASES)) + ") v(k, release)"
SQL_MACRO_SCHEDULED = _macro_sql(
    f"SELECT release, year(m) AS y, CAST(first_day + CAST(k AS INT) AS DATE) AS d FROM om, {_SQL_RELEASES} "
    "WHERE (k + year(m)) % 3 = 1 AND release <> 'PCE' AND year(first_day + CAST(k AS INT)) = year(m)",
    f"SELECT DISTINCT release, year(m) AS y FROM om, {_SQL_RELEASES} WHERE (k + year(m)) % 3 <> 0 AND release <> 'PCE'")


def _later(t: Tables):
    """Order days thirty years on, where the embedded calendars are."""
    return t.orders.select(F.add_months(F.col("o_orderdate").cast("date"), 360).alias("day"))


def q_list_schedules(spark, sf):
    """Events of the embedded calendars and the rules tied to them, with times and texts."""
    t = Tables(spark, sf)
    cal, lo, hi = _cal(spark, t, trim=False, days=_later(t))
    ev = central_bank_events(spark, cal, shift_lookup(cal)).unionByName(treasury_events(spark, cal))
    return (ev.where(F.col("d").between(lo, hi))
              .select("d", F.col("time").cast("timestamp_ntz").alias("time"), "sym", "event_name", "schedule_source", "summary_fallback"))


def q_uncovered_years(spark, sf):
    t = Tables(spark, sf)
    cal, _, _ = _cal(spark, t, days=_later(t))
    return uncovered_years(cal)


#: in the middle of the later span
LATER_NOW = _dt.datetime(2028, 6, 30, 12, 0, 0)


def q_event_table(spark, sf):
    """The whole event table over the later span: every family, what has happened by then, and the texts of that."""
    t = Tables(spark, sf)
    cal, lo, hi = _cal(spark, t, trim=False, days=_later(t))
    ev = market_events(spark, cal, LATER_NOW, start=lo, end=hi)
    return ev.withColumn("time", F.col("time").cast("timestamp_ntz"))


def _days_sql(days: list[str]) -> str:
    return "(SELECT CAST(x AS DATE) AS d FROM (VALUES " + ", ".join(f"('{x}')" for x in days) + ") v(x))"


_LATER_SPAN = ("CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 30 YEAR AS DATE) AS lo, "
               "CAST(CAST(max(o_orderdate) AS DATE) + INTERVAL 30 YEAR AS DATE) AS hi")
_SQL_LATER_CAL = _SQL_CAL.replace("CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi", _LATER_SPAN)


def _fixed_sql(sym: str, days: str, minute: int, source: str) -> str:
    name, fallback = _text_sql(sym)
    return f"SELECT '{sym}' AS sym, d, {minute} AS mi, {name} AS event_name, '{source}' AS schedule_source, {fallback} AS summary_fallback FROM {days}"


_FOMC_DAYS = _days_sql([b for _, b in FOMC_MEETINGS])
SQL_LIST_SCHEDULES = f"""
WITH {_SQL_LATER_CAL},
fomc AS (SELECT sym, d, mi, event_name || CASE WHEN month(d) % 3 = 0 THEN '{TEXT["FOMC_SEP"]}' ELSE '' END AS event_name,
                schedule_source, summary_fallback FROM ({_fixed_sql("FOMC", _FOMC_DAYS, 840, "official")})),
minutes AS (SELECT 'FOMC_MINUTES' AS sym, c.prev_session AS d, 840 AS mi,
                   replace({_text_sql("FOMC_MINUTES")[0]}, '{{meeting}}', strftime(f.d, '%B %Y')) AS event_name, 'rule' AS schedule_source,
                   replace({_text_sql("FOMC_MINUTES")[1]}, '{{meeting}}', strftime(f.d, '%B %Y')) AS summary_fallback
            FROM {_FOMC_DAYS} f JOIN cal c ON c.d = CAST(f.d + 21 AS DATE)),
august AS (SELECT DISTINCT {_nth_sql("month", 4, 4)} AS d FROM cal WHERE month(month) = 8),
ev AS (SELECT * FROM fomc UNION ALL SELECT * FROM minutes
       UNION ALL {_fixed_sql("ECB", _days_sql(ECB_DECISIONS), 495, "official")}
       UNION ALL {_fixed_sql("BOJ", "(SELECT CAST(d - 1 AS DATE) AS d FROM " + _days_sql(BOJ_DECISIONS_JST) + ")", 1380, "official")}
       UNION ALL {_fixed_sql("QRA", _days_sql(QRA_DATES), 510, "official")}
       UNION ALL {_fixed_sql("JACKSON_HOLE", "august", 600, "rule")})
SELECT d, ((CAST(d AS TIMESTAMP) + to_minutes(mi)) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS time,
       sym, event_name, schedule_source, summary_fallback
FROM ev, span WHERE d BETWEEN span.lo AND span.hi
"""

def _later_sql(sql: str) -> str:
    return sql.replace(_SQL_CAL, _SQL_LATER_CAL)


SQL_EVENT_TABLE = f"""
WITH ev AS (
  SELECT time, sym, event_name, release_for, schedule_source, summary_fallback FROM ({_later_sql(SQL_MACRO_RULES)}) a
  UNION ALL SELECT time, sym, event_name, NULL, schedule_source, summary_fallback FROM ({_later_sql(SQL_CALENDAR_RULES)}) b
  UNION ALL SELECT time, sym, event_name, NULL, schedule_source, summary_fallback FROM ({SQL_LIST_SCHEDULES}) c)
SELECT time, sym, event_name, release_for, CASE WHEN time <= TIMESTAMP '{LATER_NOW:%Y-%m-%d %H:%M:%S}' THEN 'actual' ELSE 'expected' END AS event_date_type,
       CASE WHEN time <= TIMESTAMP '{LATER_NOW:%Y-%m-%d %H:%M:%S}' THEN coalesce(summary_fallback, event_name || '.') END AS summarize, schedule_source
FROM ev ORDER BY time, sym
"""

SQL_UNCOVERED_YEARS = f"""
WITH span AS (SELECT {_LATER_SPAN} FROM orders),
y AS (SELECT CAST(unnest(generate_series(year(lo), year(hi))) AS INT) AS year FROM span),
held AS ({" UNION ALL ".join(f"SELECT '{name}' AS calendar, year(d) AS year FROM {_days_sql(days)}" for name, days in
         (("FOMC", [b for _, b in FOMC_MEETINGS]), ("ECB", ECB_DECISIONS), ("BOJ", BOJ_DECISIONS_JST), ("QRA", QRA_DATES)))})
SELECT c.calendar, y.year FROM (SELECT DISTINCT calendar FROM held) c, y
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.calendar = c.calendar AND h.year = y.year)
"""


QUERIES = {
    "list_schedules": (q_list_schedules, SQL_LIST_SCHEDULES),
    "event_table": (q_event_table, SQL_EVENT_TABLE),
    "uncovered_years": (q_uncovered_years, SQL_UNCOVERED_YEARS),
    "nth_weekday": (q_nth_weekday, SQL_NTH_WEEKDAY),
    "last_weekday": (q_last_weekday, SQL_LAST_WEEKDAY),
    "session_fill": (q_session_fill, SQL_SESSION_FILL),
    "wall_clock": (q_wall_clock, SQL_WALL_CLOCK),
    "period_labels": (q_period_labels, SQL_PERIOD_LABELS),
    "event_status": (q_event_status, SQL_EVENT_STATUS),
    "calendar_rules": (q_calendar_rules, SQL_CALENDAR_RULES),
    "macro_rules": (q_macro_rules, SQL_MACRO_RULES),
    "macro_scheduled": (q_macro_scheduled, SQL_MACRO_SCHEDULED),
    "auction_rows": (q_auction_rows, SQL_AUCTION_ROWS),
}
