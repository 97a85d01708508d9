"""Two-source reconciliation, stacked index bars, coverage and row filters.

Stand-ins: two daily price series are the daily order totals of finished
(``F``) and of open or pending (``O``, ``P``) orders; index bars are daily order statistics per
priority, with a three-row symbol table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mismatches, one_sided, reconcile, reconcile_stats, span_by_key
from ..plans.index_bars import index_bars
from .base import Tables

# Stand-in symbol table (own code -> source code).
PRIORITY_SYMBOLS = [("P1", "1-URGENT"), ("P2", "2-HIGH"), ("P5", "5-LOW")]


def _series(t: Tables, finished: bool, name: str):
    return (t.orders.where(F.coalesce(F.col("o_orderstatus") == "F", F.lit(False)) == finished)
             .groupBy(F.col("o_orderdate").cast("date").alias("date"))
             .agg(F.round(F.sum("o_totalprice"), 2).alias(name)))


def _rec(t: Tables):
    return reconcile(_series(t, True, "close_a"), _series(t, False, "close_b"), ["date"], "close_a", "close_b")


def q_full_reconcile(spark, sf):
    r = _rec(Tables(spark, sf))
    return r.select("date", "close_a", "close_b", "match_status", F.round("abs_diff", 2).alias("abs_diff"),
                    F.round("pct_diff", 4).alias("pct_diff"))


_SQL_REC = """
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS close_a FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS close_b FROM orders
      WHERE o_orderstatus IS DISTINCT FROM 'F' GROUP BY 1),
j AS (SELECT date, close_a, close_b FROM a FULL JOIN b USING (date)),
rec AS (SELECT date, close_a, close_b,
               CASE WHEN close_a IS NOT NULL AND close_b IS NOT NULL THEN 'both'
                    WHEN close_b IS NULL THEN 'left_only' ELSE 'right_only' END AS match_status,
               CASE WHEN close_a IS NOT NULL AND close_b IS NOT NULL THEN abs(close_a - close_b) END AS abs_diff,
               CASE WHEN close_a IS NOT NULL AND close_b IS NOT NULL AND close_b <> 0
                    THEN abs((close_a - close_b) / close_b * 100) END AS pct_diff
        FROM j)
"""

SQL_FULL_RECONCILE = _SQL_REC + """
SELECT date, close_a, close_b, match_status, round(abs_diff, 2) AS abs_diff, round(pct_diff, 4) AS pct_diff FROM rec
"""


def q_reconcile_stats(spark, sf):
    s = reconcile_stats(_rec(Tables(spark, sf)), "close_a", "close_b", 0.01)
    return s.select("n_left", "n_right", "n_both", "n_left_only", "n_right_only",
                    F.round("max_abs", 2).alias("max_abs"), F.round("mean_abs", 2).alias("mean_abs"),
                    F.round("max_pct", 4).alias("max_pct"), F.round("mean_pct", 4).alias("mean_pct"),
                    "n_mismatch")


SQL_RECONCILE_STATS = _SQL_REC + """
SELECT count(close_a) AS n_left, count(close_b) AS n_right,
       count(*) FILTER (WHERE match_status = 'both') AS n_both,
       count(*) FILTER (WHERE match_status = 'left_only') AS n_left_only,
       count(*) FILTER (WHERE match_status = 'right_only') AS n_right_only,
       round(max(abs_diff), 2) AS max_abs, round(avg(abs_diff), 2) AS mean_abs,
       round(max(pct_diff), 4) AS max_pct, round(avg(pct_diff), 4) AS mean_pct,
       count(*) FILTER (WHERE abs_diff > 0.01) AS n_mismatch
FROM rec
"""


def q_reconcile_top(spark, sf):
    m = mismatches(_rec(Tables(spark, sf)), ["date"], 0.01, 20)
    return m.select("date", "close_a", "close_b", F.round("abs_diff", 2).alias("abs_diff"))


SQL_RECONCILE_TOP = _SQL_REC + """
SELECT date, close_a, close_b, round(abs_diff, 2) AS abs_diff FROM rec WHERE abs_diff > 0.01
ORDER BY abs_diff DESC, date LIMIT 20
"""


def q_reconcile_left_only(spark, sf):
    return one_sided(_rec(Tables(spark, sf)), ["date"], "left_only", 20).select("date", "close_a")


SQL_RECONCILE_LEFT_ONLY = _SQL_REC + """
SELECT date, close_a FROM rec WHERE match_status = 'left_only' ORDER BY date LIMIT 20
"""


def _raw_bars(t: Tables):
    return (t.orders.groupBy(F.col("o_orderpriority").alias("source_code"),
                             F.col("o_orderdate").cast("date").alias("date"))
             .agg(F.min("o_totalprice").alias("open"), F.max("o_totalprice").alias("high"),
                  F.min("o_totalprice").alias("low"),
                  F.max_by("o_totalprice", "o_orderkey").alias("close"),
                  F.count(F.lit(1)).cast("double").alias("volume")))


def q_reconcile_ranges(spark, sf):
    """First and last day and the number of values of each source."""
    s = reconcile_stats(_rec(Tables(spark, sf)), "close_a", "close_b", 0.01, day="date")
    return s.select("left_from", "left_to", "n_left", "right_from", "right_to", "n_right")


SQL_RECONCILE_RANGES = _SQL_REC + """
SELECT min(date) FILTER (WHERE close_a IS NOT NULL) AS left_from, max(date) FILTER (WHERE close_a IS NOT NULL) AS left_to, count(close_a) AS n_left,
       min(date) FILTER (WHERE close_b IS NOT NULL) AS right_from, max(date) FILTER (WHERE close_b IS NOT NULL) AS right_to, count(close_b) AS n_right
FROM rec
"""


def _window_bars(spark, t: Tables):
    # window end = latest date in the data, as a scalar subquery (evaluated once)
    end = t.orders.select(F.max(F.col("o_orderdate").cast("date"))).scalar()
    syms = spark.createDataFrame(PRIORITY_SYMBOLS, "sym string, source_code string")
    return index_bars(_raw_bars(t), syms, F.add_months(end, -24), end)


def q_stack_symbols(spark, sf):
    return _window_bars(spark, Tables(spark, sf))


_SQL_BARS = """
WITH syms(sym, source_code) AS (VALUES ('P1', '1-URGENT'), ('P2', '2-HIGH'), ('P5', '5-LOW')),
e AS (SELECT CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
raw AS (SELECT o_orderpriority AS source_code, CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS open,
               max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
               CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2),
bars AS (SELECT raw.date, syms.sym, open, high, low, close, volume FROM raw JOIN syms USING (source_code), e
         WHERE raw.date BETWEEN CAST(e.hi - INTERVAL 24 MONTH AS DATE) AND e.hi)
"""

SQL_STACK_SYMBOLS = _SQL_BARS + "SELECT * FROM bars"


def q_coverage_by_key(spark, sf):
    return span_by_key(_window_bars(spark, Tables(spark, sf)), ["sym"], "date")


SQL_COVERAGE_BY_KEY = _SQL_BARS + """
SELECT sym, min(date) AS min_date, max(date) AS max_date, count(date) AS n FROM bars GROUP BY sym
"""


def q_date_window(spark, sf):
    """Orders inside [max date - 10 years, max date], and inside the last 2 years."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    end = o.select(F.max("d")).scalar()
    return (o.where(F.col("d").between(F.add_months(end, -120), end))
             .select("o_orderkey", "d", F.col("d").between(F.add_months(end, -24), end).alias("last_2y")))


SQL_DATE_WINDOW = """
WITH e AS (SELECT CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
       CAST(o_orderdate AS DATE) BETWEEN CAST(e.hi - INTERVAL 24 MONTH AS DATE) AND e.hi AS last_2y
FROM orders, e WHERE CAST(o_orderdate AS DATE) BETWEEN CAST(e.hi - INTERVAL 120 MONTH AS DATE) AND e.hi
"""


def q_symbol_filter(spark, sf):
    """Equality, whitelist, sentinel and null removal on the event stream."""
    t = Tables(spark, sf)
    e = t.events
    return (e.where(F.col("event_type").isin("view", "click", "purchase"))
             .where(F.col("user_id") != 0)
             .where(~F.col("props").isin("", "."))
             .dropna(subset=["value", "props"])
             .select("event_id", "event_type", "user_id", "value"))


SQL_SYMBOL_FILTER = """
SELECT event_id, event_type, user_id, value FROM events
WHERE event_type IN ('view', 'click', 'purchase') AND user_id <> 0 AND props NOT IN ('', '.')
  AND value IS NOT NULL AND props IS NOT NULL
"""


def q_symbol_equal(spark, sf):
    """Single-symbol slice of the stacked bars (``sym == 'P1'``)."""
    return _window_bars(spark, Tables(spark, sf)).where(F.col("sym") == "P1").select("date", "close")


SQL_SYMBOL_EQUAL = _SQL_BARS + "SELECT date, close FROM bars WHERE sym = 'P1'"


QUERIES = {
    "reconcile_ranges": (q_reconcile_ranges, SQL_RECONCILE_RANGES),
    "full_reconcile": (q_full_reconcile, SQL_FULL_RECONCILE),
    "reconcile_stats": (q_reconcile_stats, SQL_RECONCILE_STATS),
    "reconcile_top": (q_reconcile_top, SQL_RECONCILE_TOP),
    "reconcile_left_only": (q_reconcile_left_only, SQL_RECONCILE_LEFT_ONLY),
    "stack_symbols": (q_stack_symbols, SQL_STACK_SYMBOLS),
    "coverage_by_key": (q_coverage_by_key, SQL_COVERAGE_BY_KEY),
    "date_window": (q_date_window, SQL_DATE_WINDOW),
    "symbol_filter": (q_symbol_filter, SQL_SYMBOL_FILTER),
    "symbol_equal": (q_symbol_equal, SQL_SYMBOL_EQUAL),
}
