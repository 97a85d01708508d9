"""Time-series lookups (as-of, exact calendar months) and monthly means.

Stand-ins: ``events`` views/purchases for the as-of join; monthly order
revenue per priority for the exact-month changes and change texts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.numbers import join_parts, mean_cents, pct_change, py_fixed
from ..operators import asof_backward, exact_change, value_months_back
from .base import Tables


def _views_purchases(t: Tables):
    e = t.events
    views = (e.where(F.col("event_type") == "view")
              .groupBy("user_id", "ts").agg(F.max("value").alias("view_value")))
    buys = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    return views, buys


def _asof_query(tol: _dt.timedelta):
    def q(spark, sf):
        views, buys = _views_purchases(Tables(spark, sf))
        return asof_backward(buys, views, ["user_id"], "ts", "ts", tol, ["view_value"], prefix="view_")
    return q


def _asof_sql(interval: str) -> str:
    return f"""
WITH v AS (SELECT user_id, ts, max(value) AS view_value FROM events WHERE event_type = 'view' GROUP BY 1, 2),
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, p.ts, p.value,
       CASE WHEN v.ts >= p.ts - INTERVAL {interval} THEN v.ts END AS view_ts,
       CASE WHEN v.ts >= p.ts - INTERVAL {interval} THEN v.view_value END AS view_view_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
"""


def _monthly(t: Tables):
    o = t.orders
    return (o.groupBy("o_orderpriority", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
             .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue")))


_SQL_MONTHLY = """
WITH mth AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                    round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1, 2)
"""


def q_exact_month_change(spark, sf):
    m = _monthly(Tables(spark, sf))
    out = exact_change(m, ["o_orderpriority"], "month", "revenue", 1, "mom")
    out = exact_change(out, ["o_orderpriority"], "month", "revenue", 12, "yoy")
    return out.select("o_orderpriority", "month", "revenue", F.round("mom", 4).alias("mom"),
                      F.round("yoy", 4).alias("yoy"))


SQL_EXACT_MONTH_CHANGE = _SQL_MONTHLY + """
SELECT c.o_orderpriority, c.month, c.revenue,
       round((c.revenue / nullif(p1.revenue, 0) - 1) * 100, 4) AS mom,
       round((c.revenue / nullif(p12.revenue, 0) - 1) * 100, 4) AS yoy
FROM mth c
LEFT JOIN mth p1 ON p1.o_orderpriority = c.o_orderpriority AND p1.month = c.month - INTERVAL 1 MONTH
LEFT JOIN mth p12 ON p12.o_orderpriority = c.o_orderpriority AND p12.month = c.month - INTERVAL 12 MONTH
"""


def q_month_mean(spark, sf):
    o = Tables(spark, sf).orders
    return (o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
             .agg(F.count(F.lit(1)).alias("n"), mean_cents("o_totalprice").alias("mean_price")))


_SQL_MEAN_CENTS = """(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(o_totalprice)
  + CASE WHEN 2 * (sum(CAST(round(o_totalprice * 100) AS BIGINT)) % count(o_totalprice)) >= count(o_totalprice)
         THEN 1 ELSE 0 END) / 100.0"""

SQL_MONTH_MEAN = f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n, {_SQL_MEAN_CENTS} AS mean_price
FROM orders GROUP BY 1
"""


def q_sym_month_mean(spark, sf):
    o = Tables(spark, sf).orders
    return (o.groupBy(F.col("o_orderpriority").alias("sym"),
                      F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
             .agg(mean_cents("o_totalprice").alias("mean_price"))
             .orderBy("sym", "month"))


SQL_SYM_MONTH_MEAN = f"""
SELECT o_orderpriority AS sym, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {_SQL_MEAN_CENTS} AS mean_price
FROM orders GROUP BY 1, 2 ORDER BY 1, 2
"""


def q_change_text(spark, sf):
    """Monthly change texts: only the available parts, none -> null."""
    m = _monthly(Tables(spark, sf))
    m = value_months_back(m, ["o_orderpriority"], "month", "revenue", 1, "prev1")
    m = value_months_back(m, ["o_orderpriority"], "month", "revenue", 12, "prev12")
    mom, yoy = pct_change(F.col("revenue"), F.col("prev1")), pct_change(F.col("revenue"), F.col("prev12"))
    part = lambda label, v: F.when(v.isNotNull(), F.concat(F.lit(label + " "), py_fixed(v, 1, sign=True),
                                                             F.lit("%")))
    body = join_parts(part("m/m", mom), part("y/y", yoy))
    text = F.when(body.isNotNull(), F.concat(F.lit("Revenue "), F.date_format("month", "MMMM yyyy"),
                                             F.lit(": "), body, F.lit(".")))
    return m.select("o_orderpriority", "month", text.alias("change_text"))


SQL_CHANGE_TEXT = _SQL_MONTHLY + """,
x AS (SELECT c.o_orderpriority, c.month,
             (c.revenue / nullif(p1.revenue, 0) - 1) * 100 AS mom, (c.revenue / nullif(p12.revenue, 0) - 1) * 100 AS yoy
      FROM mth c
      LEFT JOIN mth p1 ON p1.o_orderpriority = c.o_orderpriority AND p1.month = c.month - INTERVAL 1 MONTH
      LEFT JOIN mth p12 ON p12.o_orderpriority = c.o_orderpriority AND p12.month = c.month - INTERVAL 12 MONTH),
y AS (SELECT *, nullif(concat_ws(', ', CASE WHEN mom IS NOT NULL THEN 'm/m ' || format('{:+.1f}', mom) || '%' END,
                                      CASE WHEN yoy IS NOT NULL THEN 'y/y ' || format('{:+.1f}', yoy) || '%' END), '') AS body
      FROM x)
SELECT o_orderpriority, month,
       CASE WHEN body IS NOT NULL THEN 'Revenue ' || strftime(month, '%B %Y') || ': ' || body || '.' END AS change_text
FROM y
"""


def q_point_text(spark, sf):
    """Exact-day lookup with fallback text: purchases joined to the same-second view."""
    t = Tables(spark, sf)
    views, buys = _views_purchases(t)
    days = (t.events.groupBy(F.col("ts").cast("date").alias("day"))
             .agg(F.max(F.when(F.col("event_type") == "signup", F.col("value"))).alias("signup_max")))
    probe = (t.events.where(F.col("event_type") == "purchase")
             .select("event_id", F.col("ts").cast("date").alias("day")))
    j = probe.join(days, "day", "left")
    text = F.coalesce(
        F.when(F.col("signup_max").isNotNull(),
               F.concat(F.lit("Top signup value "), py_fixed(F.col("signup_max"), 2, grouping=True),
                        F.lit(" on "), F.date_format("day", "yyyy-MM-dd"), F.lit("."))),
        F.lit("No signup data."))
    return j.select("event_id", "day", text.alias("summary"))


SQL_POINT_TEXT = """
WITH d AS (SELECT CAST(ts AS DATE) AS day, max(CASE WHEN event_type = 'signup' THEN value END) AS signup_max
           FROM events GROUP BY 1)
SELECT e.event_id, CAST(e.ts AS DATE) AS day,
       coalesce('Top signup value ' || format('{:,.2f}', d.signup_max) || ' on ' || strftime(CAST(e.ts AS DATE), '%Y-%m-%d') || '.',
                'No signup data.') AS summary
FROM events e LEFT JOIN d ON d.day = CAST(e.ts AS DATE) WHERE e.event_type = 'purchase'
"""


def q_policy_change_text(spark, sf):
    """Rate series = daily max event value; before/after as-of lookups around
    each day; held / cut / raised text (or null when inconclusive)."""
    t = Tables(spark, sf)
    rate = (t.events.groupBy(F.col("ts").cast("date").alias("d"))
             .agg(F.max("value").alias("rate")).withColumn("k", F.lit(1)))
    probes = (rate.select(F.col("d").alias("decision"), "k")
                  .withColumn("after_probe", F.date_add("decision", 3)))
    ten = _dt.timedelta(days=10)
    b = asof_backward(probes, rate, ["k"], "decision", "d", ten, ["rate"], prefix="b_")
    a = asof_backward(b, rate, ["k"], "after_probe", "d", ten, ["rate"], prefix="a_")
    bu, au = F.col("b_rate"), F.col("a_rate")
    ok = bu.isNotNull() & au.isNotNull() & (F.col("a_d") > F.col("decision"))
    verb = F.when(au < bu, F.lit("cut")).otherwise(F.lit("raised"))
    text = F.when(ok, F.when(au == bu, F.concat(F.lit("held at "), py_fixed(au, 2), F.lit(".")))
                  .otherwise(F.concat(verb, F.lit(" "), py_fixed(F.abs(au - bu) * 100, 0), F.lit("bp to "),
                                      py_fixed(au, 2), F.lit(" (was "), py_fixed(bu, 2), F.lit(")."))))
    return a.select("decision", "b_d", "a_d", text.alias("policy_text"))


SQL_POLICY_CHANGE_TEXT = """
WITH r AS (SELECT CAST(ts AS DATE) AS d, max(value) AS rate FROM events GROUP BY 1),
p AS (SELECT d AS decision, d + 3 AS after_probe FROM r),
b AS (SELECT p.*, CASE WHEN r.d >= p.decision - 10 THEN r.d END AS b_d,
             CASE WHEN r.d >= p.decision - 10 THEN r.rate END AS b_rate
      FROM p ASOF LEFT JOIN r ON p.decision >= r.d),
a AS (SELECT b.*, CASE WHEN r.d >= b.after_probe - 10 THEN r.d END AS a_d,
             CASE WHEN r.d >= b.after_probe - 10 THEN r.rate END AS a_rate
      FROM b ASOF LEFT JOIN r ON b.after_probe >= r.d)
SELECT decision, b_d, a_d,
       CASE WHEN b_rate IS NOT NULL AND a_rate IS NOT NULL AND a_d > decision THEN
            CASE WHEN a_rate = b_rate THEN 'held at ' || format('{:.2f}', a_rate) || '.'
                 ELSE (CASE WHEN a_rate < b_rate THEN 'cut' ELSE 'raised' END) || ' ' ||
                      format('{:.0f}', abs(a_rate - b_rate) * 100) || 'bp to ' || format('{:.2f}', a_rate) ||
                      ' (was ' || format('{:.2f}', b_rate) || ').' END END AS policy_text
FROM a
"""


QUERIES = {
    "asof_backward": (_asof_query(_dt.timedelta(days=10)), _asof_sql("10 DAY")),
    "asof_backward_1h": (_asof_query(_dt.timedelta(hours=1)), _asof_sql("1 HOUR")),
    "exact_month_change": (q_exact_month_change, SQL_EXACT_MONTH_CHANGE),
    "month_mean": (q_month_mean, SQL_MONTH_MEAN),
    "sym_month_mean": (q_sym_month_mean, SQL_SYM_MONTH_MEAN),
    "change_text": (q_change_text, SQL_CHANGE_TEXT),
    "point_text": (q_point_text, SQL_POINT_TEXT),
    "policy_change_text": (q_policy_change_text, SQL_POLICY_CHANGE_TEXT),
}
