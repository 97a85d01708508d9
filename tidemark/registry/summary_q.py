"""Summaries of events from an observation table, on stand-ins made from the orders.

Every order is an event of one of eleven kinds on its day. Monthly series take their values from the
order keys of a month, daily ones from those of a day; observations are missing here and there and
come twice, the later load being right.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..plans.summaries import BLS_SERIES, FRED, SENTENCES, summarize
from .base import Tables

_KINDS = ("CPI", "PPI", "NFP", "PCE", "RETAIL_SALES", "DURABLE_GOODS", "JOBLESS_CLAIMS", "GDP", "FOMC", "ECB", "AUCTION_10Y")
_MONTHLY = [BLS_SERIES[k] for k in ("cpi_sa", "cpi_nsa", "cpi_core_sa", "ppi_sa", "ppi_nsa", "payrolls", "unemp")] + [
    FRED[k] for k in ("pce", "pce_core", "retail", "retail_ex", "durables", "gdp")]
_DAILY = [FRED[k] for k in ("claims", "upper", "lower", "ecb")]


def _observations(t: Tables):
    day = F.col("o_orderdate").cast("date")

    def numbered(names):
        return F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("series")) for k, n in enumerate(names)]))

    monthly = t.orders.groupBy(F.trunc(day, "MM").alias("d")).agg(F.sum("o_orderkey").alias("s")).select("*", numbered(_MONTHLY))
    monthly = monthly.where((F.month("d") + F.col("k")) % 5 != 0).select("series", "d", ((F.col("s") * (F.col("k") + 3) % 1009) / 8 + 100).alias("value"))
    daily = t.orders.groupBy(day.alias("d")).agg(F.sum("o_orderkey").alias("s")).select("*", numbered(_DAILY))
    daily = daily.where((F.dayofmonth("d") % 4 != 0) & (F.month("d") % 5 != 2))
    rate = ((F.col("s") + F.col("k")) % 3) * 0.25 + 2
    daily = daily.select("series", "d", F.when(F.col("k") == 0, rate * 100000).otherwise(rate).alias("value"))
    right = monthly.unionByName(daily).withColumn("load_rank", F.lit(1))
    return right.unionByName(right.withColumns({"value": F.col("value") + 1, "load_rank": F.lit(0)}))


def _events(t: Tables):
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    sym = F.element_at(F.array(*map(F.lit, _KINDS)), (key % len(_KINDS) + 1).cast("int"))
    kind = F.when(key % 2 == 0, "note").otherwise("bond")
    cols = {"event_id": key, "sym": sym, "event_name": F.concat(F.lit("Event "), sym), "summary_fallback": F.when(key % 3 > 0, F.concat(F.lit("No data for "), sym)),
            "ref_year": F.year(day), "ref_month": F.month(day), "ref_day2": day, "ref_decision": day, "ref_week_ending": day, "ref_q": F.quarter(day),
            "ref_qy": F.year(day), "ref_estimate": F.lit("second"), "auction_term": F.lit("10"), "auction_kind": kind, "auction_reopen": key % 5 == 0,
            "auction_high_yield": F.when(key % 7 > 0, (key % 5000 / 1000).cast("string")), "auction_btc": F.lit("2.5"),
            "auction_amount": F.when(key % 4 > 0, F.concat((key % 90 + 1).cast("string"), F.lit("000000000")))}
    return t.orders.select(*[c.alias(n) for n, c in cols.items()])


def q_event_summaries(spark, sf):
    t = Tables(spark, sf)
    return summarize(_events(t), _observations(t)).select("event_id", "sym", "summarize")


def _values(names):
    return ", ".join(f"({k}, '{n}')" for k, n in enumerate(names))


def _text(key: str, **fields: str) -> str:
    """A sentence as an SQL concatenation; null where a field is."""
    parts = "'" + SENTENCES[key].replace("'", "''") + "'"
    return "(" + reduce(lambda text, f: text.replace("{" + f + "}", f"' || {fields[f]} || '"), fields, parts) + ")"


def _pct(name, n=1):
    return f"format('{{:+.1f}}', (v_{name}_0 / nullif(v_{name}_{n}, 0) - 1) * 100) || '%'"


_BODY = "nullif(concat_ws(', ', {}), '')"
_MM, _YY, _CORE = f"'m/m ' || {_pct('sa')}", f"'y/y ' || {_pct('nsa', 12)}", f"'core m/m ' || {_pct('core')}"
_REF = "strftime(day, '%B %Y')"
_VERB, _POINTS = "CASE WHEN after < before THEN 'cut' ELSE 'raised' END", "format('{:.0f}', abs(after - before) * 100)"


def _looked_up() -> str:
    """Left joins of the exact points: the value of a series some months before the event's month."""
    wanted = {"sa": {"CPI": "cpi_sa", "PPI": "ppi_sa"}, "nsa": {"CPI": "cpi_nsa", "PPI": "ppi_nsa"}, "core": {"CPI": "cpi_core_sa"},
              "head": {"NFP": "payrolls", "PCE": "pce", "RETAIL_SALES": "retail", "DURABLE_GOODS": "durables"},
              "extra": {"PCE": "pce_core", "RETAIL_SALES": "retail_ex"}, "unemp": {"NFP": "unemp"}}
    every = {**BLS_SERIES, **FRED}
    out = []
    for name, series in wanted.items():
        case = "CASE sym " + " ".join(f"WHEN '{s}' THEN '{every[k]}'" for s, k in series.items()) + " END"
        for n in (0, 1, 12):
            out.append(f"LEFT JOIN obs {name}_{n} ON {name}_{n}.series = {case} AND {name}_{n}.d = CAST(month - INTERVAL {n} MONTH AS DATE)")
    return "\n".join(out)


_NAMES = [f"{name}_{n}" for name in ("sa", "nsa", "core", "head", "extra", "unemp") for n in (0, 1, 12)]

SQL_EVENT_SUMMARIES = f"""
WITH o AS (SELECT o_orderkey AS key, CAST(o_orderdate AS DATE) AS day FROM orders),
md AS (SELECT CAST(date_trunc('month', day) AS DATE) AS d, sum(key) AS s FROM o GROUP BY 1), dd AS (SELECT day AS d, sum(key) AS s FROM o GROUP BY 1),
mn(k, series) AS (VALUES {_values(_MONTHLY)}), dn(k, series) AS (VALUES {_values(_DAILY)}),
obs AS (SELECT series, d, CAST(s * (k + 3) % 1009 AS DOUBLE) / 8 + 100 AS value FROM md, mn WHERE (month(d) + k) % 5 <> 0
  UNION ALL SELECT series, d, (CAST((s + k) % 3 AS DOUBLE) * 0.25 + 2) * CASE WHEN k = 0 THEN 100000 ELSE 1 END FROM dd, dn WHERE day(d) % 4 <> 0 AND month(d) % 5 <> 2),
e AS (SELECT *, CAST(date_trunc('month', day) AS DATE) AS month, [{", ".join(f"'{k}'" for k in _KINDS)}][key % {len(_KINDS)} + 1] AS sym FROM o),
x AS (SELECT e.*, {", ".join(f"{n}.value AS v_{n}" for n in _NAMES)}, p.value AS point
FROM e {_looked_up()}
LEFT JOIN obs p ON p.series = CASE sym WHEN 'GDP' THEN '{FRED["gdp"]}' WHEN 'JOBLESS_CLAIMS' THEN '{FRED["claims"]}' END
               AND p.d = CASE sym WHEN 'GDP' THEN CAST(date_trunc('quarter', day) AS DATE) ELSE day END),
r AS (SELECT *, CASE sym WHEN 'FOMC' THEN '{FRED["upper"]}' WHEN 'ECB' THEN '{FRED["ecb"]}' ELSE '' END AS rate, '{FRED["lower"]}' AS lower_,
             CASE sym WHEN 'FOMC' THEN day + 3 ELSE day + 12 END AS later, day + 10 AS ten FROM x),
b AS (SELECT r.*, CASE WHEN obs.d >= day - 10 THEN obs.value END AS before FROM r ASOF LEFT JOIN obs ON obs.series = rate AND day >= obs.d),
a AS (SELECT b.*, CASE WHEN obs.d >= later - 10 THEN obs.value END AS after, CASE WHEN obs.d >= later - 10 THEN obs.d END AS after_d
      FROM b ASOF LEFT JOIN obs ON obs.series = rate AND later >= obs.d),
l AS (SELECT a.*, obs.d >= ten - 25 AS any_low FROM a ASOF LEFT JOIN obs ON obs.series = lower_ AND ten >= obs.d),
z AS (SELECT l.*, obs.value AS low FROM l LEFT JOIN obs ON obs.series = lower_ AND obs.d = after_d),
t AS (SELECT key, sym, CASE sym
  WHEN 'CPI' THEN {_text("CPI", ref=_REF, body=_BODY.format(", ".join([_MM, _YY, _CORE])))}
  WHEN 'PPI' THEN {_text("PPI", ref=_REF, body=_BODY.format(", ".join([_MM, _YY])))}
  WHEN 'NFP' THEN {_text("NFP", change="format('{:+.0f}', v_head_0 - v_head_1)", ref=_REF, unemployment="coalesce(" + _text("NFP_UNEMPLOYMENT", rate="format('{:.1f}', v_unemp_0)") + ", '')")}
  WHEN 'PCE' THEN {_text("PCE", ref=_REF, head=_pct("head"), extra="coalesce(" + _text("PCE_EXTRA", value=_pct("extra")) + ", '')")}
  WHEN 'RETAIL_SALES' THEN {_text("RETAIL_SALES", ref=_REF, head=_pct("head"), extra="coalesce(" + _text("RETAIL_SALES_EXTRA", value=_pct("extra")) + ", '')")}
  WHEN 'DURABLE_GOODS' THEN {_text("DURABLE_GOODS", ref=_REF, head=_pct("head"), extra="''")}
  WHEN 'JOBLESS_CLAIMS' THEN {_text("JOBLESS_CLAIMS", value="format('{:.0f}', point / 1000)", week="strftime(day, '%Y-%m-%d')")}
  WHEN 'GDP' THEN {_text("GDP", q="quarter(day)", qy="year(day)", estimate="'second'", value="format('{:+.1f}', point) || '%'")}
  WHEN 'FOMC' THEN CASE WHEN after_d > day AND any_low THEN CASE WHEN after = before THEN {_text("FOMC_HELD", range="bounds")}
                        ELSE {_text("FOMC_MOVED", verb="verb", points="points", range="bounds", before="format('{:.2f}', before)")} END END
  WHEN 'ECB' THEN CASE WHEN after = before THEN CASE WHEN after_d >= day + 8 THEN {_text("ECB_HELD", after="high")} END
                       ELSE {_text("ECB_MOVED", verb="verb", points="points", after="high")} END
  ELSE {_text("AUCTION", term="'10'", kind="CASE WHEN key % 2 = 0 THEN 'note' ELSE 'bond' END", reopen="CASE WHEN key % 5 = 0 THEN ' reopening' ELSE '' END",
              **{"yield": "CASE WHEN key % 7 > 0 THEN format('{:.3f}', CAST(key % 5000 AS DOUBLE) / 1000) END"}, cover="'2.50'",
              amount="CASE WHEN key % 4 > 0 THEN ', $' || (key % 90 + 1) || 'B' ELSE '' END")} END AS said
  FROM (SELECT *, format('{{:.2f}}', after) AS high, {_VERB} AS verb, {_POINTS} AS points,
               coalesce({_text("RANGE", low="format('{:.2f}', low)", high="format('{:.2f}', after)")}, {_text("UPPER", high="format('{:.2f}', after)")}) AS bounds FROM z))
SELECT key AS event_id, sym, coalesce(said, CASE WHEN key % 3 > 0 THEN 'No data for ' || sym ELSE 'Event ' || sym || '.' END) AS summarize FROM t
"""


QUERIES = {
    "event_summaries": (q_event_summaries, SQL_EVENT_SUMMARIES),
}
