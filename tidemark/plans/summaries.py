"""Data-driven summaries of past events, joined from an observation table.

``observations``: (series, d, value) — monthly series at the first day of
the month, daily/weekly/quarterly series at their observation date. All
points that the events ask for are looked up together (``observed_values``); a missing value only
drops that part of the text, and a row never fails (``try_divide``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label
from ..functions.numbers import join_parts, pct_change, py_fixed
from ..functions.casts import try_double
from ..session import checkpointed
from ..operators.asof import asof_backward
from .events import fmt

# Observation series used by the summaries.
BLS_SERIES = {
    "cpi_sa": "CUSR0000SA0",
    "cpi_nsa": "CUUR0000SA0",
    "cpi_core_sa": "CUSR0000SA0L1E",
    "ppi_sa": "WPSFD4",
    "ppi_nsa": "WPUFD4",
    "payrolls": "CES0000000001",
    "unemp": "LNS14000000",
}
FRED = {
    "upper": "DFEDTARU", "lower": "DFEDTARL", "claims": "ICSA", "gdp": "A191RL1Q225SBEA",
    "pce": "PCEPI", "pce_core": "PCEPILFE", "retail": "RSAFS", "retail_ex": "RSFSXMV",
    "durables": "DGORDER", "ecb": "ECBDFR",
}


def unique_observations(obs: DataFrame) -> DataFrame:
    """One value for each (series, d): that with the largest ``load_rank`` where the column exists, else the largest.

    Overlapping payloads repeat observations; an event must meet each once.
    """
    rank = F.col("load_rank") if "load_rank" in obs.columns else F.lit(0)
    best = F.max(F.when(F.col("value").isNotNull(), F.struct(rank.alias("r"), F.col("value").alias("v"))))
    return obs.groupBy("series", "d").agg(best.alias("b")).select("series", "d", F.col("b.v").alias("value"))


def observations(bls: DataFrame, fred: DataFrame) -> DataFrame:
    """The observation table of the landed series, each (series, d) once.

    ``bls``: (series, year, month, value), dated the first of the month here;
    ``fred``: (series, d, value). Both may carry ``load_rank``.
    """
    monthly = (bls.where(F.col("month").between(1, 12))
                  .withColumn("d", F.make_date("year", "month", F.lit(1))).drop("year", "month"))
    return unique_observations(monthly.unionByName(fred, allowMissingColumns=True))


# The sentences of the summaries.
SENTENCES = {
    "CPI": "CPI {ref}: {body} (BLS).",
    "PPI": "PPI final demand {ref}: {body} (BLS).",
    "NFP": "Nonfarm payrolls {change}k in {ref}{unemployment} (BLS).",
    "NFP_UNEMPLOYMENT": "; unemployment rate {rate}%",
    "JOBLESS_CLAIMS": "Initial jobless claims {value}k, week ending {week} (DOL via FRED).",
    "GDP": "Real GDP Q{q} {qy} ({estimate} estimate): {value} q/q SAAR (BEA via FRED, current vintage).",
    "PCE": "PCE price index {ref}: {head} m/m{extra} (BEA via FRED, current vintage).",
    "RETAIL_SALES": "Retail sales {ref}: {head} m/m{extra} (Census via FRED, current vintage).",
    "DURABLE_GOODS": "Durable goods orders {ref}: {head} m/m{extra} (Census via FRED, current vintage).",
    "PCE_EXTRA": "; core {value} m/m",
    "RETAIL_SALES_EXTRA": "; ex-autos {value} m/m",
    "RANGE": "{low}–{high}%",
    "UPPER": "upper bound {high}%",
    "FOMC_HELD": "FOMC held the target range at {range}.",
    "FOMC_MOVED": "FOMC {verb} rates {points}bp to {range} (upper bound was {before}%).",
    "ECB_HELD": "ECB held the deposit facility rate at {after}%.",
    "ECB_MOVED": "ECB {verb} the deposit facility rate {points}bp to {after}%.",
    "AUCTION": "Treasury {term}-year {kind}{reopen}: high yield {yield}%, bid-to-cover {cover}{amount}.",
}

#: the longest that an as-of observation may be older than its day
_LONGEST = 25


def _exact_points() -> dict[str, list[tuple[str, str, Column]]]:
    """By symbol the observations that an event needs on a given day: (role, series, day)."""
    month = F.make_date(F.col("ref_year"), F.col("ref_month"), F.lit(1))

    def back(name: str, series: str, *months: int) -> list:
        return [(f"{name}_{n}", series, F.add_months(month, -n)) for n in months]

    quarter = F.make_date(F.col("ref_qy"), F.col("ref_q") * 3 - 2, F.lit(1))
    return {
        "CPI": [*back("sa", BLS_SERIES["cpi_sa"], 0, 1), *back("nsa", BLS_SERIES["cpi_nsa"], 0, 12), *back("core", BLS_SERIES["cpi_core_sa"], 0, 1)],
        "PPI": [*back("sa", BLS_SERIES["ppi_sa"], 0, 1), *back("nsa", BLS_SERIES["ppi_nsa"], 0, 12)],
        "NFP": [*back("head", BLS_SERIES["payrolls"], 0, 1), *back("unemp", BLS_SERIES["unemp"], 0)],
        "PCE": [*back("head", FRED["pce"], 0, 1), *back("extra", FRED["pce_core"], 0, 1)],
        "RETAIL_SALES": [*back("head", FRED["retail"], 0, 1), *back("extra", FRED["retail_ex"], 0, 1)],
        "DURABLE_GOODS": back("head", FRED["durables"], 0, 1),
        "JOBLESS_CLAIMS": [("point", FRED["claims"], F.col("ref_week_ending"))],
        "GDP": [("point", FRED["gdp"], quarter)],
    }


def _asof_points() -> dict[str, list[tuple[str, str, Column, int]]]:
    """By symbol the latest observations that an event needs: (role, series, day, how many days older at most)."""
    day, decision = F.col("ref_day2"), F.col("ref_decision")
    return {
        "FOMC": [("before", FRED["upper"], day, 10), ("after", FRED["upper"], F.date_add(day, 3), 10), ("any_low", FRED["lower"], F.date_add(day, 10), _LONGEST)],
        "ECB": [("before", FRED["ecb"], decision, 10), ("after", FRED["ecb"], F.date_add(decision, 12), 10)],
    }


_ROLES = ("sa_0", "sa_1", "nsa_0", "nsa_12", "core_0", "core_1", "head_0", "head_1", "extra_0", "extra_1", "unemp_0", "point",
          "before", "after", "any_low", "after_low")


def _wanted(ev: DataFrame, points: dict[str, list[tuple]], *names: str) -> DataFrame:
    """(_event, sym, *names) of every point of every event that has a day."""
    lists = None
    for sym, own in points.items():
        items = F.array(*[F.struct(*[(F.lit(v) if not isinstance(v, Column) else v).alias(n) for n, v in zip(names, p)]) for p in own])
        lists = (F if lists is None else lists).when(F.col("sym") == sym, items)
    return ev.select("_event", "sym", F.inline(lists)).where("day IS NOT NULL")


def observed_values(ev: DataFrame, obs: DataFrame) -> DataFrame:
    """Per event (``_event``) the value of each role, and ``after_d``, the day of the role ``after``; events without any are absent.

    ``obs`` has one value for each (series, d). The wanted points of all events are one
    long table: those of a given day meet the observations in one equi-join by
    series and day, the as-of ones in one as-of join; a pivot by role brings them back to their events.
    """
    late = asof_backward(_wanted(ev, _asof_points(), "role", "series", "day", "back"), obs, ["series"], "day", "d", _dt.timedelta(days=_LONGEST), ["value"], "m_")
    late = late.where(F.date_diff("day", "m_d") <= F.col("back")).select("_event", "sym", "role", F.col("m_value").alias("value"), F.col("m_d").alias("d"))
    late = checkpointed(late)
    # the lower bound on the day of the upper one
    low = late.where("role = 'after' AND sym = 'FOMC'").select("_event", F.lit("after_low").alias("role"), F.lit(FRED["lower"]).alias("series"), F.col("d").alias("day"))
    exact = _wanted(ev, _exact_points(), "role", "series", "day").drop("sym").unionByName(low)
    there = exact.join(obs.withColumnRenamed("d", "day"), ["series", "day"]).select("_event", "role", "value", "day")
    both = there.unionByName(late.select("_event", "role", "value", F.col("d").alias("day")))
    return both.groupBy("_event").agg(*[F.max(F.when(F.col("role") == r, F.col("value"))).alias(r) for r in _ROLES],
                                      F.max(F.when(F.col("role") == "after", F.col("day"))).alias("after_d"))


def _pct(v: Column) -> Column:
    return F.concat(py_fixed(v, 1, sign=True), F.lit("%"))


def _part(label: str, v: Column) -> Column:
    return F.when(v.isNotNull(), F.concat(F.lit(label + " "), _pct(v)))


def summarize(ev: DataFrame, obs: DataFrame | None) -> DataFrame:
    """Add ``summarize`` = data text, else the fallback text, else ``name.``."""
    fallback = F.coalesce(F.col("summary_fallback"), F.concat(F.col("event_name"), F.lit(".")))
    if obs is None:
        return ev.withColumn("summarize", F.coalesce(_auction_text(), fallback))
    base = ev.columns
    # written once, as both are read for the points and again for the texts
    ev = checkpointed(ev.withColumn("_event", F.monotonically_increasing_id()))
    values = observed_values(ev, checkpointed(unique_observations(obs)))
    return ev.join(values, "_event", "left").withColumn("summarize", F.coalesce(_data_text(), fallback)).select(*base, "summarize")


def _data_text() -> Column:
    """The sentence of an event from the values of its roles, null where they do not give one."""
    ref = month_label(F.make_date(F.col("ref_year"), F.col("ref_month"), F.lit(1)))
    change = lambda name, n=1: pct_change(F.col(f"{name}_0"), F.col(f"{name}_{n}"))
    body = join_parts(_part("m/m", change("sa")), _part("y/y", change("nsa", 12)), _part("core m/m", change("core")))
    jobs, head, point = F.col("head_0") - F.col("head_1"), _pct(change("head")), F.col("point")
    unemployment = F.coalesce(fmt(SENTENCES["NFP_UNEMPLOYMENT"], rate=py_fixed("unemp_0", 1)), F.lit(""))
    texts = {
        "CPI": fmt(SENTENCES["CPI"], ref=ref, body=body),
        "PPI": fmt(SENTENCES["PPI"], ref=ref, body=body),
        "NFP": fmt(SENTENCES["NFP"], change=py_fixed(jobs, 0, sign=True, grouping=True), ref=ref, unemployment=unemployment),
        "JOBLESS_CLAIMS": fmt(SENTENCES["JOBLESS_CLAIMS"], value=py_fixed(point / 1000, 0, grouping=True), week=F.date_format("ref_week_ending", "yyyy-MM-dd")),
        "GDP": fmt(SENTENCES["GDP"], q=F.col("ref_q"), qy=F.col("ref_qy"), estimate=F.col("ref_estimate"), value=_pct(point)),
    }
    for sym in ("PCE", "RETAIL_SALES", "DURABLE_GOODS"):
        more = SENTENCES.get(f"{sym}_EXTRA")
        extra = F.coalesce(fmt(more, value=_pct(change("extra"))), F.lit("")) if more else F.lit("")
        texts[sym] = fmt(SENTENCES[sym], ref=ref, head=head, extra=extra)

    before, after = F.col("before"), F.col("after")
    verb = F.when(after < before, F.lit("cut")).otherwise(F.lit("raised"))
    points, high = py_fixed(F.abs(after - before) * 100, 0), py_fixed(after, 2)
    bounds = F.coalesce(fmt(SENTENCES["RANGE"], low=py_fixed("after_low", 2), high=high), fmt(SENTENCES["UPPER"], high=high))
    known = (F.col("after_d") > F.col("ref_day2")) & F.col("any_low").isNotNull()
    texts["FOMC"] = F.when(known & (after == before), fmt(SENTENCES["FOMC_HELD"], range=bounds)).when(
        known, fmt(SENTENCES["FOMC_MOVED"], verb=verb, points=points, range=bounds, before=py_fixed(before, 2)))
    # an unchanged rate says something only when it is late enough
    held = F.when(F.col("after_d") >= F.date_add("ref_decision", 8), fmt(SENTENCES["ECB_HELD"], after=high))
    texts["ECB"] = F.when(after == before, held).otherwise(fmt(SENTENCES["ECB_MOVED"], verb=verb, points=points, after=high))

    out = F
    for sym, text in texts.items():
        out = out.when(F.col("sym") == sym, text)
    return out.otherwise(_auction_text())


def _auction_text() -> Column:
    """What the results of an auction say, once yield and cover are numbers."""
    number = lambda c: try_double(F.col(c))
    size = F.try_divide(number("auction_amount"), F.lit(1e9))
    values = {"term": F.col("auction_term"), "kind": F.col("auction_kind"), "reopen": F.when(F.col("auction_reopen"), F.lit(" reopening")).otherwise(F.lit("")),
              "yield": py_fixed(number("auction_high_yield"), 3), "cover": py_fixed(number("auction_btc"), 2),
              "amount": F.coalesce(F.concat(F.lit(", $"), py_fixed(size, 0), F.lit("B")), F.lit(""))}
    return F.when(F.col("sym").startswith("AUCTION_"), fmt(SENTENCES["AUCTION"], **values))
