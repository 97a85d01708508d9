"""Holdings-side operators (versions, reference resolution, mapping, ranking)
applied to the driver tables.

Stand-ins: ``orders`` play filings (custkey = manager, status ``P`` = an
additive amendment, others replace), ``lineitem`` plays holding lines,
``part`` plays the identifier lookup replies.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import parse_sec_date, sec_date_text
from ..operators import (effective_versions, global_rank, keep_one, merge_latest, ordered_concat,
                         resolve_references, share_report)
from ..operators.filters import cache_still_valid
from ..operators.ranking import batch_number, top_n
from ..plans.mapping import symbol_mapping
from ..plans.periods import missing_keys, periods_with_windows, quarter_ends, window_months
from .base import Tables


def _kept_orders(t: Tables):
    o = t.orders
    return effective_versions(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                              F.col("o_orderstatus") != "P")


def q_effective_versions(spark, sf):
    t = Tables(spark, sf)
    return _kept_orders(t).select("o_orderkey", "o_custkey", "o_orderstatus",
                                  F.col("o_orderdate").cast("date").alias("o_orderdate"),
                                  "o_totalprice")


SQL_EFFECTIVE_VERSIONS = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
           FROM orders),
b AS (SELECT *, max(CASE WHEN o_orderstatus <> 'P' THEN rn END) OVER (PARTITION BY o_custkey) AS base FROM r)
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
FROM b WHERE rn >= coalesce(base, 1)
"""


def q_effective_semi(spark, sf):
    t = Tables(spark, sf)
    keep = _kept_orders(t).select("o_orderkey")
    meta = t.orders.join(keep, "o_orderkey", "left_semi").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return (t.lineitem.join(meta, "l_orderkey")
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                     "o_custkey", "o_orderdate"))


SQL_EFFECTIVE_SEMI = f"""
WITH keep AS ({SQL_EFFECTIVE_VERSIONS})
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice,
       o.o_custkey, CAST(o.o_orderdate AS DATE) AS o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE EXISTS (SELECT 1 FROM keep k WHERE k.o_orderkey = o.o_orderkey)
"""


def q_ordered_concat(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"),
                         "l_partkey", "left")
    return ordered_concat(li, ["l_orderkey"], ["l_linenumber", "l_partkey"],
                          {"part_names": "p_name"})


SQL_ORDERED_CONCAT = """
SELECT l_orderkey, nullif(string_agg(p_name, '; ' ORDER BY l_linenumber, l_partkey), '') AS part_names
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
GROUP BY l_orderkey
"""


def _ref_text():
    return F.concat(F.col("o_orderpriority"), F.lit(","),
                    F.dayofmonth("o_orderdate").cast("string"))


def q_two_key_lookup(spark, sf):
    t = Tables(spark, sf)
    rows = t.orders.select("o_orderkey", _ref_text().alias("ref_text"))
    lookup = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                               F.col("l_partkey").cast("string").alias("part_txt"),
                               "l_returnflag")
    return resolve_references(rows, "o_orderkey", "ref_text", lookup.withColumn(
        "l_linenumber", F.col("l_linenumber").cast("bigint")), "l_linenumber",
        {"line_parts": "part_txt", "line_flags": "l_returnflag"})


SQL_TWO_KEY_LOOKUP = r"""
WITH p AS (SELECT DISTINCT o_orderkey, o_orderpriority || ',' || CAST(day(o_orderdate) AS VARCHAR) AS ref_text
           FROM orders),
s AS (SELECT o_orderkey, ref_text, CAST(unnest(regexp_extract_all(ref_text, '\d+')) AS BIGINT) AS seq FROM p),
j AS (SELECT s.*, CAST(l.l_partkey AS VARCHAR) AS part_txt, l.l_returnflag
      FROM s LEFT JOIN lineitem l ON l.l_orderkey = s.o_orderkey AND l.l_linenumber = s.seq)
SELECT o_orderkey, ref_text,
       nullif(string_agg(part_txt, '; ' ORDER BY seq, part_txt, l_returnflag), '') AS line_parts,
       nullif(string_agg(l_returnflag, '; ' ORDER BY seq, part_txt, l_returnflag), '') AS line_flags
FROM j GROUP BY o_orderkey, ref_text
"""


def _replies(t: Tables):
    p = t.part
    hit = F.struct(F.col("p_name").alias("ticker"), F.col("p_type").alias("name"),
                   F.lit("Common Stock").alias("securityType"),
                   F.when(F.col("p_type") == "PROMO", "Equity").otherwise("Corp").alias("marketSector"),
                   F.col("p_brand").alias("exchCode"))
    pass1 = p.select(F.col("p_partkey").cast("string").alias("cusip"),
                     F.when(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"), hit).alias("hit"))
    pass2 = p.select(F.col("p_partkey").cast("string").alias("cusip"),
                     F.when(F.col("p_type").isin("PROMO", "SMALL"), hit).alias("hit"))
    return pass1, pass2


def q_tiered_lookup(spark, sf):
    t = Tables(spark, sf)
    todo = t.lineitem.select(F.col("l_partkey").cast("string").alias("cusip"))
    pass1, pass2 = _replies(t)
    return symbol_mapping(todo, pass1, pass2, "2024-01-02").select(
        "cusip", "ticker", "figi_ticker", "name", "market_sector", "exch_code", "mapped_at")


SQL_TIERED_LOOKUP = """
WITH todo AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS cusip FROM lineitem),
r AS (SELECT CAST(p_partkey AS VARCHAR) AS cusip, p_name, p_type, p_brand,
             p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS h1, p_type IN ('PROMO', 'SMALL') AS h2,
             CASE WHEN p_type = 'PROMO' THEN 'Equity' ELSE 'Corp' END AS sector FROM part)
SELECT t.cusip,
       CASE WHEN r.h1 THEN r.p_name WHEN r.h2 AND r.sector = 'Equity' THEN r.p_name END AS ticker,
       CASE WHEN r.h1 OR r.h2 THEN r.p_name END AS figi_ticker,
       CASE WHEN r.h1 OR r.h2 THEN r.p_type END AS name,
       CASE WHEN r.h1 OR r.h2 THEN r.sector END AS market_sector,
       CASE WHEN r.h1 OR r.h2 THEN r.p_brand END AS exch_code,
       '2024-01-02' AS mapped_at
FROM todo t LEFT JOIN r ON r.cusip = t.cusip
"""


def q_anti_unmapped(spark, sf):
    t = Tables(spark, sf)
    cache = t.part.where(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey"))
    held = t.lineitem.select("l_partkey").distinct()
    return held.join(cache, "l_partkey", "left_anti")


SQL_ANTI_UNMAPPED = """
SELECT DISTINCT l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)
"""


def q_merge_latest(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    cut = F.lit("1998-01-01").cast("date")
    old = keep_one(o.where(F.col("o_orderdate") < cut), ["o_custkey"], [F.col("o_orderkey")], first=False)
    new = keep_one(o.where(F.col("o_orderdate") >= cut), ["o_custkey"], [F.col("o_orderkey")], first=False)
    return merge_latest(old.drop("o_orderdate"), new.drop("o_orderdate"), ["o_custkey"])


SQL_MERGE_LATEST = """
WITH old AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1),
new AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderdate >= DATE '1998-01-01' GROUP BY 1),
m AS (SELECT o_custkey, coalesce(new.k, old.k) AS k FROM old FULL JOIN new USING (o_custkey))
SELECT m.o_custkey, o.o_orderkey, o.o_totalprice FROM m JOIN orders o ON o.o_orderkey = m.k
"""


def q_null_combo(spark, sf):
    t = Tables(spark, sf)
    keys = t.lineitem.select(F.col("l_partkey").alias("cusip")).distinct()
    side = t.part.where(F.col("p_size") > 10).select(
        F.col("p_partkey").alias("cusip"),
        F.when(F.col("p_type") == "PROMO", F.col("p_name")).alias("ticker"),
        F.col("p_type").alias("name"),
        F.when(F.col("p_size") > 30, F.col("p_brand")).alias("figi_ticker"))
    return keys.join(side, "cusip", "left").where(cache_still_valid())


SQL_NULL_COMBO = """
WITH k AS (SELECT DISTINCT l_partkey AS cusip FROM lineitem),
s AS (SELECT p_partkey AS cusip, CASE WHEN p_type = 'PROMO' THEN p_name END AS ticker, p_type AS name,
             CASE WHEN p_size > 30 THEN p_brand END AS figi_ticker FROM part WHERE p_size > 10)
SELECT k.cusip, s.ticker, s.name, s.figi_ticker FROM k LEFT JOIN s USING (cusip)
WHERE s.ticker IS NOT NULL OR s.name IS NULL OR s.figi_ticker IS NOT NULL
"""


def _revenue_by_part(t: Tables):
    return (t.lineitem.groupBy("l_partkey")
             .agg(F.round(F.coalesce(F.sum("l_extendedprice"), F.lit(0.0)), 2).alias("revenue")))


def q_rank_batches(spark, sf):
    t = Tables(spark, sf)
    ranked = global_rank(_revenue_by_part(t), [F.desc("revenue"), F.asc("l_partkey")], "rank")
    return ranked.withColumn("batch", batch_number(F.col("rank"), 100))


SQL_RANK_BATCHES = """
WITH r AS (SELECT l_partkey, round(coalesce(sum(l_extendedprice), 0), 2) AS revenue FROM lineitem GROUP BY 1)
SELECT l_partkey, revenue, row_number() OVER (ORDER BY revenue DESC, l_partkey) AS rank,
       (row_number() OVER (ORDER BY revenue DESC, l_partkey) - 1) // 100 AS batch
FROM r
"""


def q_top_unmapped(spark, sf):
    t = Tables(spark, sf)
    mapped = t.part.where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")).select(
        F.col("p_partkey").alias("l_partkey"))
    todo = _revenue_by_part(t).join(mapped, "l_partkey", "left_anti")
    return top_n(todo, [F.desc("revenue"), F.asc("l_partkey")], 50)


SQL_TOP_UNMAPPED = """
SELECT l_partkey, round(coalesce(sum(l_extendedprice), 0), 2) AS revenue FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3'))
GROUP BY 1 ORDER BY revenue DESC, l_partkey LIMIT 50
"""


def q_distinct_share(spark, sf):
    t = Tables(spark, sf)
    li = (t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey", "left")
           .withColumn("period", F.last_day(F.col("l_shipdate").cast("date"))))
    rep = share_report(li, ["period"], "l_orderkey", F.coalesce(F.col("p_size") <= 25, F.lit(False)),
                       "l_extendedprice")
    return rep.select("period", "n_rows", "n_entities", F.round("row_share", 6).alias("row_share"),
                      F.round("value_share", 6).alias("value_share"))


SQL_DISTINCT_SHARE = """
SELECT last_day(CAST(l_shipdate AS DATE)) AS period, count(*) AS n_rows,
       count(DISTINCT l_orderkey) AS n_entities,
       round(avg(CASE WHEN coalesce(p_size <= 25, false) THEN 1 ELSE 0 END), 6) AS row_share,
       round(coalesce(sum(l_extendedprice) FILTER (WHERE coalesce(p_size <= 25, false)), 0)
             / nullif(sum(l_extendedprice), 0), 6) AS value_share
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1
"""


def q_sorted_rank(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag")
    return global_rank(li, [F.asc("l_orderkey"), F.desc_nulls_first("l_extendedprice"),
                            F.asc("l_linenumber")], "pos")


SQL_SORTED_RANK = """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_returnflag,
       row_number() OVER (ORDER BY l_orderkey, l_extendedprice DESC NULLS FIRST, l_linenumber) AS pos
FROM lineitem
"""


def q_day_format_parse(spark, sf):
    t = Tables(spark, sf)
    d = F.col("o_orderdate").cast("date")
    q_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    return t.orders.select("o_orderkey", sec_date_text(d).alias("date_text"),
                           parse_sec_date(sec_date_text(d)).alias("parsed_date"),
                           (F.col("o_orderdate").cast("date") == q_end).alias("is_period_end"),
                           (sec_date_text(d) == sec_date_text(q_end)).alias("text_match"))


SQL_DAY_FORMAT_PARSE = """
SELECT o_orderkey, upper(strftime(o_orderdate, '%d-%b-%Y')) AS date_text,
       CAST(strptime(upper(strftime(o_orderdate, '%d-%b-%Y')), '%d-%b-%Y') AS DATE) AS parsed_date,
       CAST(o_orderdate AS DATE) = last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH) AS is_period_end,
       upper(strftime(o_orderdate, '%d-%b-%Y')) =
         upper(strftime(last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH), '%d-%b-%Y')) AS text_match
FROM orders
"""


def q_filing_window(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    span = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    periods = periods_with_windows(
        span.select(F.explode(quarter_ends(F.col("lo"), F.col("hi"))).alias("period")), earliest=None)
    counts = (o.groupBy(F.trunc("d", "MM").alias("month")).count()
               .join(window_months(periods), "month")
               .groupBy("period").agg(F.sum("count").alias("n_orders")))
    return (periods.join(counts, "period", "left")
                   .select("period", "window_start", "window_end", "archive_name",
                           F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders")))


SQL_FILING_WINDOW = """
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
p AS (SELECT CAST(last_day(CAST(q AS DATE) + INTERVAL 2 MONTH) AS DATE) AS period
      FROM span, generate_series(CAST(date_trunc('quarter', lo) AS TIMESTAMP), CAST(date_trunc('quarter', hi) AS TIMESTAMP), INTERVAL 3 MONTH) g(q)),
w AS (SELECT period, period + 1 AS window_start, last_day(period + INTERVAL 3 MONTH) AS window_end,
             CAST(year(period + 1) AS VARCHAR) || 'q' || CAST(quarter(period + 1) AS VARCHAR) || '_form13f.zip' AS archive_name
      FROM p)
SELECT period, window_start, CAST(window_end AS DATE) AS window_end, archive_name,
       CAST((SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN w.window_start AND w.window_end) AS BIGINT) AS n_orders
FROM w
"""


def q_filing_windows_later(spark, sf):
    """Periods 27 years on, where the archives change from receipt quarters over a transition file to three-month windows."""
    o = Tables(spark, sf).orders.select(F.add_months(F.col("o_orderdate").cast("date"), 12 * 27).alias("d"))
    span = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    periods = periods_with_windows(span.select(F.explode(quarter_ends(F.col("lo"), F.col("hi"))).alias("period")))
    counts = (o.groupBy(F.trunc("d", "MM").alias("month")).count().join(window_months(periods), "month")
               .groupBy("period").agg(F.sum("count").alias("n_orders")))
    return periods.join(counts, "period", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)).cast("bigint"))


SQL_FILING_WINDOWS_LATER = """
WITH o AS (SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 27 YEAR AS DATE) AS d FROM orders),
span AS (SELECT min(d) AS lo, max(d) AS hi FROM o),
p AS (SELECT CAST(last_day(CAST(q AS DATE) + INTERVAL 2 MONTH) AS DATE) AS period
      FROM span, generate_series(CAST(date_trunc('quarter', lo) AS TIMESTAMP), CAST(date_trunc('quarter', hi) AS TIMESTAMP), INTERVAL 3 MONTH) g(q)),
k AS (SELECT *, period <= DATE '2023-09-30' AS old, period = DATE '2023-12-31' AS trans, CAST(date_trunc('month', period) AS DATE) AS m FROM p),
w AS (SELECT period, old, trans, CASE WHEN old THEN CAST(period + 1 AS DATE) WHEN trans THEN DATE '2024-01-01' ELSE m END AS window_start,
             CAST(CASE WHEN old THEN last_day(period + INTERVAL 3 MONTH) WHEN trans THEN DATE '2024-02-29' ELSE last_day(m + INTERVAL 2 MONTH) END AS DATE) AS window_end FROM k)
SELECT period, window_start, window_end,
       CASE WHEN old THEN CAST(year(window_start) AS VARCHAR) || 'q' || CAST(quarter(window_start) AS VARCHAR)
            ELSE lower(strftime(window_start, '%d%b%Y')) || '-' || lower(strftime(window_end, '%d%b%Y')) END || '_form13f.zip' AS archive_name,
       CAST((SELECT count(*) FROM o WHERE d BETWEEN w.window_start AND w.window_end) AS BIGINT) AS n_orders
FROM w
"""


def q_missing_partitions(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
    wanted = (o.groupBy("o_orderpriority").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
               .select("o_orderpriority", F.explode(F.sequence("lo", "hi")).alias("day")))
    return missing_keys(wanted, o, ["o_orderpriority", "day"])


SQL_MISSING_PARTITIONS = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders),
w AS (SELECT o_orderpriority,
             CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
      FROM o GROUP BY o_orderpriority)
SELECT w.o_orderpriority, w.day FROM w
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.day = w.day AND o.o_orderpriority = w.o_orderpriority)
"""


QUERIES = {
    "effective_versions": (q_effective_versions, SQL_EFFECTIVE_VERSIONS),
    "effective_semi": (q_effective_semi, SQL_EFFECTIVE_SEMI),
    "ordered_concat": (q_ordered_concat, SQL_ORDERED_CONCAT),
    "two_key_lookup": (q_two_key_lookup, SQL_TWO_KEY_LOOKUP),
    "tiered_lookup": (q_tiered_lookup, SQL_TIERED_LOOKUP),
    "anti_unmapped": (q_anti_unmapped, SQL_ANTI_UNMAPPED),
    "merge_latest": (q_merge_latest, SQL_MERGE_LATEST),
    "null_combo": (q_null_combo, SQL_NULL_COMBO),
    "rank_batches": (q_rank_batches, SQL_RANK_BATCHES),
    "top_unmapped": (q_top_unmapped, SQL_TOP_UNMAPPED),
    "distinct_share": (q_distinct_share, SQL_DISTINCT_SHARE),
    "sorted_rank": (q_sorted_rank, SQL_SORTED_RANK),
    "day_format_parse": (q_day_format_parse, SQL_DAY_FORMAT_PARSE),
    "filing_window": (q_filing_window, SQL_FILING_WINDOW),
    "filing_windows_later": (q_filing_windows_later, SQL_FILING_WINDOWS_LATER),
    "missing_partitions": (q_missing_partitions, SQL_MISSING_PARTITIONS),
}
