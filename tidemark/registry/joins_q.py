"""Enrichment joins (splits, dividends, types, code tables, prices) on the driver tables.

Stand-ins: ``lineitem`` rows are day bars (ticker = part key, date = ship
date); returned-and-finished lines are "splits", accepted lines pay a
"dividend", ``part`` carries the ticker types.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keep_one
from ..plans.stocks import stock_day, ticker_table
from .base import Tables

# Code table for the stand-in ticker types.
TYPE_CODES = [
    ("ECONOMY", "Economy line"),
    ("STANDARD", "Standard line"),
    ("PROMO", "Promotional line"),
    ("MEDIUM", "Medium line"),
]
RETURN_FLAG_TEXT = [("A", "accepted"), ("N", "none"), ("R", "returned")]


def _bars(t: Tables):
    return t.lineitem.select(F.col("l_partkey").cast("string").alias("ticker"),
                             F.col("l_shipdate").cast("date").alias("date"),
                             "l_orderkey", "l_linenumber",
                             F.col("l_quantity").alias("volume"),
                             F.col("l_extendedprice").alias("close"))


def _splits(t: Tables):
    li = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    return li.select(F.col("l_partkey").cast("string").alias("ticker"),
                     F.col("l_shipdate").cast("date").alias("date"),
                     F.col("l_tax").alias("split_from"), F.col("l_quantity").alias("split_to"))


def _dividends(t: Tables):
    li = t.lineitem.where(F.col("l_returnflag") == "A")
    return li.select(F.col("l_partkey").cast("string").alias("ticker"),
                     F.col("l_shipdate").cast("date").alias("date"),
                     F.col("l_discount").alias("cash_amount"))


def _tickers(spark, t: Tables):
    tk = t.part.select(F.col("p_partkey").cast("string").alias("ticker"),
                       F.when(F.col("p_size") > 5, F.col("p_type")).alias("type"))
    codes = spark.createDataFrame(TYPE_CODES, "type string, type_desc string")
    return ticker_table(tk, codes)


def q_stock_day(spark, sf):
    t = Tables(spark, sf)
    out = stock_day(_bars(t), _splits(t), _dividends(t), _tickers(spark, t))
    return out.select("date", "ticker", "l_orderkey", "l_linenumber", "volume", "close",
                      F.round("split", 6).alias("split"), F.round("dividend", 6).alias("dividend"),
                      "type", "type_desc")


SQL_STOCK_DAY = """
WITH bars AS (SELECT CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date, l_orderkey,
                     l_linenumber, l_quantity AS volume, l_extendedprice AS close FROM lineitem),
splits AS (SELECT CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
                  CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity / l_tax END AS split
           FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
divs AS (SELECT CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date, sum(l_discount) AS dividend
         FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
codes(type, type_desc) AS (VALUES ('ECONOMY', 'Economy line'), ('STANDARD', 'Standard line'),
                                  ('PROMO', 'Promotional line'), ('MEDIUM', 'Medium line')),
tk AS (SELECT CAST(p_partkey AS VARCHAR) AS ticker, coalesce(CASE WHEN p_size > 5 THEN p_type END, '') AS type FROM part),
tickers AS (SELECT tk.ticker, tk.type, coalesce(codes.type_desc, '') AS type_desc FROM tk LEFT JOIN codes USING (type))
SELECT b.date, b.ticker, b.l_orderkey, b.l_linenumber, b.volume, b.close, round(s.split, 6) AS split,
       round(d.dividend, 6) AS dividend, tickers.type, tickers.type_desc
FROM bars b LEFT JOIN splits s ON s.ticker = b.ticker AND s.date = b.date
LEFT JOIN divs d ON d.ticker = b.ticker AND d.date = b.date
LEFT JOIN tickers ON tickers.ticker = b.ticker
"""


def q_enrich_left_fanout(spark, sf):
    """Bars joined to splits that are not de-duplicated: two splits, two rows."""
    t = Tables(spark, sf)
    from ..plans.stocks import split_ratio
    return (_bars(t).join(split_ratio(_splits(t)), ["date", "ticker"], "left")
                   .select("date", "ticker", "l_orderkey", "l_linenumber", F.round("split", 6).alias("split")))


SQL_ENRICH_LEFT_FANOUT = """
WITH splits AS (SELECT CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
                       CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity / l_tax END AS split
                FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_partkey AS VARCHAR) AS ticker, l_orderkey, l_linenumber,
       round(s.split, 6) AS split
FROM lineitem LEFT JOIN splits s ON s.ticker = CAST(l_partkey AS VARCHAR) AND s.date = CAST(l_shipdate AS DATE)
"""


def q_sum_then_left(spark, sf):
    t = Tables(spark, sf)
    daily = (t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"),
                                F.col("l_shipdate").cast("date").alias("day"))
              .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue")))
    return t.part.select("p_partkey", "p_name").join(daily, "p_partkey", "left")


SQL_SUM_THEN_LEFT = """
WITH daily AS (SELECT l_partkey AS p_partkey, CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS revenue
               FROM lineitem GROUP BY 1, 2)
SELECT p.p_partkey, p.p_name, d.day, d.revenue FROM part p LEFT JOIN daily d USING (p_partkey)
"""


def q_derived_ratio(spark, sf):
    t = Tables(spark, sf)
    return t.part.select("p_partkey", F.round(F.try_divide(F.col("p_retailprice"), F.col("p_size")), 6)
                         .alias("ratio"))


SQL_DERIVED_RATIO = """
SELECT p_partkey, round(CASE WHEN p_size = 0 THEN NULL ELSE p_retailprice / p_size END, 6) AS ratio FROM part
"""


def q_broadcast_map(spark, sf):
    t = Tables(spark, sf)
    codes = spark.createDataFrame(RETURN_FLAG_TEXT, "l_returnflag string, flag_text string")
    # a code table of three rows: broadcast is bounded by construction
    return (t.lineitem.join(F.broadcast(codes), "l_returnflag", "left")
             .select("l_orderkey", "l_linenumber", "l_returnflag", "flag_text"))


SQL_BROADCAST_MAP = """
WITH codes(l_returnflag, flag_text) AS (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned'))
SELECT l_orderkey, l_linenumber, l_returnflag, flag_text FROM lineitem LEFT JOIN codes USING (l_returnflag)
"""


def q_price_enrich(spark, sf):
    """Report rows joined to the day's price (the last line shipped that day)."""
    t = Tables(spark, sf)
    px = (t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day"))
           .agg(F.max_by("l_extendedprice", F.struct("l_orderkey", "l_linenumber", "l_extendedprice"))
                .alias("close")))
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return o.join(px, "day", "left").select("o_orderkey", "day", "close")


SQL_PRICE_ENRICH = """
WITH px AS (SELECT CAST(l_shipdate AS DATE) AS day,
                   arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS close
            FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, px.close
FROM orders LEFT JOIN px ON px.day = CAST(o_orderdate AS DATE)
"""


def q_keep_first_feed(spark, sf):
    """Two feeds of the same records; per (order, line) the first feed seen wins."""
    t = Tables(spark, sf)
    cols = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    announced = t.lineitem.where(F.col("l_linestatus") == "O").select(*cols).withColumn("feed", F.lit("announced")) \
        .withColumn("feed_rank", F.lit(0))
    results = t.lineitem.where(F.col("l_returnflag") != "N").select(*cols).withColumn("feed", F.lit("auctioned")) \
        .withColumn("feed_rank", F.lit(1))
    both = announced.unionByName(results)
    return keep_one(both, ["l_orderkey", "l_linenumber"], [F.col("feed_rank")]).drop("feed_rank")


SQL_KEEP_FIRST_FEED = """
WITH u AS (SELECT l_orderkey, l_linenumber, l_extendedprice, 'announced' AS feed, 0 AS feed_rank
           FROM lineitem WHERE l_linestatus = 'O'
           UNION ALL
           SELECT l_orderkey, l_linenumber, l_extendedprice, 'auctioned', 1 FROM lineitem WHERE l_returnflag <> 'N'),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY feed_rank, l_extendedprice, feed) AS rn FROM u)
SELECT l_orderkey, l_linenumber, l_extendedprice, feed FROM r WHERE rn = 1
"""


QUERIES = {
    "stock_day": (q_stock_day, SQL_STOCK_DAY),
    "enrich_left_fanout": (q_enrich_left_fanout, SQL_ENRICH_LEFT_FANOUT),
    "sum_then_left": (q_sum_then_left, SQL_SUM_THEN_LEFT),
    "derived_ratio": (q_derived_ratio, SQL_DERIVED_RATIO),
    "broadcast_map": (q_broadcast_map, SQL_BROADCAST_MAP),
    "price_enrich": (q_price_enrich, SQL_PRICE_ENRICH),
    "keep_first_feed": (q_keep_first_feed, SQL_KEEP_FIRST_FEED),
}
