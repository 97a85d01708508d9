"""Readers on files landed from the driver tables, one query for each shape of payload."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.cot import add_price, cot_monthly, cot_typed
from ..plans.mapping import symbol_mapping
from ..plans.stocks import read_day_bars, read_dividends, read_splits, read_tickers, stock_day, stock_min1
from ..sources.readers import read_figi_replies
from .base import Tables
from .holdings_q import SQL_TIERED_LOOKUP, _replies
from .io_q import _stage


def _land(rows, place: str, item) -> str:
    """A reply of one result for each row."""
    rows.select(F.array(item).alias("results")).write.json(place)
    return place


def _ticker(key: str):
    return F.concat(F.lit("T"), F.col(key))


def _land_bars(orders, place: str) -> str:
    bars = orders.select(_ticker("o_custkey").alias("ticker"), F.floor("o_totalprice").alias("volume"), F.col("o_orderkey").alias("transactions"),
                         F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "MM"), "yyyy-MM-dd").alias("day"))
    bars.hint("rebalance", "day").write.partitionBy("day").option("header", True).option("compression", "gzip").csv(place)
    return f"{place}/day=*/*.csv.gz"


def q_landed_stocks(spark, sf):
    """Day bars from gzip files dated by their path, with splits, dividends and ticker types from landed replies."""
    t = Tables(spark, sf)
    base = _stage(spark)
    bars = read_day_bars(spark, _land_bars(t.orders, f"{base}/bars"), "ticker string, volume double, transactions long")
    li = t.lineitem.withColumn("month", F.trunc(F.col("l_shipdate").cast("date"), "MM")).withColumn("ticker", _ticker("l_partkey"))
    splits = _land(li.where("l_returnflag = 'R' AND l_linenumber = 1"), f"{base}/splits", F.struct(
        "ticker", F.col("month").alias("execution_date"), F.dayofmonth("l_shipdate").alias("split_to"), (F.dayofmonth("l_shipdate") % 3).alias("split_from")))
    dividends = _land(li.where("l_returnflag = 'A' AND l_linenumber < 4"), f"{base}/dividends", F.struct(
        "ticker", F.col("month").alias("ex_dividend_date"), F.floor("l_quantity").alias("cash_amount")))
    kind = F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment"))
    pages = _land(t.customer, f"{base}/tickers", F.struct(_ticker("c_custkey").alias("ticker"), kind.alias("type")))
    types = t.customer.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("code")).distinct()
    types = _land(types, f"{base}/types", F.struct("code", F.initcap("code").alias("description")))
    return stock_day(bars, read_splits(spark, splits), read_dividends(spark, dividends), read_tickers(spark, pages, types))


SQL_LANDED_STOCKS = """
WITH b AS (SELECT 'T' || o_custkey AS ticker, CAST(floor(o_totalprice) AS DOUBLE) AS volume, o_orderkey AS transactions,
                  CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders),
li AS (SELECT *, 'T' || l_partkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem),
s AS (SELECT ticker, date, CAST(day(l_shipdate) AS DOUBLE) / nullif(day(l_shipdate) % 3, 0) AS split FROM li WHERE l_returnflag = 'R' AND l_linenumber = 1),
d AS (SELECT ticker, date, CAST(sum(floor(l_quantity)) AS DOUBLE) AS dividend FROM li WHERE l_returnflag = 'A' AND l_linenumber < 4 GROUP BY 1, 2),
k AS (SELECT 'T' || c_custkey AS ticker, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment ELSE '' END AS type,
             CASE WHEN c_custkey % 5 > 0 AND c_mktsegment <> 'MACHINERY' THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) ELSE '' END AS type_desc FROM customer)
SELECT b.ticker, b.volume, b.transactions, b.date, s.split, d.dividend, k.type, k.type_desc
FROM b LEFT JOIN s USING (ticker, date) LEFT JOIN d USING (ticker, date) LEFT JOIN k USING (ticker)
"""


def q_landed_minutes(spark, sf):
    """Minute bars from landed files to date partitions, read back by file: first and last row of a day, and its volume."""
    t = Tables(spark, sf)
    base = _stage(spark)
    out = f"{base}/out"
    stock_min1(spark, _land_bars(t.orders, f"{base}/bars"), "ticker string, volume double, transactions long", out, ["transactions"])
    rows = spark.read.parquet(out).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    # rows of a file stand in order
    files = rows.groupBy("date", "file").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"),
                                             F.min_by("ticker", "row").alias("first"), F.max_by("ticker", "row").alias("last"),
                                             F.min("ticker").alias("least"), F.max("ticker").alias("most"))
    ordered = F.bool_and((F.col("first") == F.col("least")) & (F.col("last") == F.col("most")))
    return files.groupBy("date").agg(F.sum("n").alias("n"), F.sum("volume").alias("volume"), ordered.alias("in_order"))


SQL_LANDED_MINUTES = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, count(*) AS n, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS volume, true AS in_order
FROM orders GROUP BY 1
"""


def q_landed_mapping(spark, sf):
    """Identifier lookup replies landed as JSON, read back and mapped in tiers."""
    t = Tables(spark, sf)
    place = f"{_stage(spark)}/replies"
    for number, replies in enumerate(_replies(t), 1):
        data = F.when(F.col("hit").isNotNull(), F.array("hit"))
        replies.select("cusip", F.lit(number).alias("pass_no"), data.alias("data")).write.mode("append").json(place)
    back = read_figi_replies(spark, place)
    todo = t.lineitem.select(F.col("l_partkey").cast("string").alias("cusip"))
    return symbol_mapping(todo, back.where("pass_no = 1"), back.where("pass_no = 2"), "2024-01-02").select(
        "cusip", "ticker", "figi_ticker", "name", "market_sector", "exch_code", "mapped_at")


def _report(t: Tables):
    """Orders as weekly report rows."""
    return cot_typed(t.orders.select(F.col("o_orderpriority").alias("Market_and_Exchange_Names"),
                                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("Report_Date_as_YYYY-MM-DD"), F.col("o_custkey").cast("string").alias("Open_Interest_All")))


def q_report_monthly(spark, sf):
    """Monthly means of the typed report, for each contract."""
    out = cot_monthly(_report(Tables(spark, sf)), "Open_Interest_All", by_sym=True)
    return out.withColumn("Open_Interest_All", F.round("Open_Interest_All", 6))


SQL_REPORT_MONTHLY = """
SELECT o_orderpriority AS sym, date_trunc('month', CAST(o_orderdate AS TIMESTAMP)) AS time, round(avg(o_custkey), 6) AS "Open_Interest_All" FROM orders GROUP BY 1, 2
"""


def _report_prices(t: Tables):
    """A price for each priority on the days whose number is no multiple of three."""
    day = F.col("o_orderdate").cast("date")
    return (t.orders.where(F.dayofmonth(day) % 3 != 0).groupBy(F.substring("o_orderpriority", 1, 1).alias("sym"), day.alias("date"))
             .agg(F.max("o_totalprice").alias("close")))


def q_report_prices(spark, sf):
    """The report with the price of its day and contract, and with the last price of at most five days before."""
    t = Tables(spark, sf)
    symbols = t.orders.select("o_orderpriority").distinct().select(F.col("o_orderpriority").alias("sym"), F.substring("o_orderpriority", 1, 1).alias("price_sym"))
    rows = _report(t).select("date", "sym", "Open_Interest_All")
    exact = add_price(rows, _report_prices(t), symbols=symbols)
    return add_price(exact.withColumnRenamed("close", "close_same_day"), _report_prices(t), symbols=symbols, days_back=5)


SQL_REPORT_PRICES = """
WITH px AS (SELECT left(o_orderpriority, 1) AS sym, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS close FROM orders WHERE day(o_orderdate) % 3 <> 0 GROUP BY 1, 2),
o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS sym, left(o_orderpriority, 1) AS k, o_custkey AS "Open_Interest_All" FROM orders),
a AS (SELECT o.*, CASE WHEN px.date >= o.date - 5 THEN px.close END AS close FROM o ASOF LEFT JOIN px ON px.sym = o.k AND o.date >= px.date)
SELECT a.date, a.sym, "Open_Interest_All", px.close AS close_same_day, a.close FROM a LEFT JOIN px ON px.sym = a.k AND px.date = a.date
"""


QUERIES = {
    "landed_stocks": (q_landed_stocks, SQL_LANDED_STOCKS),
    "landed_minutes": (q_landed_minutes, SQL_LANDED_MINUTES),
    "landed_mapping": (q_landed_mapping, SQL_TIERED_LOOKUP),
    "report_monthly": (q_report_monthly, SQL_REPORT_MONTHLY),
    "report_prices": (q_report_prices, SQL_REPORT_PRICES),
}
