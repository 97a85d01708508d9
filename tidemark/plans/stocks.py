"""US stock day / minute bars enriched with splits, dividends and ticker types.

Many trade dates are handled in one plan: every side table carries its own
date (execution date for splits, ex-dividend date for dividends) and joins
on (date, ticker). Ticker types are current values applied to every date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import file_date, read_csv_typed
from ..sources.schemas import DIVIDENDS_JSON, SPLITS_JSON, TICKER_PAGES_JSON, TICKER_TYPES_JSON
from ..sources.sinks import write_partitioned


def read_day_bars(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Gzip CSV day files (``.../YYYY/MM/YYYY-MM-DD.csv.gz``) with the date from the file name.

    ``ddl`` is the explicit schema; ``volume`` should be declared ``double``.
    Gzip files are not splittable: parallelism is one task per file.
    """
    return read_csv_typed(spark, path, ddl).withColumn("date", file_date())


def read_minute_bars(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return read_csv_typed(spark, path, ddl).withColumn("date", file_date())


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, date, split_from, split_to) from landed JSON replies."""
    raw = spark.read.schema(SPLITS_JSON).json(path)
    r = raw.select(F.explode("results").alias("r")).select("r.*")
    return r.select("ticker", F.col("execution_date").alias("date"), "split_from", "split_to")


def read_dividends(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(DIVIDENDS_JSON).json(path)
    r = raw.select(F.explode("results").alias("r")).select("r.*")
    return r.select("ticker", F.col("ex_dividend_date").alias("date"), "cash_amount")


def read_tickers(spark: SparkSession, pages_path: str, types_path: str) -> DataFrame:
    """(ticker, type, type_desc); a missing type or description is ``""``."""
    pages = spark.read.schema(TICKER_PAGES_JSON).json(pages_path)
    types = spark.read.schema(TICKER_TYPES_JSON).json(types_path)
    t = pages.select(F.explode("results").alias("r")).select("r.ticker", "r.type")
    codes = types.select(F.explode("results").alias("r")).select(
        F.col("r.code").alias("type"), F.col("r.description").alias("type_desc"))
    return ticker_table(t, codes)


def ticker_table(tickers: DataFrame, codes: DataFrame) -> DataFrame:
    t = tickers.select("ticker", F.coalesce(F.col("type"), F.lit("")).alias("type"))
    return (t.join(codes.select("type", "type_desc"), "type", "left")
             .select("ticker", "type", F.coalesce(F.col("type_desc"), F.lit("")).alias("type_desc")))


def split_ratio(splits: DataFrame) -> DataFrame:
    """(date, ticker, split = split_to / split_from); 0 denominators give null."""
    return splits.select("date", "ticker",
                         F.try_divide(F.col("split_to"), F.col("split_from")).alias("split"))


def dividend_sum(dividends: DataFrame) -> DataFrame:
    return dividends.groupBy("date", "ticker").agg(F.sum("cash_amount").alias("dividend"))


def stock_day(bars: DataFrame, splits: DataFrame, dividends: DataFrame,
              tickers: DataFrame) -> DataFrame:
    """Bars + split + dividend + type + type_desc.

    Splits are not de-duplicated (two splits of a ticker on a day give two
    rows); dividends are summed per (date, ticker). An empty side table just
    yields nulls. Side tables are joined without static hints: AQE turns a
    join into a broadcast when the measured side is small.
    """
    out = (bars.join(split_ratio(splits), ["date", "ticker"], "left")
               .join(dividend_sum(dividends), ["date", "ticker"], "left")
               .join(tickers.select("ticker", "type", "type_desc"), "ticker", "left"))
    return out


def stock_min1(spark: SparkSession, path: str, ddl: str, out: str, time_columns: Sequence[str] = ("window_start",)) -> None:
    """Minute bars of many day files to one table partitioned by date, each file by ticker and time; a day is overwritten as a whole."""
    write_partitioned(read_minute_bars(spark, path, ddl), out, ["date"], [F.col("ticker"), *map(F.col, time_columns)])
