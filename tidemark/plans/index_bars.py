"""Index day bars from several sources, clipped to a window, tagged and stacked."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.coverage import span_by_key

# Own index code -> source code.
SYMBOLS = [
    ("IC500", "sh000905"),
    ("IM1000", "sh000852"),
    ("IF300", "sh000300"),
]
YEARS_BACK = 10
BAR_COLUMNS = ["date", "sym", "open", "high", "low", "close", "volume"]


def symbol_table(spark: SparkSession, symbols=None) -> DataFrame:
    return spark.createDataFrame(symbols or SYMBOLS, "sym string, source_code string")


def window_start(end: Column, years: int = YEARS_BACK) -> Column:
    """Same calendar day ``years`` earlier (29 February clamps to the 28th)."""
    return F.add_months(end, -12 * years)


def index_bars(raw: DataFrame, symbols: DataFrame, start: Column | _dt.date,
               end: Column | _dt.date) -> DataFrame:
    """raw(source_code, date, open, high, low, close, volume) -> bars of the wanted symbols.

    The symbol table is the caller's: AQE measures it and broadcasts it where it is small.
    """
    s = F.lit(start) if isinstance(start, _dt.date) else start
    e = F.lit(end) if isinstance(end, _dt.date) else end
    return (raw.where(F.col("date").between(s, e))
               .join(symbols, "source_code")
               .select(*BAR_COLUMNS))


def coverage(bars: DataFrame) -> DataFrame:
    return span_by_key(bars, ["sym"], "date")
