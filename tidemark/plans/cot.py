"""Weekly trader-position (COT) reports: line filter, name-driven typing,
monthly studies."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import typed_column
from ..functions.dates import month_floor_ntz
from ..operators.asof import asof_backward
from ..operators.filters import line_filter

# The report's descriptive (non-numeric) columns, and the name
# fragments that mark a numeric column as floating point.
TEXT_COLUMNS = {
    "Report_Date_as_YYYY-MM-DD",
    "Market_and_Exchange_Names",
    "CFTC_Contract_Market_Code",
    "CFTC_Market_Code",
    "CFTC_Commodity_Code",
    "Contract_Units",
    "CFTC_Contract_Market_Code_Quotes",
    "CFTC_Market_Code_Quotes",
    "CFTC_Commodity_Code_Quotes",
    "CFTC_SubGroup_Code",
    "FutOnly_or_Combined",
}
FLOAT_COLUMN_KEYWORDS = ("Pct", "Conc_")
# The contract of the study, the word that marks another one, and the columns of day and market.
SEARCH_TERM = "E-MINI S&P 500"
EXCLUDE_TERM = "MICRO"
DATE_COLUMN = "Report_Date_as_YYYY-MM-DD"
MARKET_COLUMN = "Market_and_Exchange_Names"


def cot_filter(raw: DataFrame, include: Sequence[str] = (SEARCH_TERM,),
               exclude: Sequence[str] = (EXCLUDE_TERM,)) -> DataFrame:
    """Rows of all yearly files whose whole line has the contract name and not
    the excluded word (case-sensitive)."""
    return line_filter(raw, include, exclude)


def numeric_dtype(name: str) -> str | None:
    if name in TEXT_COLUMNS:
        return None
    return "double" if any(k in name for k in FLOAT_COLUMN_KEYWORDS) else "bigint"


def cot_typed(rows: DataFrame, string_columns: Sequence[str] | None = None) -> DataFrame:
    """Type every string column by its name in one projection, then add
    ``date``, ``time`` (timestamp_ntz) and ``sym``.

    Only columns that are strings are typed (``string_columns`` defaults to
    the string columns of ``rows``); blank text becomes null.
    """
    if string_columns is None:
        string_columns = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    strs = set(string_columns)
    cols = []
    for name in rows.columns:
        dt = numeric_dtype(name) if name in strs else None
        cols.append(typed_column(name, dt) if dt else F.col(f"`{name}`"))
    typed = rows.select(*cols)
    d = F.try_to_date(F.substring(F.col(f"`{DATE_COLUMN}`"), 1, 10), "yyyy-MM-dd")
    return typed.select("*", d.alias("date"), d.cast("timestamp_ntz").alias("time"),
                        F.col(f"`{MARKET_COLUMN}`").alias("sym"))


def cot_monthly(cot: DataFrame, value: str, by_sym: bool = False) -> DataFrame:
    """Mean of ``value`` per truncated month (and per sym), sorted."""
    keys = (["sym"] if by_sym else []) + [month_floor_ntz(F.col("time")).alias("time")]
    out = cot.groupBy(*keys).agg(F.avg(f"`{value}`").alias(value))
    return out.orderBy(*(["sym"] if by_sym else []), "time")


def add_price(rows: DataFrame, prices: DataFrame, price: str = "close", symbols: DataFrame | None = None, days_back: int | None = None) -> DataFrame:
    """``rows`` (date, sym, ...) with ``price`` of ``prices`` (date, sym, price; one row for each date and sym).

    ``symbols`` (sym, price_sym) names the symbol that a row's price goes by; a row whose
    symbol it lacks has no price. Only the price of the same day counts, or with ``days_back`` the last one of that day or at most so many days before.
    """
    own = rows.columns
    if symbols is None:
        rows = rows.withColumn("price_sym", F.col("sym"))
    else:
        rows = rows.join(symbols.select("sym", "price_sym"), "sym", "left")
    prices = prices.select(F.col("sym").alias("price_sym"), F.col("date").alias("price_date"), price)
    if days_back is None:
        same = (rows["price_sym"] == prices["price_sym"]) & (rows["date"] == prices["price_date"])
        return rows.join(prices, same, "left").select(*[rows[c] for c in own], price)
    found = asof_backward(rows, prices, ["price_sym"], "date", "price_date", _dt.timedelta(days=days_back), [price], "found_")
    return found.select(*own, F.col(f"found_{price}").alias(price))
