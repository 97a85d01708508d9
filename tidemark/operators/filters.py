"""Row filters used by the dataset builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import contains_all_none, strip_chars


def line_filter(df: DataFrame, include: Sequence[str], exclude: Sequence[str],
                cols: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Keep rows whose whole line (``cols`` joined by ``sep``) contains every
    ``include`` and no ``exclude`` substring (case-sensitive)."""
    cols = list(cols or df.columns)
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return df.where(contains_all_none(line, list(include), list(exclude)))


def stripped_in(col: str, values: Sequence[str]) -> Column:
    return strip_chars(F.col(col)).isin(*values)


def cache_still_valid(ticker: str = "ticker", name: str = "name",
                      figi_ticker: str = "figi_ticker") -> Column:
    """Cached mapping rows worth keeping: a ticker, or a remembered miss (no name),
    or a kept raw ticker. Rows with a name but neither ticker are asked again."""
    return F.col(ticker).isNotNull() | F.col(name).isNull() | F.col(figi_ticker).isNotNull()


def closed_window(col: str, start: Column, end: Column) -> Column:
    return F.col(col).between(start, end)
