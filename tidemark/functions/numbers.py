"""Number-to-text formatting with Python format-spec semantics.

``format_number`` rounds the exact binary value half-to-even, as Python's
``format`` does; ``format_string('%.1f')`` does not, so it is never used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c


def py_fixed(c: Column | str, decimals: int, sign: bool = False, grouping: bool = False) -> Column:
    """Equivalent of Python ``f"{x:[+][,].{decimals}f}"``; null stays null."""
    col = _c(c).cast("double")
    text = F.format_number(col, decimals)
    if not grouping:
        text = F.regexp_replace(text, ",", "")
    if sign:
        text = F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))
    return F.when(col.isNotNull(), text)


def pct_change(cur: Column | str, prior: Column | str) -> Column:
    """``(cur / prior - 1) * 100``; null when either side is null or prior is 0."""
    return (F.try_divide(_c(cur), _c(prior)) - 1) * 100


def join_parts(*parts: Column, sep: str = ", ") -> Column:
    """Join the non-null parts; null when every part is null."""
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))


def mean_cents(c: Column | str) -> Column:
    """Aggregate: mean of a money column, rounded half-up to whole cents.

    Computed on integer cents (sum and count are exact), so the result does
    not depend on summation order or on how a binary tie is rounded.
    """
    cents = F.sum(F.round(_c(c) * 100).cast("long"))
    n = F.count(_c(c))
    q = F.floor(cents / n).cast("long")
    r = cents - q * n
    return ((q + F.when(2 * r >= n, 1).otherwise(0)) / 100.0).alias("mean")
