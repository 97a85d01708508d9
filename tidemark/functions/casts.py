"""Lenient numeric parsing with the source's rules.

Spark's ``try_cast`` trims blanks and accepts suffixes such as ``'12d'`` or
words such as ``'NaN'`` for doubles; the source parser does not. Every
helper here guards the text with a numeric pattern first, so only plain
decimal text converts and everything else becomes null (never an error).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c, strip_chars

INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def try_long(c: Column | str) -> Column:
    """Integer text -> bigint; anything else (``'1.5'``, ``' 12 '``, ``''``) -> null."""
    col = _c(c)
    return F.when(col.rlike(INT_TEXT), col.try_cast("bigint"))


def try_double(c: Column | str) -> Column:
    """Decimal / exponent text -> double; anything else -> null."""
    col = _c(c)
    return F.when(col.rlike(FLOAT_TEXT), col.try_cast("double"))


def double_to_long_rounded(c: Column | str) -> Column:
    """Round half-to-even to an integer; out-of-range or NaN -> null."""
    return F.bround(_c(c), 0).try_cast("bigint")


def double_to_long_truncated(c: Column | str) -> Column:
    """Drop the fraction; out-of-range or NaN -> null."""
    return _c(c).try_cast("bigint")


def text_to_long_rounded(c: Column | str) -> Column:
    """``"12.4"`` -> 12, ``"2.5"`` -> 2, ``"1e30"`` -> null, ``""``/``"x"`` -> null."""
    return double_to_long_rounded(try_double(c))


def text_to_long_truncated(c: Column | str) -> Column:
    return double_to_long_truncated(try_double(c))


def typed_column(name: str, dtype: str) -> Column:
    """Blank-or-null -> null, otherwise the stripped text parsed as ``dtype``.

    ``dtype`` is ``"double"`` or ``"bigint"``; the result keeps ``name``.
    """
    c = F.col(f"`{name}`")
    s = strip_chars(c)
    parsed = try_double(s) if dtype == "double" else try_long(s)
    return F.when(c.isNull() | (s == ""), F.lit(None).cast(dtype)).otherwise(parsed).alias(name)
