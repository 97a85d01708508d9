"""String helpers that reproduce the source semantics with built-in Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space, which is what the source's strip uses.
WS_CHARS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chars(c: Column | str) -> Column:
    """Strip leading/trailing whitespace (tabs and newlines too, unlike ``trim``)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def blank_to_null(c: Column | str) -> Column:
    """``""`` becomes null; other values unchanged."""
    return F.nullif(_c(c), F.lit(""))


def strip_to_null(c: Column | str) -> Column:
    """Strip, then turn the empty string into null."""
    return blank_to_null(strip_chars(c))


def digit_runs(c: Column | str) -> Column:
    """All runs of decimal digits, as an array of strings (null input -> null)."""
    return F.regexp_extract_all(_c(c), F.lit(r"\d+"), F.lit(0))


def extract_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First regex match group, null when the pattern does not match."""
    col = _c(c)
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def issuer_symbol(figi_ticker: Column | str) -> Column:
    """Leading equity symbol of a bond/preferred ticker: ``"BABA 0.5 06/01/31"`` -> ``BABA``.

    The symbol must be followed by whitespace; a bare ``"AAPL"`` gives null.
    """
    return extract_or_null(figi_ticker, r"^([A-Z][A-Z0-9./]*)\s", 1)


def underlying_symbol(ticker: Column | str, figi_ticker: Column | str,
                      market_sector: Column | str) -> Column:
    """``sym_und``: the equity ticker, else the issuer prefix for Corp/Pfd securities."""
    return F.coalesce(
        _c(ticker),
        F.when(_c(market_sector).isin("Corp", "Pfd"), issuer_symbol(figi_ticker)),
    )


def id_type(identifier: Column | str) -> Column:
    """Letter-prefixed identifiers are CINS, others CUSIP."""
    return F.when(_c(identifier).rlike("^[A-Za-z]"), F.lit("ID_CINS")).otherwise(F.lit("ID_CUSIP"))


def contains_all_none(c: Column | str, include: list[str], exclude: list[str]) -> Column:
    """Case-sensitive: every ``include`` substring present and no ``exclude`` substring."""
    col = _c(c)
    cond = F.lit(True)
    for s in include:
        cond = cond & col.contains(s)
    for s in exclude:
        cond = cond & ~col.contains(s)
    return cond
