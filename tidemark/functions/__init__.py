"""Column-level helpers (strings, casts, dates, number text)."""

from .casts import (double_to_long_rounded, double_to_long_truncated, text_to_long_rounded,
                    text_to_long_truncated, try_double, try_long, typed_column)
from .dates import (last_weekday, month_label, month_start, nth_weekday, parse_iso_prefix,
                    parse_sec_date, prev_month_label, sec_date_text, wall_clock, wall_clock_utc)
from .numbers import join_parts, pct_change, py_fixed
from .strings import (blank_to_null, contains_all_none, digit_runs, extract_or_null, id_type,
                      issuer_symbol, strip_chars, strip_to_null, underlying_symbol)

__all__ = [n for n in dir() if not n.startswith("_")]
