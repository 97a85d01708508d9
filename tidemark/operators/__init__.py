"""Generic DataFrame operators (skew-aware; no key-wide windows on data tables)."""

from .asof import asof_backward
from .concat import ordered_concat, resolve_references
from .coverage import share_report, span_by_key
from .dedup import keep_one, merge_latest
from .filters import cache_still_valid, closed_window, line_filter, stripped_in
from .lookup import exact_change, value_at, value_months_back
from .ranking import batch_number, global_rank, top_n
from .reconcile import mismatches, one_sided, reconcile, reconcile_stats
from .versions import effective_versions

__all__ = [n for n in dir() if not n.startswith("_")]
