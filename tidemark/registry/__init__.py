"""Driver queries: each operator of the inventory applied to the driver tables.

Every module exposes ``QUERIES: dict[name, (spark_fn, oracle_sql | None)]``;
``spark_fn(spark, sf_dir) -> DataFrame`` reads whole tables only.
"""

from __future__ import annotations

from importlib import import_module

_MODULES = ["holdings_q", "joins_q", "reconcile_q", "text_q", "timeseries_q", "calendar_q", "io_q", "build_q", "summary_q", "landed_q"]


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        mod = import_module(f"{__name__}.{m}")
        for k, v in mod.QUERIES.items():
            if k in out:
                raise ValueError(f"duplicate query {k}")
            out[k] = v
    return out
