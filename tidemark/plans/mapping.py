"""Security identifier -> symbol mapping in tiers, with a remembered cache.

Inputs are landed lookup replies, one row per (identifier, pass) with the
first element of the reply's ``data`` list as ``hit`` (null = no match):

* pass 1 (US composite listing): a hit gives its ticker;
* pass 2 (any listing, asked only for pass-1 misses): a hit gives the
  ticker only when the market sector is ``Equity``; ``figi_ticker`` always
  keeps the raw ticker;
* identifiers missed by both passes get an all-null record, so they are
  not asked again.

All steps are joins on the identifier (anti joins for "not yet mapped" and
"pass-1 misses"), so the plan scales with the number of identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import id_type, underlying_symbol
from ..operators.dedup import merge_latest
from ..operators.filters import cache_still_valid
from ..operators.ranking import batch_number, global_rank

CACHE_COLUMNS = ["cusip", "ticker", "figi_ticker", "name", "security_type", "market_sector",
                 "exch_code", "mapped_at"]


def live_cache(cache: DataFrame) -> DataFrame:
    """Cache rows still trusted (old caches without ``figi_ticker`` migrate it from ``ticker``)."""
    if "figi_ticker" not in cache.columns:
        cache = cache.withColumn("figi_ticker", F.col("ticker"))
    return cache.where(cache_still_valid()).select(*CACHE_COLUMNS)


def _from_hit(df: DataFrame, ticker: Column, mapped_at: Column) -> DataFrame:
    h = F.col("hit")
    return df.select(
        "cusip", ticker.alias("ticker"), h["ticker"].alias("figi_ticker"), h["name"].alias("name"),
        h["securityType"].alias("security_type"), h["marketSector"].alias("market_sector"),
        h["exchCode"].alias("exch_code"), mapped_at.alias("mapped_at"))


def symbol_mapping(todo: DataFrame, pass1: DataFrame, pass2: DataFrame,
                   mapped_at: Column | str) -> DataFrame:
    """New cache records for the identifiers in ``todo`` (column ``cusip``).

    ``pass1``/``pass2``: ``cusip`` and ``hit`` struct<ticker,name,securityType,
    marketSector,exchCode> (null when the reply had no data).
    """
    at = F.lit(mapped_at) if isinstance(mapped_at, str) else mapped_at
    t = todo.select("cusip").distinct()
    h1 = pass1.where(F.col("hit").isNotNull()).join(t, "cusip", "left_semi")
    r1 = _from_hit(h1, F.col("hit")["ticker"], at)
    misses = t.join(h1.select("cusip"), "cusip", "left_anti")
    h2 = pass2.where(F.col("hit").isNotNull()).join(misses, "cusip", "left_semi")
    r2 = _from_hit(h2, F.when(F.col("hit")["marketSector"] == "Equity", F.col("hit")["ticker"]), at)
    never = misses.join(h2.select("cusip"), "cusip", "left_anti")
    r3 = never.select("cusip", *[F.lit(None).cast("string").alias(c) for c in CACHE_COLUMNS[1:-1]],
                      at.alias("mapped_at"))
    return r1.unionByName(r2).unionByName(r3)


def refresh_cache(old_cache: DataFrame, new_records: DataFrame) -> DataFrame:
    """Old cache aligned and merged with the new records; the new row wins per cusip."""
    old = old_cache if "figi_ticker" in old_cache.columns else old_cache.withColumn("figi_ticker", F.col("ticker"))
    return merge_latest(old.select(*CACHE_COLUMNS), new_records.select(*CACHE_COLUMNS), ["cusip"])


def mapping_requests(holdings: DataFrame, cache: DataFrame, limit: int = 0,
                     batch: int = 100) -> DataFrame:
    """Request plan: identifiers not in the cache, most valuable first, in batches.

    Columns: cusip, value (total), rank (1 = most valuable, cusip breaks ties),
    batch, id_type. ``limit`` keeps the top N (0 = all).
    """
    by_value = (holdings.where(F.col("cusip").isNotNull() & (F.col("cusip") != ""))
                        .groupBy("cusip").agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value")))
    todo = by_value.join(cache.select("cusip"), "cusip", "left_anti")
    ranked = global_rank(todo, [F.desc("value"), F.asc("cusip")])
    if limit:
        ranked = ranked.where(F.col("rank") <= limit)
    return ranked.withColumn("batch", batch_number(F.col("rank"), batch)).withColumn("id_type", id_type("cusip"))


def symbol_table(cache: DataFrame) -> DataFrame:
    """cusip -> (sym, sym_und) for the holdings join."""
    return cache.select("cusip", F.col("figi_ticker").alias("sym"),
                        underlying_symbol("ticker", "figi_ticker", "market_sector").alias("sym_und"))
