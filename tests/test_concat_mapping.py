from pyspark.sql import functions as F

from tidemark.operators import resolve_references
from tidemark.plans.mapping import live_cache, mapping_requests, symbol_mapping
from tidemark.sources.schemas import FIGI_HIT


def test_other_manager_names(spark):
    rows = spark.createDataFrame([("A1", "5,1"), ("A1", "1,9"), ("A1", None), ("A1", "NONE")], "acc string, om string")
    lk = spark.createDataFrame([("A1", 1, "B", "11"), ("A1", 5, "A", "55")], "acc string, seq long, name string, cik string")
    got = {r.om: (r.names, r.ciks) for r in
           resolve_references(rows, "acc", "om", lk, "seq", {"names": "name", "ciks": "cik"}).collect()}
    assert got == {"5,1": ("B; A", "11; 55"), "1,9": ("B", "11")}


def test_tiers(spark):
    hit = lambda t, sec: (t, "n", "Common", sec, "US")
    schema = f"cusip string, hit {FIGI_HIT.simpleString()}"
    p1 = spark.createDataFrame([("c1", hit("AAA", "Equity")), ("c2", None), ("c3", None), ("c4", None)], schema)
    p2 = spark.createDataFrame([("c2", hit("BBB", "Equity")), ("c3", hit("CCC 1 01/01/30", "Corp")), ("c4", None)], schema)
    todo = spark.createDataFrame([("c1",), ("c2",), ("c3",), ("c4",)], "cusip string")
    got = {r.cusip: (r.ticker, r.figi_ticker, r.market_sector)
           for r in symbol_mapping(todo, p1, p2, "2025-01-01").collect()}
    assert got == {"c1": ("AAA", "AAA", "Equity"), "c2": ("BBB", "BBB", "Equity"),
                   "c3": (None, "CCC 1 01/01/30", "Corp"), "c4": (None, None, None)}


def test_live_cache_and_requests(spark):
    cache = spark.createDataFrame([("c1", None, "name", None), ("c2", "T", "n", "T"), ("c3", None, None, None)],
                                  "cusip string, ticker string, name string, figi_ticker string")
    for c in ["security_type", "market_sector", "exch_code", "mapped_at"]:
        cache = cache.withColumn(c, F.lit(None).cast("string"))
    assert sorted(r.cusip for r in live_cache(cache).collect()) == ["c2", "c3"]
    h = spark.createDataFrame([("c2", 5), ("A9", 7), ("09", 7), ("08", None), ("", 100)], "cusip string, value long")
    req = mapping_requests(h, live_cache(cache), batch=2).orderBy("rank").collect()
    assert [(r.cusip, r.rank, r.batch, r.id_type) for r in req] == [
        ("09", 1, 0, "ID_CUSIP"), ("A9", 2, 0, "ID_CINS"), ("08", 3, 1, "ID_CUSIP")]
