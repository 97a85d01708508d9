"""String, cast, filter and projection operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import text_to_long_rounded, text_to_long_truncated
from ..functions.numbers import mean_cents, py_fixed
from ..functions.strings import (digit_runs, extract_or_null, strip_chars, strip_to_null,
                                 underlying_symbol)
from ..operators.filters import line_filter, stripped_in
from ..plans.cot import cot_typed
from .base import Tables

_WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _sql_strip(x: str) -> str:
    return "regexp_replace(" + x + ", '^" + _WS + "+|" + _WS + "+$', '', 'g')"


def q_extract_digits(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", F.concat_ws(",", digit_runs("p_brand")).alias("brand_digits"),
                    extract_or_null(F.upper(F.concat(F.col("p_name"), F.lit(" x"))), r"^([A-Z][A-Z0-9./]*)\s", 1)
                    .alias("lead_word"))


SQL_EXTRACT_DIGITS = r"""
SELECT p_partkey, array_to_string(regexp_extract_all(p_brand, '\d+'), ',') AS brand_digits,
       CASE WHEN regexp_matches(upper(p_name || ' x'), '^([A-Z][A-Z0-9./]*)\s')
            THEN regexp_extract(upper(p_name || ' x'), '^([A-Z][A-Z0-9./]*)\s', 1) END AS lead_word
FROM part
"""


def q_issuer_prefix(spark, sf):
    p = Tables(spark, sf).part
    ticker = F.when(F.col("p_type") == "PROMO", F.upper("p_name"))
    sector = (F.when(F.col("p_type") == "ECONOMY", "Corp").when(F.col("p_type") == "STANDARD", "Pfd")
               .otherwise("Govt"))
    figi = F.upper(F.concat(F.col("p_name"), F.when(F.col("p_size") > 25, F.lit(" 0.5 06/01/31"))
                            .otherwise(F.lit(""))))
    return p.select("p_partkey", figi.alias("figi_ticker"), sector.alias("market_sector"),
                    underlying_symbol(ticker, figi, sector).alias("sym_und"))


SQL_ISSUER_PREFIX = r"""
WITH x AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN upper(p_name) END AS ticker,
                  CASE p_type WHEN 'ECONOMY' THEN 'Corp' WHEN 'STANDARD' THEN 'Pfd' ELSE 'Govt' END AS market_sector,
                  upper(p_name || CASE WHEN p_size > 25 THEN ' 0.5 06/01/31' ELSE '' END) AS figi_ticker FROM part)
SELECT p_partkey, figi_ticker, market_sector,
       coalesce(ticker, CASE WHEN market_sector IN ('Corp', 'Pfd') AND regexp_matches(figi_ticker, '^([A-Z][A-Z0-9./]*)\s')
                             THEN regexp_extract(figi_ticker, '^([A-Z][A-Z0-9./]*)\s', 1) END) AS sym_und
FROM x
"""


def q_strip_upper(spark, sf):
    p = Tables(spark, sf).part
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit("\t"))
    return p.select("p_partkey", F.upper(strip_chars(raw)).alias("name_upper"),
                    strip_to_null(F.when(F.col("p_size") > 40, F.lit(" \t ")).otherwise(F.col("p_brand")))
                    .alias("brand_or_null"))


SQL_STRIP_UPPER = f"""
SELECT p_partkey, upper({_sql_strip("' ' || p_name || chr(9)")}) AS name_upper,
       nullif({_sql_strip("CASE WHEN p_size > 40 THEN ' ' || chr(9) || ' ' ELSE p_brand END")}, '') AS brand_or_null
FROM part
"""


def _cot_like(t: Tables):
    li = t.lineitem
    return li.select(
        F.col("l_returnflag").alias("Market_and_Exchange_Names"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd").alias("Report_Date_as_YYYY-MM-DD"),
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" ")).alias("Open_Interest_All"),
        F.col("l_discount").cast("string").alias("Pct_of_OI_All"),
        F.col("l_tax").cast("string").alias("Conc_Net_LE_4_TDR_Long_All"),
        F.when(F.col("l_linenumber") == 1, F.lit("")).when(F.col("l_linenumber") == 2, F.lit("."))
         .otherwise(F.col("l_linenumber").cast("string")).alias("Change_in_Open_Interest_All"),
        F.col("l_linestatus").alias("FutOnly_or_Combined"))


def q_name_driven_cast(spark, sf):
    return cot_typed(_cot_like(Tables(spark, sf)))


SQL_NAME_DRIVEN_CAST = r"""
WITH s AS (SELECT l_returnflag AS "Market_and_Exchange_Names", strftime(l_shipdate, '%Y-%m-%d') AS "Report_Date_as_YYYY-MM-DD",
                  ' ' || CAST(l_orderkey AS VARCHAR) || ' ' AS oi, CAST(l_discount AS VARCHAR) AS pct,
                  CAST(l_tax AS VARCHAR) AS conc,
                  CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN '.' ELSE CAST(l_linenumber AS VARCHAR) END AS chg,
                  l_linestatus AS "FutOnly_or_Combined" FROM lineitem)
SELECT "Market_and_Exchange_Names", "Report_Date_as_YYYY-MM-DD",
       CASE WHEN regexp_matches(trim(oi), '^[+-]?[0-9]+$') THEN CAST(trim(oi) AS BIGINT) END AS "Open_Interest_All",
       TRY_CAST(pct AS DOUBLE) AS "Pct_of_OI_All", TRY_CAST(conc AS DOUBLE) AS "Conc_Net_LE_4_TDR_Long_All",
       CASE WHEN regexp_matches(trim(chg), '^[+-]?[0-9]+$') THEN CAST(trim(chg) AS BIGINT) END AS "Change_in_Open_Interest_All",
       "FutOnly_or_Combined",
       CAST("Report_Date_as_YYYY-MM-DD" AS DATE) AS date, CAST(CAST("Report_Date_as_YYYY-MM-DD" AS DATE) AS TIMESTAMP) AS time,
       "Market_and_Exchange_Names" AS sym
FROM s
"""


def q_round_to_long(spark, sf):
    li = Tables(spark, sf).lineitem
    txt = F.col("l_extendedprice").cast("string")
    return li.select("l_orderkey", "l_linenumber", text_to_long_rounded(txt).alias("value"),
                     text_to_long_truncated(txt).alias("votes"),
                     text_to_long_rounded(F.concat(F.lit("x"), txt)).alias("bad"))


SQL_ROUND_TO_LONG = """
SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS value,
       CAST(trunc(l_extendedprice) AS BIGINT) AS votes, CAST(NULL AS BIGINT) AS bad FROM lineitem
"""


def q_blank_null(spark, sf):
    d = Tables(spark, sf).documents
    lines = d.select("doc_id", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "raw"))
    return lines.select("doc_id", (F.col("pos") + 1).alias("line_no"), strip_to_null("raw").alias("line"))


SQL_BLANK_NULL = f"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents),
u AS (SELECT doc_id, generate_subscripts(arr, 1) AS line_no, unnest(arr) AS raw FROM s)
SELECT doc_id, line_no, nullif({_sql_strip("raw")}, '') AS line FROM u
"""


def q_line_filter(spark, sf):
    d = Tables(spark, sf).documents
    return line_filter(d, ["the"], ["and"]).select("doc_id")


SQL_LINE_FILTER = """
SELECT doc_id FROM documents
WHERE contains(concat_ws(',', CAST(doc_id AS VARCHAR), text, lang, source, CAST(n_chars AS VARCHAR)), 'the')
  AND NOT contains(concat_ws(',', CAST(doc_id AS VARCHAR), text, lang, source, CAST(n_chars AS VARCHAR)), 'and')
"""


def q_trimmed_in(spark, sf):
    o = Tables(spark, sf).orders.withColumn(
        "prio_raw", F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\t")))
    return o.where(stripped_in("prio_raw", ["1-URGENT", "2-HIGH"])).select("o_orderkey", "o_orderpriority")


SQL_TRIMMED_IN = """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""


def q_json_rows(spark, sf):
    e = Tables(spark, sf).events
    k = F.from_json(F.col("props"), "k long")["k"]
    return e.groupBy("event_type").agg(F.sum(k).alias("sum_k"), F.count(k).alias("n_k"))


SQL_JSON_ROWS = """
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       count(CAST(json_extract(props, '$.k') AS BIGINT)) AS n_k
FROM events GROUP BY 1
"""


def q_number_text(spark, sf):
    o = Tables(spark, sf).orders
    per = o.groupBy("o_orderpriority").agg(mean_cents("o_totalprice").alias("mean_price"),
                                           F.sum("o_totalprice").alias("_s"), F.count(F.lit(1)).alias("_n"))
    overall = o.select(F.avg("o_totalprice")).scalar()
    rel = (F.col("_s") / F.col("_n") / overall - 1) * 100
    return per.select("o_orderpriority", py_fixed("mean_price", 2, grouping=True).alias("mean_text"),
                      py_fixed(F.round(rel, 6), 1, sign=True).alias("rel_text"),
                      py_fixed(F.col("_n"), 0, sign=True, grouping=True).alias("n_text"))


SQL_NUMBER_TEXT = """
WITH g AS (SELECT o_orderpriority,
                  (sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(o_totalprice)
                   + CASE WHEN 2 * (sum(CAST(round(o_totalprice * 100) AS BIGINT)) % count(o_totalprice)) >= count(o_totalprice)
                          THEN 1 ELSE 0 END) / 100.0 AS mean_price,
                  sum(o_totalprice) AS s, count(*) AS n FROM orders GROUP BY 1),
o AS (SELECT avg(o_totalprice) AS m FROM orders)
SELECT o_orderpriority, format('{:,.2f}', mean_price) AS mean_text,
       format('{:+.1f}', round((s / n / o.m - 1) * 100, 6)) AS rel_text, CASE WHEN n >= 0 THEN '+' ELSE '' END || format('{:,.0f}', CAST(n AS DOUBLE)) AS n_text
FROM g, o
"""


def q_projection(spark, sf):
    o = Tables(spark, sf).orders
    out = o.select(F.col("o_orderkey").alias("accession_number"), F.col("o_custkey").alias("cik"),
                   F.lit("1998-03-31").cast("date").alias("period_of_report"),
                   F.lit(None).cast("string").alias("sym"), F.lit(None).cast("string").alias("sym_und"),
                   F.col("o_orderdate").cast("date").alias("date"),
                   F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("time"),
                   F.col("o_orderpriority").alias("market"), F.col("o_orderstatus").alias("helper"))
    if "FIGI" not in out.columns:  # add-if-absent
        out = out.withColumn("FIGI", F.lit(None).cast("string"))
    return out.drop("helper")


SQL_PROJECTION = """
SELECT o_orderkey AS accession_number, o_custkey AS cik, DATE '1998-03-31' AS period_of_report,
       CAST(NULL AS VARCHAR) AS sym, CAST(NULL AS VARCHAR) AS sym_und, CAST(o_orderdate AS DATE) AS date,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS time, o_orderpriority AS market, CAST(NULL AS VARCHAR) AS "FIGI"
FROM orders
"""


QUERIES = {
    "extract_digits": (q_extract_digits, SQL_EXTRACT_DIGITS),
    "issuer_prefix": (q_issuer_prefix, SQL_ISSUER_PREFIX),
    "strip_upper": (q_strip_upper, SQL_STRIP_UPPER),
    "name_driven_cast": (q_name_driven_cast, SQL_NAME_DRIVEN_CAST),
    "round_to_long": (q_round_to_long, SQL_ROUND_TO_LONG),
    "blank_null": (q_blank_null, SQL_BLANK_NULL),
    "line_filter": (q_line_filter, SQL_LINE_FILTER),
    "trimmed_in": (q_trimmed_in, SQL_TRIMMED_IN),
    "json_rows": (q_json_rows, SQL_JSON_ROWS),
    "number_text": (q_number_text, SQL_NUMBER_TEXT),
    "projection": (q_projection, SQL_PROJECTION),
}
