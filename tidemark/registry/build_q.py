"""Whole dataset builds on landed stand-ins made from the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import sec_date_text
from ..plans.holdings_build import build_holdings
from ..plans.mapping import symbol_mapping, symbol_table
from ..plans.periods import filing_window
from ..session import discard, joins_by_hash, shuffles_removed
from ..sources.schemas import MEMBERS
from ..sources.sinks import write_table
from ..sources.zips import join_packed, pack_lines
from .base import Tables
from .holdings_q import _replies
from .io_q import _stage

_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]


def _quarter_end(day):
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def _additive() -> Column:
    return F.col("o_orderstatus") == "P"


def _filings(t: Tables) -> DataFrame:
    """The orders with ``day``, ``period`` and ``archive``; amendments stand in the next quarter's archive, too."""
    o = t.orders.withColumn("day", F.col("o_orderdate").cast("date")).withColumn("period", _quarter_end(F.col("day")))
    own, later = filing_window(F.col("period"))[2], filing_window(_quarter_end(F.date_add("period", 1)))[2]
    return o.withColumn("archive", F.explode(F.when(_additive(), F.array(own, later)).otherwise(F.array(own))))


def _filing_members() -> dict[str, dict]:
    """The fields of the members with a line for each filing."""
    additive = _additive()
    number = F.col("o_orderkey").cast("string")
    return {
        "SUBMISSION.tsv": {"ACCESSION_NUMBER": number, "FILING_DATE": sec_date_text(F.col("day")), "CIK": F.col("o_custkey"),
                           "SUBMISSIONTYPE": F.when(additive, "13F-HR/A").when(F.col("o_orderkey") % 11 == 0, "13F-NT").otherwise(" 13F-HR "),
                           "PERIODOFREPORT": sec_date_text(F.col("period"))},
        "COVERPAGE.tsv": {"ACCESSION_NUMBER": number, "ISAMENDMENT": F.when(additive, "Y").otherwise("N"), "AMENDMENTNO": F.dayofmonth("day"),
                          "AMENDMENTTYPE": F.when(additive, "NEW HOLDINGS"), "FILINGMANAGER_NAME": F.concat(F.lit("M"), "o_custkey"),
                          "REPORTTYPE": F.col("o_orderpriority")},
    }


def _line_members() -> dict[str, dict]:
    """The fields of the members with lines for the lines of a filing."""
    line_no = F.col("l_linenumber")
    return {
        "INFOTABLE.tsv": {"ACCESSION_NUMBER": F.col("l_orderkey"), "INFOTABLE_SK": line_no, "NAMEOFISSUER": F.concat(F.lit("I"), "l_partkey"),
                          "TITLEOFCLASS": F.col("l_returnflag"), "CUSIP": F.concat(F.lit(" "), "l_partkey", F.lit(" ")), "FIGI": F.concat(F.lit("F"), "l_partkey"),
                          "VALUE": F.floor("l_extendedprice"), "SSHPRNAMT": F.floor("l_quantity"), "SSHPRNAMTTYPE": F.lit("SH"), "PUTCALL": F.col("l_linestatus"),
                          "INVESTMENTDISCRETION": F.lit("SOLE"), "OTHERMANAGER": F.concat(line_no, F.lit(", "), line_no % 3 + 1),
                          "VOTING_AUTH_SOLE": F.floor("l_quantity"), "VOTING_AUTH_SHARED": line_no, "VOTING_AUTH_NONE": F.lit("0")},
        "OTHERMANAGER2.tsv": {"ACCESSION_NUMBER": F.col("l_orderkey"), "SEQUENCENUMBER": line_no, "CIK": F.col("l_suppkey"),
                              "NAME": F.concat(F.lit(" S"), "l_suppkey", F.lit(" "))},
    }


def _texts(rows: DataFrame, members: dict[str, dict], **only: Column) -> DataFrame:
    """(archive, member, line): a line of each of the members for each row, of those in ``only`` where its condition holds."""
    texts = []
    for member, fields in members.items():
        line = F.concat_ws("\t", *[F.coalesce(fields[c].cast("string"), F.lit("")) if c in fields else F.lit("") for c in MEMBERS[member]])
        name = member.partition(".")[0]
        texts.append(F.struct(F.lit(member).alias("member"), (F.when(only[name], line) if name in only else line).alias("line")))
    return rows.select("archive", F.inline(F.array(*texts))).where(F.col("line").isNotNull())


def _land(spark, t: Tables, base: str) -> None:
    """The archives under ``base``/zips: lines are joined once and packed by the tasks that have them."""
    o, packed = _filings(t), f"{base}/packed"
    key = o.select(F.col("o_orderkey").alias("l_orderkey"), "archive")
    lines = t.lineitem.select(*_LINE_COLUMNS).join(key, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber")
    rows = [_texts(o.sortWithinPartitions("o_orderkey"), _filing_members()), _texts(lines, _line_members(), OTHERMANAGER2=F.col("l_linenumber") <= 3)]
    for n, some in enumerate(rows, 1):
        write_table(pack_lines(some, packed, n), f"{base}/stretches/{n}")
    # every archive has a filing
    stretches = [spark.read.parquet(f"{base}/stretches/{n}") for n in (1, 2)]
    heads = F.array(*[F.struct(F.lit(m).alias("member"), F.lit("\t".join(cols)).alias("line")) for m, cols in MEMBERS.items()])
    first = pack_lines(stretches[0].select("archive").distinct().select("archive", F.inline(heads)), packed)
    join_packed(reduce(DataFrame.unionByName, [first, *stretches]), f"{base}/zips")
    discard(spark, packed)
    discard(spark, f"{base}/stretches")


def q_holdings_build(spark, sf):
    """Archives landed from the tables, all their periods built, with the mapping, in two runs: the second has nothing to do."""
    t = Tables(spark, sf)
    base = _stage(spark)
    with shuffles_removed(spark), joins_by_hash(spark):
        _land(spark, t, base)
        # the mapping asks for its identifiers three times
        write_table(t.lineitem.select("l_partkey").distinct().select(F.col("l_partkey").cast("string").alias("cusip")), f"{base}/cusips")
        cache = symbol_mapping(spark.read.parquet(f"{base}/cusips"), *_replies(t), "2024-01-02")
        write_table(symbol_table(cache), f"{base}/symbols")
    periods = t.orders.select(_quarter_end(F.col("o_orderdate").cast("date")).alias("period")).distinct()
    paths = (f"{base}/zips", f"{base}/out", f"{base}/manifest", periods, spark.read.parquet(f"{base}/symbols"))
    first, second = build_holdings(spark, *paths), build_holdings(spark, *paths)
    # one row a quarter
    counts = F.broadcast(first.withColumnsRenamed({"period": "period_of_report", "n_rows": "manifest_rows"}))
    built = spark.read.parquet(f"{base}/out").join(counts, "period_of_report")
    return built.withColumn("built_again", F.lit(second.count()).cast("long"))


SQL_HOLDINGS_BUILD = r"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus = 'P' AS additive, o_orderpriority, CAST(o_orderdate AS DATE) AS day,
                  CAST(last_day(date_trunc('quarter', CAST(o_orderdate AS DATE)) + INTERVAL 2 MONTH) AS DATE) AS period FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderstatus = 'P'),
r AS (SELECT *, row_number() OVER (PARTITION BY period, o_custkey ORDER BY day, day(day), CAST(o_orderkey AS VARCHAR)) AS rn FROM o),
b AS (SELECT *, max(CASE WHEN NOT additive THEN rn END) OVER (PARTITION BY period, o_custkey) AS base FROM r),
f AS (SELECT * FROM b WHERE rn >= coalesce(base, 1)),
h AS (SELECT f.*, l.*, l_linenumber || ', ' || (l_linenumber % 3 + 1) AS refs FROM f JOIN lineitem l ON l_orderkey = o_orderkey),
n AS (SELECT DISTINCT l_orderkey, refs, CAST(unnest(regexp_extract_all(refs, '\d+')) AS BIGINT) AS seq FROM h),
om AS (SELECT n.l_orderkey, refs, string_agg('S' || l.l_suppkey, '; ' ORDER BY seq, 'S' || l.l_suppkey) AS names, string_agg(CAST(l.l_suppkey AS VARCHAR), '; ' ORDER BY seq, 'S' || l.l_suppkey) AS ciks
       FROM n JOIN lineitem l ON l.l_orderkey = n.l_orderkey AND l.l_linenumber = seq AND seq <= 3 GROUP BY 1, 2),
p AS (SELECT p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN 'Equity' ELSE 'Corp' END AS sector,
             p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS h1, p_type IN ('PROMO', 'SMALL') AS h2 FROM part),
s AS (SELECT p_partkey, CASE WHEN h1 OR h2 THEN p_name END AS sym,
             CASE WHEN h1 OR (h2 AND sector = 'Equity') THEN p_name
                  WHEN (h1 OR h2) AND sector = 'Corp' THEN nullif(regexp_extract(p_name, '^([A-Z][A-Z0-9./]*)\s', 1), '') END AS sym_und FROM p)
SELECT h.period AS period_of_report, CAST(o_custkey AS VARCHAR) AS cik, 'M' || o_custkey AS manager_name, day AS filing_date,
       CASE WHEN additive THEN '13F-HR/A' ELSE ' 13F-HR ' END AS submission_type, o_orderpriority AS report_type, additive AS is_amendment,
       CAST(day(day) AS BIGINT) AS amendment_no, CASE WHEN additive THEN 'NEW HOLDINGS' END AS amendment_type, CAST(o_orderkey AS VARCHAR) AS accession_number,
       'I' || l_partkey AS issuer_name, l_returnflag AS title_of_class, CAST(l_partkey AS VARCHAR) AS cusip, 'F' || l_partkey AS figi, sym, sym_und,
       CAST(floor(l_extendedprice) AS BIGINT) AS value, CAST(floor(l_quantity) AS BIGINT) AS shares, 'SH' AS shares_type, l_linestatus AS put_call,
       'SOLE' AS investment_discretion, h.refs AS other_manager, om.names AS other_manager_names, om.ciks AS other_manager_ciks,
       CAST(floor(l_quantity) AS BIGINT) AS voting_sole, CAST(l_linenumber AS BIGINT) AS voting_shared, CAST(0 AS BIGINT) AS voting_none,
       count(*) OVER (PARTITION BY h.period) AS manifest_rows, CAST(0 AS BIGINT) AS built_again
FROM h LEFT JOIN om ON om.l_orderkey = h.l_orderkey AND om.refs = h.refs LEFT JOIN s ON s.p_partkey = h.l_partkey
"""


QUERIES = {
    "holdings_build": (q_holdings_build, SQL_HOLDINGS_BUILD),
}
