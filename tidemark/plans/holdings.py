"""Quarterly institutional holdings (one row per holding line), many periods in one plan.

Inputs are the four archive members as string DataFrames (see
``sources.readers.read_sec_tsv`` / ``read_zip_member``) and a period table.
Every step is a join or an aggregation keyed by (period, manager) or by
accession; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import text_to_long_rounded, text_to_long_truncated, try_long
from ..functions.dates import sec_date_text
from ..functions.strings import blank_to_null, strip_chars
from ..operators.concat import resolve_references
from ..operators.coverage import share_report
from ..operators.dedup import keep_one
from ..operators.versions import effective_versions
from .periods import filing_window

FORMS = ["13F-HR", "13F-HR/A"]


def filings(sub: DataFrame, cov: DataFrame, periods: DataFrame,
            own_archive_only: bool = True) -> DataFrame:
    """13F-HR(/A) filings of each wanted period, with cover-page fields.

    The period text must equal the upper-case ``DD-MON-YYYY`` exactly (no
    trim); the form type is compared stripped. With ``own_archive_only`` and
    an ``archive`` column, late filings found in other archives are ignored,
    as when each period is built from its own archive; without it a filing found in
    several archives is taken from the first by name. ``archive`` stays a column: all
    members of a filing come from the archive that the filing was taken from.
    """
    # one row per quarter: a bounded table
    p = F.broadcast(periods.select("period", sec_date_text(F.col("period")).alias("_ptext"),
                                   filing_window(F.col("period"))[2].alias("_archive")))
    s = sub.join(p, sub["PERIODOFREPORT"] == F.col("_ptext"))
    kept = []
    if "archive" in sub.columns:
        kept = ["archive"]
        if own_archive_only:
            s = s.where(F.substring_index("archive", "/", -1) == F.col("_archive"))
        else:
            s = keep_one(s, ["period", "ACCESSION_NUMBER"], [F.col("archive")])
    s = s.where(strip_chars("SUBMISSIONTYPE").isin(*FORMS)).drop("_ptext", "_archive")
    f = s.join(cov, _filing_keys(s, cov), "left")
    return f.select(
        "period", "ACCESSION_NUMBER", *kept, "CIK", "FILINGMANAGER_NAME", "SUBMISSIONTYPE", "REPORTTYPE",
        F.to_date(F.col("FILING_DATE"), "dd-MMM-yyyy").alias("filing_date"),
        (F.col("ISAMENDMENT") == "Y").alias("is_amendment"),
        try_long("AMENDMENTNO").alias("amendment_no"),
        strip_chars(F.coalesce(F.col("AMENDMENTTYPE"), F.lit(""))).alias("amendment_type"))


def _filing_keys(a: DataFrame, b: DataFrame) -> list[str]:
    """What the members of one filing share: its number, and where it is known the archive."""
    return ["ACCESSION_NUMBER", *(["archive"] if "archive" in a.columns and "archive" in b.columns else [])]


def effective_filings(f: DataFrame) -> DataFrame:
    """Per (period, manager): the last original or restatement and every later
    NEW HOLDINGS amendment; all filings when there is no such base."""
    replaces = ~F.coalesce(F.col("is_amendment"), F.lit(False)) | (F.col("amendment_type") != "NEW HOLDINGS")
    return effective_versions(f, ["period", "CIK"], ["filing_date", "amendment_no", "ACCESSION_NUMBER"], replaces)


def filing_meta(kept: DataFrame) -> DataFrame:
    return kept.select(
        "period", *[c for c in ("ACCESSION_NUMBER", "archive") if c in kept.columns], F.col("CIK").alias("cik"),
        F.col("FILINGMANAGER_NAME").alias("manager_name"), "filing_date",
        F.col("SUBMISSIONTYPE").alias("submission_type"), F.col("REPORTTYPE").alias("report_type"),
        "is_amendment", "amendment_no", blank_to_null("amendment_type").alias("amendment_type"))


def other_manager_names(rows: DataFrame, om2: DataFrame) -> DataFrame:
    """``rows`` with names and CIKs of the numbers in OTHERMANAGER, joined by ``"; "`` in number order."""
    keys = _filing_keys(om2, rows)
    lookup = om2.select(*keys, try_long("SEQUENCENUMBER").alias("seq"),
                        strip_chars("NAME").alias("om_name"), strip_chars("CIK").alias("om_cik"))
    return resolve_references(rows, keys, "OTHERMANAGER", lookup, "seq",
                              {"other_manager_names": "om_name", "other_manager_ciks": "om_cik"}, each_row=True)


def holdings_13f(sub: DataFrame, cov: DataFrame, info: DataFrame, om2: DataFrame, periods: DataFrame,
                 symbols: DataFrame | None = None, own_archive_only: bool = True,
                 stored: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The 27-column holdings table for every period in ``periods`` (column ``period``).

    ``symbols``: optional (cusip, sym, sym_und) from ``mapping.symbol_table``;
    without it both columns are null (the skip-mapping mode). ``stored`` may write the
    filings, which are used twice, and give them back, so that their members are read once.
    """
    meta = filing_meta(effective_filings(stored(filings(sub, cov, periods, own_archive_only))))
    if "FIGI" not in info.columns:  # column added to the data sets in 2023
        info = info.withColumn("FIGI", F.lit(None).cast("string"))
    # the holding lines are large and the filing metadata small; AQE decides
    # the strategy from the measured metadata size
    df = info.join(meta, _filing_keys(info, meta))
    df = other_manager_names(df, om2)
    # Spark resolves names case-insensitively: derived columns get internal
    # names until the final projection (``cusip`` would clash with ``CUSIP``)
    df = df.select(
        "*",
        F.upper(strip_chars("CUSIP")).alias("_cusip"),
        text_to_long_rounded("VALUE").alias("_value"),
        text_to_long_rounded("SSHPRNAMT").alias("_shares"),
        text_to_long_truncated("VOTING_AUTH_SOLE").alias("_voting_sole"),
        text_to_long_truncated("VOTING_AUTH_SHARED").alias("_voting_shared"),
        text_to_long_truncated("VOTING_AUTH_NONE").alias("_voting_none"))
    if symbols is None:
        df = df.withColumn("_sym", F.lit(None).cast("string")).withColumn("_sym_und", F.lit(None).cast("string"))
    else:
        s = symbols.select(F.col("cusip").alias("_cusip"), F.col("sym").alias("_sym"),
                           F.col("sym_und").alias("_sym_und"))
        df = df.join(s, "_cusip", "left")
    return df.select(
        F.col("period").alias("period_of_report"), "cik", "manager_name", "filing_date", "submission_type",
        "report_type", "is_amendment", "amendment_no", "amendment_type",
        F.col("ACCESSION_NUMBER").alias("accession_number"), F.col("NAMEOFISSUER").alias("issuer_name"),
        F.col("TITLEOFCLASS").alias("title_of_class"), F.col("_cusip").alias("cusip"),
        F.col("FIGI").alias("figi"), F.col("_sym").alias("sym"), F.col("_sym_und").alias("sym_und"),
        F.col("_value").alias("value"), F.col("_shares").alias("shares"),
        F.col("SSHPRNAMTTYPE").alias("shares_type"), F.col("PUTCALL").alias("put_call"),
        F.col("INVESTMENTDISCRETION").alias("investment_discretion"),
        F.col("OTHERMANAGER").alias("other_manager"), "other_manager_names", "other_manager_ciks",
        F.col("_voting_sole").alias("voting_sole"), F.col("_voting_shared").alias("voting_shared"),
        F.col("_voting_none").alias("voting_none"))


def output_order():
    """Row order inside each period's files: cik ascending, value descending,
    nulls first in both (applied per partition on write, never a global sort)."""
    return [F.asc_nulls_first("cik"), F.desc_nulls_first("value")]


def coverage_report(holdings: DataFrame) -> DataFrame:
    """Per period: rows, managers, symbol coverage by rows and by value."""
    return share_report(holdings, ["period_of_report"], "cik", F.col("sym_und").isNotNull(), "value")
