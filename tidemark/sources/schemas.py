"""Explicit schemas of every landed source (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

# Quarterly holdings archives: tab-separated members, read as strings.
SUBMISSION_COLS = ["ACCESSION_NUMBER", "FILING_DATE", "SUBMISSIONTYPE", "CIK", "PERIODOFREPORT"]
COVERPAGE_COLS = ["ACCESSION_NUMBER", "REPORTCALENDARORQUARTER", "ISAMENDMENT", "AMENDMENTNO",
                  "AMENDMENTTYPE", "FILINGMANAGER_NAME", "REPORTTYPE"]
INFOTABLE_COLS = ["ACCESSION_NUMBER", "INFOTABLE_SK", "NAMEOFISSUER", "TITLEOFCLASS", "CUSIP", "FIGI",
                  "VALUE", "SSHPRNAMT", "SSHPRNAMTTYPE", "PUTCALL", "INVESTMENTDISCRETION",
                  "OTHERMANAGER", "VOTING_AUTH_SOLE", "VOTING_AUTH_SHARED", "VOTING_AUTH_NONE"]
OTHERMANAGER2_COLS = ["ACCESSION_NUMBER", "SEQUENCENUMBER", "CIK", "FORM13FFILENUMBER",
                      "CRDNUMBER", "SECFILENUMBER", "NAME"]
MEMBERS = {
    "SUBMISSION.tsv": SUBMISSION_COLS,
    "COVERPAGE.tsv": COVERPAGE_COLS,
    "INFOTABLE.tsv": INFOTABLE_COLS,
    "OTHERMANAGER2.tsv": OTHERMANAGER2_COLS,
}


def all_strings(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


FIGI_HIT = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("securityType", T.StringType()),
    T.StructField("marketSector", T.StringType()),
    T.StructField("exchCode", T.StringType()),
])
FIGI_REPLY = T.StructType([
    T.StructField("cusip", T.StringType()),
    T.StructField("pass_no", T.IntegerType()),
    T.StructField("data", T.ArrayType(FIGI_HIT)),
])
CUSIP_CACHE = all_strings(["cusip", "ticker", "figi_ticker", "name", "security_type",
                           "market_sector", "exch_code", "mapped_at"])


def _results(fields: list[T.StructField], extra: list[T.StructField] | None = None) -> T.StructType:
    return T.StructType([T.StructField("results", T.ArrayType(T.StructType(fields)))] + (extra or []))


SPLITS_JSON = _results([T.StructField("ticker", T.StringType()),
                        T.StructField("execution_date", T.DateType()),
                        T.StructField("split_from", T.DoubleType()),
                        T.StructField("split_to", T.DoubleType())])
DIVIDENDS_JSON = _results([T.StructField("ticker", T.StringType()),
                           T.StructField("ex_dividend_date", T.DateType()),
                           T.StructField("cash_amount", T.DoubleType())])
TICKER_PAGES_JSON = _results([T.StructField("ticker", T.StringType()),
                              T.StructField("type", T.StringType())],
                             [T.StructField("next_url", T.StringType())])
TICKER_TYPES_JSON = _results([T.StructField("code", T.StringType()),
                              T.StructField("description", T.StringType())])

FRED_RELEASE_JSON = T.StructType([
    T.StructField("release_id", T.LongType()),
    T.StructField("releases", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
])
FRED_RELEASE_DATES_JSON = T.StructType([
    T.StructField("release", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("release_dates", T.ArrayType(T.StructType([T.StructField("date", T.StringType())]))),
    T.StructField("_corrupt_record", T.StringType()),
])
TREASURY_AUCTION = T.StructType([
    T.StructField(n, T.StringType()) for n in
    ["type", "originalSecurityTerm", "auctionDate", "cusip", "reopening", "offeringAmount",
     "highYield", "bidToCoverRatio", "_corrupt_record"]
])
BLS_JSON = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("Results", T.StructType([T.StructField("series", T.ArrayType(T.StructType([
        T.StructField("seriesID", T.StringType()),
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("year", T.StringType()),
            T.StructField("period", T.StringType()),
            T.StructField("value", T.StringType()),
        ]))),
    ])))])),
])
FRED_CSV = "observation_date string, value string"
