from pyspark.sql import functions as F

from tidemark.functions import (py_fixed, strip_chars, text_to_long_rounded, try_long, typed_column,
                                underlying_symbol)
from tidemark.functions.numbers import mean_cents


def test_round_half_even_and_bad_text(spark):
    df = spark.createDataFrame([(s,) for s in ["12.4", "2.5", "3.5", "1e30", "", "x", None]], "v string")
    got = [r[0] for r in df.select(text_to_long_rounded("v")).collect()]
    assert got == [12, 2, 4, None, None, None, None]


def test_try_long_rejects_what_spark_accepts(spark):
    df = spark.createDataFrame([(s,) for s in ["12", " 12 ", "1.5", "12d", "-3"]], "v string")
    assert [r[0] for r in df.select(try_long("v")).collect()] == [12, None, None, None, -3]


def test_name_driven_typing(spark):
    df = spark.createDataFrame([(" 12 ", "12.5"), (".", ""), ("", " ")], "Open_Interest_All string, Pct_x string")
    got = df.select(typed_column("Open_Interest_All", "bigint"), typed_column("Pct_x", "double")).collect()
    assert [tuple(r) for r in got] == [(12, 12.5), (None, None), (None, None)]


def test_python_number_text(spark):
    df = spark.createDataFrame([(v,) for v in [0.25, 0.15, -0.04, 1234567.5]], "x double")
    got = [r[0] for r in df.select(py_fixed("x", 1, sign=True)).collect()]
    assert got == [f"{v:+.1f}" for v in [0.25, 0.15, -0.04, 1234567.5]] == ["+0.2", "+0.1", "-0.0", "+1234567.5"]
    got = [r[0] for r in df.select(py_fixed("x", 0, sign=True, grouping=True)).collect()]
    assert got == [f"{v:+,.0f}" for v in [0.25, 0.15, -0.04, 1234567.5]]


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("\t a b  \n",)], "v string")
    assert df.select(strip_chars("v")).first()[0] == "a b"


def test_underlying_symbol(spark):
    rows = [("AAPL", "AAPL", "Equity"), (None, "BABA 0.5 06/01/31", "Corp"), (None, "T 4 02/15/34", "Govt"),
            (None, "AAPL", "Corp")]
    df = spark.createDataFrame(rows, "ticker string, figi string, sector string")
    got = [r[0] for r in df.select(underlying_symbol("ticker", "figi", "sector")).collect()]
    assert got == ["AAPL", "BABA", None, None]


def test_mean_cents_is_exact(spark):
    df = spark.createDataFrame([(0.01,), (0.02,)], "x double")
    assert df.agg(mean_cents("x")).first()[0] == 0.02  # 1.5 cents rounds half up
