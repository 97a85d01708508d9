import datetime as dt
import gzip
import io
import os
import zipfile

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tidemark.plans.summaries import observations
from tidemark.sources.readers import read_fred_csv, read_sec_tsv, read_zip_member
from tidemark.sources.sinks import write_partitioned
from tidemark.plans.stocks import read_day_bars


def test_sec_tsv_edges(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "INFOTABLE.tsv")
    with open(p, "wb") as f:
        f.write(b"A\tB\tC\n" + b'x"y\t2\t3\t4\n' + b"short\n" + b"caf\xe9\t1\t2\n")
    rows = read_sec_tsv(spark, p, ["A", "B", "C"]).collect()
    assert tuple(rows[0]) == ('x"y', "2", "3")
    assert tuple(rows[1]) == ("short", None, None)
    assert rows[2][0] == "caf�"


def test_zip_member_by_header(spark, tmpdir_path):
    for name, member, body in [("2024q1_form13f.zip", "x/INFOTABLE.tsv", "ACCESSION_NUMBER\tCUSIP\nA\tc1\n"),
                               ("2024q2_form13f.zip", "infotable.TSV", "CUSIP\tFIGI\tACCESSION_NUMBER\nc2\tF\tB\n")]:
        with zipfile.ZipFile(os.path.join(tmpdir_path, name), "w") as z:
            z.writestr(member, body)
    df = read_zip_member(spark, os.path.join(tmpdir_path, "*.zip"), "INFOTABLE.tsv", ["ACCESSION_NUMBER", "CUSIP", "FIGI"])
    got = sorted((r.ACCESSION_NUMBER, r.CUSIP, r.FIGI) for r in df.collect())
    assert got == [("A", "c1", None), ("B", "c2", "F")]


def _archive(folder, name, body):
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("INFOTABLE.tsv", body)
    return path


def test_zip_member_edges(spark, tmpdir_path):
    path = _archive(tmpdir_path, "a.zip", b"\xef\xbb\xbfA\tB\r\na\rb\t2\t3\r\n\r\nshort\ncaf\xe9\t\n")
    got = read_zip_member(spark, path, "infotable.TSV", ["B", "A"]).select("A", "B").collect()
    assert [tuple(r) for r in got] == [("a\rb", "2"), ("short", None), ("caf�", "")]
    assert read_zip_member(spark, _archive(tmpdir_path, "b.zip", b""), "INFOTABLE.tsv", ["A"], optional=("A",)).count() == 0


def test_zip_member_fails_where_a_column_or_the_member_is_missing(spark, tmpdir_path):
    path = _archive(tmpdir_path, "a.zip", b"A\n1\n")
    for member, cols in (("INFOTABLE.tsv", ["A", "CUSIP"]), ("COVERPAGE.tsv", ["A"])):
        with pytest.raises(PythonException):
            read_zip_member(spark, path, member, cols).collect()


def test_fred_files_need_their_header(spark, tmpdir_path):
    for name, body in (("ICSA", "observation_date,ICSA\n2025-01-04,203000\n2025-01-11,.\n2025-01-18,\n"), ("GDP", "<html>,x\n2025-01-01,5\n")):
        with open(os.path.join(tmpdir_path, f"{name}.csv"), "w") as f:
            f.write(body)
    fred = read_fred_csv(spark, tmpdir_path)
    assert [tuple(r) for r in fred.collect()] == [("ICSA", dt.date(2025, 1, 4), 203000.0)]
    bls = spark.createDataFrame([("S", 2025, 1, 1.0), ("S", 2025, 1, 1.0), ("S", 2025, 13, 9.0)], "series string, year int, month int, value double")
    got = {tuple(r) for r in observations(bls, fred).collect()}
    assert got == {("S", dt.date(2025, 1, 1), 1.0), ("ICSA", dt.date(2025, 1, 4), 203000.0)}


def test_gz_bars_and_dynamic_overwrite(spark, tmpdir_path):
    for day in ["2025-01-02", "2025-01-03"]:
        d = os.path.join(tmpdir_path, "bars", "2025", "01")
        os.makedirs(d, exist_ok=True)
        with gzip.open(os.path.join(d, f"{day}.csv.gz"), "wt") as f:
            f.write("ticker,volume,close\nA,10,1.5\nB,20,2.5\n")
    bars = read_day_bars(spark, os.path.join(tmpdir_path, "bars", "*", "*", "*.csv.gz"),
                         "ticker string, volume double, close double")
    out = os.path.join(tmpdir_path, "out")
    write_partitioned(bars, out, ["date"], [F.col("ticker")])
    write_partitioned(bars.where(F.col("date") == dt.date(2025, 1, 3)).where(F.col("ticker") == "A"), out, ["date"])
    counts = {r.date: r["count"] for r in spark.read.parquet(out).groupBy("date").count().collect()}
    assert counts == {dt.date(2025, 1, 2): 2, dt.date(2025, 1, 3): 1}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "o_custkey" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
