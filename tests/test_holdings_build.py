import datetime as dt
import json
import os
import time
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tidemark.operators import resolve_references
from tidemark.plans import holdings_build
from tidemark.plans.holdings_build import batches, build_holdings
from tidemark.session import settings
from tidemark.sources import zips
from tidemark.sources.readers import read_zip_member
from tidemark.sources.schemas import MEMBERS
from tidemark.sources.zips import MemberPartition, MemberReader, join_packed, joined_crc, list_archives, pack_lines, write_members

D = dt.date


def _lines(archive, sub, cov, info, om2=()):
    for (member, cols), rows in zip(MEMBERS.items(), (sub, cov, info, om2)):
        cols = [c for c in cols if c != "FIGI"]
        yield archive, member, 0, "\t".join(cols)
        yield from ((archive, member, i + 1, "\t".join(r.get(c, "") for c in cols)) for i, r in enumerate(rows))


def _filing(number, period, **more):
    return {"ACCESSION_NUMBER": number, "FILING_DATE": "01-MAY-2020", "SUBMISSIONTYPE": "13F-HR", "CIK": "7", "PERIODOFREPORT": period, **more}


def _holding(number, value, **more):
    return {"ACCESSION_NUMBER": number, "CUSIP": "abc", "VALUE": str(value), "SSHPRNAMT": "1", **more}


@pytest.fixture()
def archives(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "zips")
    # the same filing again in the next archive, with its members
    a1 = ([_filing("a1", "31-MAR-2020"), _filing("a2", "31-MAR-2020", CIK="8")], [{"ACCESSION_NUMBER": "a1", "FILINGMANAGER_NAME": "M"}],
          [_holding("a1", 5, OTHERMANAGER="1"), _holding("a1", 9), _holding("a2", 3)], [{"ACCESSION_NUMBER": "a1", "SEQUENCENUMBER": "1", "NAME": "X", "CIK": "1"}])
    a2 = ([a1[0][0], _filing("b1", "30-JUN-2020")], a1[1], [*a1[2][:2], _holding("b1", 4)], a1[3])
    empty = ([_filing("c1", "31-DEC-2019")], [], [], [])
    rows = [*_lines("2020q2_form13f.zip", *a1), *_lines("2020q3_form13f.zip", *a2), *_lines("2020q4_form13f.zip", *empty), *_lines("other.zip", *empty)]
    done = write_members(spark.createDataFrame(rows, "archive string, member string, place int, line string"), folder)
    assert done.count() == 16 and {r.n for r in done.where("archive = '2020q2_form13f.zip'").collect()} == {2, 3, 4}
    return folder


def test_archives_by_folder_pattern_and_name(spark, archives):
    assert [os.path.basename(a) for a in list_archives(archives)] == ["2020q2_form13f.zip", "2020q3_form13f.zip", "2020q4_form13f.zip", "other.zip"]
    assert [os.path.basename(a) for a in list_archives(f"file://{archives}/2020q[23]*.zip")] == ["2020q2_form13f.zip", "2020q3_form13f.zip"]
    one = read_zip_member(spark, archives, "infotable.TSV", ["CUSIP", "FIGI"], names=["2020q2_form13f.zip"])
    assert one.rdd.getNumPartitions() == 1
    assert [tuple(r)[1:] for r in one.collect()] == [("abc", None)] * 3
    assert read_zip_member(spark, archives, "INFOTABLE.tsv", ["CUSIP"]).rdd.getNumPartitions() == 4
    assert read_zip_member(spark, archives, "INFOTABLE.tsv", ["CUSIP"], names=["none.zip"]).count() == 0
    with pytest.raises(PythonException):
        read_zip_member(spark, archives, "absent.tsv", ["CUSIP"]).collect()


def test_two_runs_and_an_empty_period(spark, archives, tmpdir_path):
    out, manifest = f"{tmpdir_path}/out", f"{tmpdir_path}/manifest"
    periods = spark.createDataFrame([(D(2020, 3, 31),), (D(2020, 9, 30),)], "period date")
    assert [tuple(r) for r in build_holdings(spark, archives, out, manifest, periods).collect()] == [(D(2020, 3, 31), 3), (D(2020, 9, 30), 0)]
    table = spark.read.parquet(out)
    # a filing found in two archives counts once, in the order of the files
    got = table.select("cik", "value", "manager_name", "other_manager_names", "_metadata.row_index", "_metadata.file_path").collect()
    assert [tuple(r)[:4] for r in sorted(got, key=lambda r: (r.file_path, r.row_index))] == [("7", 9, "M", None), ("7", 5, "M", "X"), ("8", 3, None, None)]
    assert build_holdings(spark, archives, out, manifest, periods).count() == 0
    more = periods.union(spark.createDataFrame([(D(2020, 6, 30),)], "period date"))
    assert [tuple(r) for r in build_holdings(spark, archives, out, manifest, more).collect()] == [(D(2020, 6, 30), 1)]
    assert sorted(tuple(r) for r in spark.read.parquet(manifest).collect()) == [(D(2020, 3, 31), 3), (D(2020, 6, 30), 1), (D(2020, 9, 30), 0)]
    assert table.sparkSession.read.parquet(out).count() == 4


def test_a_run_lost_before_the_manifest_is_repeated(spark, archives, tmpdir_path, monkeypatch):
    out, manifest = f"{tmpdir_path}/out", f"{tmpdir_path}/manifest"
    periods = spark.createDataFrame([(D(2020, 3, 31),)], "period date")

    def lost(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(holdings_build, "write_manifest", lost)
        with pytest.raises(RuntimeError):
            build_holdings(spark, archives, out, manifest, periods)
    assert build_holdings(spark, archives, out, manifest, periods).first()["n_rows"] == 3
    assert spark.read.parquet(out).count() == 3


def test_batches_keep_the_order_and_the_limit():
    assert batches([3, 3, 9, 1, 4, 6], lambda x: x, 6) == [[3, 3], [9], [1, 4], [6]]
    assert batches([], lambda x: x, 6) == []


def test_periods_are_built_a_few_archives_at_a_time(spark, archives, tmpdir_path, monkeypatch):
    periods = spark.createDataFrame([(D(2020, 3, 31),), (D(2020, 6, 30),), (D(2020, 9, 30),)], "period date")
    assert build_holdings(spark, archives, f"{tmpdir_path}/one", f"{tmpdir_path}/m1", periods).count() == 3
    read = []

    def noted(*args, names):
        read.append(names)
        return read_zip_member(*args, names=names)
    monkeypatch.setattr(holdings_build, "read_zip_member", noted)
    monkeypatch.setattr(holdings_build, "BATCH_BYTES", 1)
    done = build_holdings(spark, archives, f"{tmpdir_path}/many", f"{tmpdir_path}/m2", periods)
    assert [tuple(r) for r in done.collect()] == [(D(2020, 3, 31), 3), (D(2020, 6, 30), 1), (D(2020, 9, 30), 0)]
    assert read == [[f"2020q{q}_form13f.zip"] for q in (2, 3, 4) for _ in MEMBERS]
    one, many = (sorted(map(str, spark.read.parquet(f"{tmpdir_path}/{x}").collect())) for x in ("one", "many"))
    assert one == many


def test_a_build_leaves_no_shuffle_files(spark, archives, tmpdir_path):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    # the periods are planned outside: their own few rows stay
    periods = spark.createDataFrame([(D(2020, 3, 31),), (D(2020, 6, 30),)], "period date")
    plan = holdings_build.planned
    left = []

    def planned(*args):
        rows = plan(*args).collect()
        left.append(files())
        return spark.createDataFrame(rows, "period date")
    write = holdings_build.write_partitioned
    after = []

    def written(*args):
        write(*args)
        for _ in range(100):
            if not files() - before:
                break
            time.sleep(0.1)
        after.append(files() - before)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(holdings_build, "planned", planned)
        m.setattr(holdings_build, "write_partitioned", written)
        before = files()
        was = spark.conf.get(key)
        m.setattr(holdings_build, "existing_keys", lambda *a: None)
        build_holdings(spark, archives, f"{tmpdir_path}/out", f"{tmpdir_path}/manifest", periods)
    assert len(after) == 1 and not {n for n in after[0] if n not in left[0]}
    assert spark.conf.get(key) == was


def test_lines_are_the_same_whatever_the_pieces(tmpdir_path, monkeypatch):
    rows = [b"a\t1\tx", b"", b"b\t2", b"c\t\r3\tz\textra", b"\r", b"d\t\xe2\x82\ty", "\u00e9\t\u20ac\t".encode(), b"e"]
    path = f"{tmpdir_path}/x.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("in/M.tsv", b"\xef\xbb\xbfA\tB\tC\r\n" + b"\r\n".join(rows[:4]) + b"\n" + b"\n".join(rows[4:]))
        z.writestr("EMPTY.tsv", b"A\tB\tC")
    reader = MemberReader({k: json.dumps(v) for k, v in {"archives": [path], "members": ["M.tsv"], "columns": ["C", "A", "Z", "B"], "optional": ["Z"]}.items()})
    expected = [("x", "a", None, "1"), (None, "b", None, "2"), ("z", "c", None, "\r3"), ("y", "d", None, "\ufffd"), ("", "\u00e9", None, "\u20ac"), (None, "e", None, None)]
    for n in (1, 2, 3, 7, 1 << 20):
        monkeypatch.setattr(zips, "CHUNK_BYTES", n)
        got = [tuple(r.values()) for b in reader.read(MemberPartition(path, "m.TSV")) for r in b.to_pylist()]
        assert got == [(path, "m.TSV", *r) for r in expected]
        assert sum(b.num_rows for b in reader.read(MemberPartition(path, "EMPTY.tsv"))) == 0


def test_runs_of_archive_and_member():
    names = ["archive", "member", "line"]
    two = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema([(n, pa.string()) for n in names])) for rows in (
        [("a", "m", "1"), ("a", "m", "2"), ("a", "n", "3"), ("b", "n", "4")], [], [("b", "n", "5")])]
    assert list(zips._runs(iter(two))) == [("a", "m", ["1", "2"]), ("a", "n", ["3"]), ("b", "n", ["4"]), ("b", "n", ["5"])]


def test_a_large_member_is_read_by_several_tasks(spark, archives, tmpdir_path, monkeypatch):
    """One task read a whole member: with an archive a plan, the other cores had nothing to do."""
    path = f"{tmpdir_path}/x.zip"
    lines = [f"{i}\t{'x' * (i * 7 % 90)}" for i in range(200)]
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("M.tsv", "\n".join(["A\tB", *lines, ""]))
    monkeypatch.setattr(zips, "PIECE_BYTES", 1000)
    options = {k: json.dumps(v) for k, v in {"archives": [path], "members": ["M.tsv"], "columns": ["A", "B"], "optional": []}.items()}
    for most in (1, 3, 4, 100):
        monkeypatch.setattr(zips, "MOST_PIECES", most)
        for n in (1, 50, 1 << 20):
            monkeypatch.setattr(zips, "CHUNK_BYTES", n)
            reader = MemberReader(options)
            parts = reader.partitions()
            assert len(parts) == min(most, -(-os.path.getsize(path) // 1000)) if most < 4 else len(parts) > 3
            got = [[f"{r['A']}\t{r['B']}" for b in reader.read(p) for r in b.to_pylist()] for p in parts]
            # each line once, whatever the limits of the pieces; pieces of many lines all have some
            assert sum(got, []) == lines
            assert most == 100 or all(got)


def test_pieces_that_end_at_every_byte():
    data = [b"a\n", b"\n", b"bc\n", b"d"]
    whole = b"".join(data)
    for cut in range(len(whole) + 1):
        for more in range(cut, len(whole) + 1):
            pieces = [b"".join(zips._lines_from(iter(data), 0, s, e)) for s, e in ((0, cut), (cut, more), (more, None))]
            assert b"".join(pieces) == whole
            assert all(p.endswith(b"\n") for p in pieces if p and not whole.endswith(p))


def test_lines_of_an_archive_are_packed_by_the_tasks_that_have_them(spark, tmpdir_path, monkeypatch):
    """One task packed a whole archive, after all its lines had been sent to it."""
    monkeypatch.setattr(zips, "HELD_BYTES", 64)
    row = "concat_ws('\t', id, sha2(cast(id as string), 256))"
    df = spark.range(0, 40000, 1, 5).selectExpr("concat(id % 3, '.zip') archive", "if(id % 2 = 0, 'A.tsv', 'B.tsv') member", f"{row} line")
    head = spark.range(3).selectExpr("concat(id, '.zip') archive", "explode(array('A.tsv', 'B.tsv', 'EMPTY.tsv')) member", "'K\tV' line")
    stretches = pack_lines(df, f"{tmpdir_path}/packed", 1)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="500"):
        rows = stretches.collect()
    assert {r.task for r in rows if r.archive == "0.zip" and r.member == "A.tsv"} == set(range(5)) and max(r.seq for r in rows) > 0
    done = join_packed(pack_lines(head, f"{tmpdir_path}/packed").union(spark.createDataFrame(rows, stretches.schema)), f"{tmpdir_path}/zips")
    assert sum(r.n for r in done.collect()) == 40009 and done.count() == 9
    for k in range(3):
        with zipfile.ZipFile(f"{tmpdir_path}/zips/{k}.zip") as z:
            assert z.testzip() is None and z.namelist() == ["A.tsv", "B.tsv", "EMPTY.tsv"]
            for m, odd in (("A.tsv", 0), ("B.tsv", 1)):
                head, *said = z.read(m).decode().splitlines()
                assert head == "K\tV" and [int(x.split("\t")[0]) for x in said] == [i for i in range(40000) if i % 3 == k and i % 2 == odd]
            assert z.read("EMPTY.tsv") == b"K\tV\n"
    back = read_zip_member(spark, f"{tmpdir_path}/zips", "b.tsv", ["K", "V"])
    assert back.selectExpr("sum(cast(K as long))", "count(V)").first()[:] == (sum(range(1, 40000, 2)), 20000)


def test_the_sum_of_two_stretches():
    a, b = b"first\n" * 7, bytes(range(256)) * 300
    assert joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert joined_crc(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a) and joined_crc(0, zlib.crc32(b), len(b)) == zlib.crc32(b)


def test_each_member_is_read_once_a_plan(spark, archives, tmpdir_path, monkeypatch):
    """The filings were read again for every use of them: 16 times."""
    frames = []
    write = holdings_build.write_partitioned

    def written(df, *args):
        frames.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *args)
    monkeypatch.setattr(holdings_build, "write_partitioned", written)
    periods = spark.createDataFrame([(D(2020, 3, 31),)], "period date")
    build_holdings(spark, archives, f"{tmpdir_path}/out", f"{tmpdir_path}/manifest", periods)
    # lines and other managers here, the two members of filings in the table that is stored
    assert [f.count("zip_members") for f in frames] == [2]
    assert not [x for x in os.listdir(spark.conf.get("spark.checkpoint.dir")) if x.startswith("scratch-")]


def test_names_of_each_row_are_those_of_its_pair(spark):
    rows = spark.createDataFrame([("a", "2, 1"), ("a", "2, 1"), ("a", "1 1"), ("a", "9"), ("a", ""), ("a", None), ("b", "3"), (None, "1"), ("c", "1")], "doc string, refs string")
    lookup = spark.createDataFrame([("a", 1, "Z"), ("a", 1, "Y"), ("a", 2, None), ("a", 2, "X"), ("a", None, "W"), ("b", 3, None), (None, 1, "V")], "doc string, seq long, name string")
    args = (rows, "doc", "refs", lookup, "seq", {"names": "name"})
    pairs = {(r.doc, r.refs): r.names for r in resolve_references(*args).collect()}
    got = [tuple(r) for r in resolve_references(*args, each_row=True).collect()]
    assert sorted(got, key=str) == sorted(((*r, pairs.get(tuple(r))) for r in rows.collect()), key=str)
    assert pairs["a", "2, 1"] == "Y; Z; X" and pairs["a", "1 1"] == "Y; Y; Z; Z" and pairs["b", "3"] is None
