"""Members of zip archives as a data source, and the writer of such archives.

The source plans a partition for each (archive, member), a few for a large member.
A task opens its archive in the shared folder as a seekable file, so that only
the directory of the archive and its own member are read, a chunk of lines at a
time; no row holds an archive. A member can only be unpacked from its start: the tasks
of a large one unpack what stands before their lines and pass over it, which costs
little beside the lines themselves. Any file system that Arrow knows by its URI can
hold the archives.

Archives are written in two steps: every task packs its own lines, and the packed
stretches of a member, one after another, are the packed member.
"""

from __future__ import annotations

import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from fnmatch import fnmatchcase
from itertools import chain, groupby, pairwise
from pathlib import PurePosixPath
from typing import IO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv, fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .schemas import all_strings

#: bytes of a member that are held at a time; a longer line is held whole
CHUNK_BYTES = 2 << 20
#: bytes of a member, unpacked, for one task; and the most tasks that read one member, as each unpacks it from the start
PIECE_BYTES, MOST_PIECES = 16 << 20, 4
#: packed bytes of a member that a task holds before they are written
HELD_BYTES = 256 << 10
#: zlib's level of what is written: of a third of the time of level 6 or less, for a tenth more bytes
LEVEL = 1


def _file_system(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path or URI, the path in it, and what stands before that path."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        system, inner = fs.FileSystem.from_uri(path)
        return system, inner, path[:len(path) - len(inner)] if path.endswith(inner) else ""
    return fs.LocalFileSystem(), path, ""


def list_archives(path: str, names: list[str] | None = None) -> list[str]:
    """The files that a path stands for: itself, those of a folder, or those that fit a pattern in its last part; sorted.

    With ``names`` only archives called so. The list has a row for each archive, not for their contents.
    """
    return sorted(archive_sizes(path, names))


def archive_sizes(path: str, names: list[str] | None = None) -> dict[str, int]:
    """The bytes of each of the files of ``list_archives``."""
    # a pattern is no valid part of a URI: only its folder is looked up
    folder, _, last = path.rstrip("/").rpartition("/")
    pattern = bool(re.search(r"[*?\[]", last))
    system, inner, before = _file_system(folder or "/" if pattern else path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = [f for f in system.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File]
        found = [f for f in found if fnmatchcase(f.base_name, last if pattern else "*.zip")]
    wanted = None if names is None else set(names)
    return {before + f.path: f.size for f in found if wanted is None or f.base_name in wanted}


def find_member(archive: zipfile.ZipFile, member: str) -> zipfile.ZipInfo | None:
    """The first file called ``member`` in any folder of the archive, whatever its case."""
    files: dict[str, zipfile.ZipInfo] = {}
    for info in archive.infolist():
        if not info.is_dir():
            files.setdefault(PurePosixPath(info.filename).name.casefold(), info)
    return files.get(member.casefold())


def _fields(line: bytes) -> list[str]:
    return line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace").split("\t")


def _whole_lines(file: IO[bytes]) -> Iterator[bytes]:
    """The bytes of a file in pieces that end where a line does."""
    held: list[bytes] = []
    while data := file.read(CHUNK_BYTES):
        # bytes: a line ends at \n alone, a lone \r stays in its field
        cut = data.rfind(b"\n") + 1
        if cut:
            yield b"".join([*held, data[:cut]])
            held = []
        held.append(data[cut:])
    yield b"".join(held)


def _lines_from(pieces: Iterable[bytes], at: int, start: int, end: int | None) -> Iterator[bytes]:
    """Of whole lines, of which the first begins at byte ``at``, those that begin from ``start`` to before ``end``."""
    for lines in pieces:
        first, last = 0, len(lines)
        if at < start:
            first = lines.find(b"\n", start - 1 - at) + 1 or last
        if end is not None and at + last >= end:
            last = 0 if at >= end else lines.find(b"\n", end - 1 - at) + 1 or last
        if first < last:
            yield lines[first:last]
        at += len(lines)
        if end is not None and at >= end:
            return


def _columns(lines: bytes, places: list[int | None], width: int) -> list[pa.Array]:
    """The fields at ``places`` of each line that is not empty; null where a line has no such field."""
    plain = _plain_columns(lines, places, width)
    if plain is not None:
        return plain
    rows = pc.split_pattern(pa.array([lines.decode("utf-8", "replace")]), "\n").flatten()
    if b"\r" in lines:
        rows = pc.if_else(pc.equal(pc.utf8_trim(rows, "\r"), ""), "", pc.replace_substring_regex(rows, r"\r\z", ""))
    parts = pc.split_pattern(rows.filter(pc.not_equal(rows, "")), "\t")
    starts, n_fields = parts.offsets.to_numpy()[:-1], pc.list_value_length(parts).to_numpy()
    return [pa.nulls(len(parts), pa.string()) if p is None else parts.values.take(pa.array(starts + p, mask=n_fields <= p)) for p in places]


def _plain_columns(lines: bytes, places: list[int | None], width: int) -> list[pa.Array] | None:
    """The same by Arrow's own reader, where every line has ``width`` fields, ends at \\n alone and is text; else nothing."""
    if width < 2 or not lines or b"\r" in lines or b"\0" in lines or lines.startswith(b"\xef\xbb\xbf"):
        return None
    names = [str(i) for i in range(width)]
    used = sorted({str(p) for p in places if p is not None})
    try:
        table = csv.read_csv(pa.BufferReader(lines), csv.ReadOptions(use_threads=False, block_size=len(lines) + 1, column_names=names),
                             csv.ParseOptions(delimiter="\t", quote_char=False, double_quote=False, escape_char=False, newlines_in_values=False, ignore_empty_lines=True),
                             csv.ConvertOptions(column_types={n: pa.string() for n in used}, include_columns=used, strings_can_be_null=False))
    except pa.ArrowInvalid:
        return None
    one = {n: c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for n, c in zip(used, table.columns)}
    return [pa.nulls(table.num_rows, pa.string()) if p is None else one[str(p)] for p in places]


class MemberPartition(InputPartition):
    """Of the lines of a member those that begin in its ``piece``-th of ``pieces`` equal stretches."""

    def __init__(self, archive: str, member: str, piece: int = 0, pieces: int = 1):
        self.archive, self.member, self.piece, self.pieces = archive, member, piece, pieces


class MemberReader(DataSourceReader):
    def __init__(self, options: dict):
        self.archives, self.members = json.loads(options["archives"]), json.loads(options["members"])
        self.cols, self.optional = json.loads(options["columns"]), json.loads(options["optional"])

    def partitions(self) -> list[MemberPartition]:
        return [MemberPartition(a, m, i, n) for a in self.archives for m, n in zip(self.members, self._pieces(a)) for i in range(n)]

    def _pieces(self, path: str) -> list[int]:
        system, inner, _ = _file_system(path)
        with system.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
            # an absent member fails in its task
            sizes = [info.file_size if (info := find_member(archive, m)) else 0 for m in self.members]
        return [min(max(1, -(-n // PIECE_BYTES)), MOST_PIECES) for n in sizes]

    def read(self, partition: MemberPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archives: Spark still plans one task
            return
        names = ["archive", "member", *self.cols]
        system, inner, _ = _file_system(partition.archive)
        with system.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
            info = find_member(archive, partition.member)
            if info is None:
                raise FileNotFoundError(f"{partition.archive} has no member {partition.member}")
            with archive.open(info) as file:
                pieces = _whole_lines(file)
                head, _, rest = next(pieces).partition(b"\n")
                header = _fields(head.removeprefix(b"\xef\xbb\xbf"))
                places = [header.index(c) if c in header else None for c in self.cols]
                absent = [c for c, p in zip(self.cols, places) if p is None and c not in self.optional]
                if absent:
                    raise ValueError(f"{partition.member} of {partition.archive} has no column {', '.join(absent)}")
                at, n = len(head) + 1, partition.pieces
                start, end = (info.file_size * i // n for i in (partition.piece, partition.piece + 1))
                for lines in _lines_from(chain([rest], pieces), at, start, end if partition.piece + 1 < n else None):
                    values = _columns(lines, places, len(header))
                    same = [pa.repeat(x, len(values[0])) for x in (partition.archive, partition.member)]
                    yield pa.RecordBatch.from_arrays([*same, *values], names)


class ZipMembers(DataSource):
    """Options, as JSON: ``archives`` (paths), ``members`` (file names), ``columns``, ``optional`` (columns that may be absent)."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> StructType:
        return all_strings(["archive", "member", *json.loads(self.options["columns"])])

    def reader(self, schema: StructType) -> MemberReader:
        return MemberReader(self.options)


def read_members(spark: SparkSession, archives: list[str], members: list[str], cols: list[str], optional: tuple[str, ...] = ()) -> DataFrame:
    """``archive``, ``member`` and ``cols`` of every line of the members of the archives, all strings."""
    spark.dataSource.register(ZipMembers)
    options = {"archives": archives, "members": members, "columns": cols, "optional": list(optional)}
    return spark.read.format("zip_members").options(**{k: json.dumps(v) for k, v in options.items()}).load()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, str, list[str]]]:
    """Archive, member and lines of each stretch of rows that share the first two."""
    for b in batches:
        names = [b.column(c).dictionary_encode("encode") for c in ("archive", "member")]
        changed = np.any([np.diff(n.indices.to_numpy()) != 0 for n in names], axis=0)
        # one call for all lines: a call for each run makes an Arrow scalar of each line
        lines = b.column("line").to_numpy(zero_copy_only=False)
        for start, end in pairwise([0, *(np.flatnonzero(changed) + 1).tolist(), b.num_rows] if b.num_rows else []):
            yield *(n[start].as_py() for n in names), lines[start:end].tolist()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch with its rows by archive and member, else in their order."""
    for b in batches:
        codes = [b.column(c).dictionary_encode("encode").indices.to_numpy() for c in ("member", "archive")]
        yield b.take(pa.array(np.lexsort(codes)))


class _Stretch:
    """Lines of one archive's member, packed so that the stretches of a task, and then those of other tasks, can follow each other."""

    def __init__(self):
        self.packer, self.seq = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS), -1
        self._new()

    def _new(self):
        self.held, self.packed, self.size, self.crc, self.n, self.seq = [], 0, 0, 0, 0, self.seq + 1

    def add(self, lines: list[str]) -> None:
        data = "\n".join([*lines, ""]).encode()
        self.held.append(self.packer.compress(data))
        self.packed += len(self.held[-1])
        self.size, self.crc, self.n = self.size + len(data), zlib.crc32(data, self.crc), self.n + len(lines)

    def write(self, out: pa.NativeFile) -> tuple[int, ...]:
        """Place in the task, start, packed bytes, bytes, CRC-32 and lines of what is written."""
        # a flush ends at a whole byte and is no last block
        data = b"".join([*self.held, self.packer.flush(zlib.Z_SYNC_FLUSH)])
        row = self.seq, out.tell(), len(data), self.size, self.crc, self.n
        out.write(data)
        self._new()
        return row


_PACKED = pa.schema([("archive", pa.string()), ("member", pa.string()), ("rank", pa.int32()), ("task", pa.int32()), ("file", pa.string()), *[
    (c, pa.int64()) for c in ("seq", "start", "packed", "size", "crc", "n")]])
_PACKED_DDL = "archive string, member string, rank int, task int, file string, seq long, start long, packed long, size long, crc long, n long"


def pack_lines(lines: DataFrame, folder: str, rank: int = 0) -> DataFrame:
    """Lines (archive, member, line), packed by the tasks that have them, each to a file under ``folder``: a row for each packed stretch.

    A member's lines are those of the lowest ``rank`` first, then in the order of the partitions, then in their own. A
    row is only good for the attempt that gave it: store the rows, or use them within the same job.
    """
    most = HELD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner, _ = _file_system(folder)
        system.create_dir(inner, recursive=True)
        task = TaskContext.get().partitionId()
        file = f"{inner.rstrip('/')}/part-{task:05d}-{uuid.uuid4().hex}"
        open_: dict[tuple[str, str], _Stretch] = {}
        rows = []
        with system.open_output_stream(file) as out:
            for archive, member, some in _runs(_gathered(batches)):
                if archive is None or member is None:
                    raise ValueError("lines without an archive or member")
                s = open_.get((archive, member)) or open_.setdefault((archive, member), _Stretch())
                s.add(some)
                if s.packed >= most:
                    rows.append((archive, member, rank, task, file, *s.write(out)))
            rows += [(*key, rank, task, file, *s.write(out)) for key, s in open_.items() if s.n]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PACKED.types)] if rows else [pa.array([], t) for t in _PACKED.types], schema=_PACKED)

    return lines.select("archive", "member", "line").mapInArrow(run, _PACKED_DDL)


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), modulo that of CRC-32; the highest bit is the constant term."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        bit >>= 1
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


#: x to the power of 8 times 2, 4, 8 ... bytes
_SHIFTS = [1 << 23]
for _ in range(63):
    _SHIFTS.append(_times(_SHIFTS[-1], _SHIFTS[-1]))


def joined_crc(first: int, second: int, size: int) -> int:
    """The CRC-32 of two stretches from the one of each, the second of ``size`` bytes."""
    for shift in _SHIFTS:
        if not size:
            break
        if size & 1:
            first = _times(shift, first)
        size >>= 1
    return first ^ second


class _PackedZip(zipfile.ZipFile):
    def write_packed(self, member: str, rows: list[dict], system: fs.FileSystem) -> None:
        """A member from its packed stretches, as they are."""
        info = zipfile.ZipInfo(member)
        info.compress_type, info.CRC = zipfile.ZIP_DEFLATED, 0
        for r in rows:
            info.CRC = joined_crc(info.CRC, r["crc"], r["size"])
        end = b"\x03\x00"  # an empty last block
        info.file_size, info.compress_size = sum(r["size"] for r in rows), sum(r["packed"] for r in rows) + len(end)
        info.header_offset = self.fp.tell()
        self._writecheck(info)
        self._didModify = True
        self.fp.write(info.FileHeader(True))
        for r in rows:
            with system.open_input_file(r["file"]) as f:
                f.seek(r["start"])
                left = r["packed"]
                while left:
                    data = f.read(min(left, CHUNK_BYTES))
                    if not data:
                        raise EOFError(r["file"])
                    self.fp.write(data)
                    left -= len(data)
        self.fp.write(end)
        self.filelist.append(info)
        self.NameToInfo[member] = info
        self.start_dir = self.fp.tell()


def join_packed(stretches: DataFrame, folder: str) -> DataFrame:
    """Archives under ``folder`` from the rows of ``pack_lines``: one task writes an archive, of packed bytes that it only passes on.

    Returns (archive, member, n) of what was written, by running the job once; an archive is complete only when its row is there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner, _ = _file_system(folder)
        system.create_dir(inner, recursive=True)
        for name, own in groupby(chain.from_iterable(b.to_pylist() for b in batches), lambda r: r["archive"]):
            counts = []
            with system.open_output_stream(f"{inner.rstrip('/')}/{name}") as out, _PackedZip(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for member, rows in groupby(own, lambda r: r["member"]):
                    rows = list(rows)  # a row for each stretch
                    archive.write_packed(member, rows, system)
                    counts.append((member, sum(r["n"] for r in rows)))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(counts)), pa.array([c[0] for c in counts]), pa.array([c[1] for c in counts], pa.int64())],
                                             ["archive", "member", "n"])

    ordered = stretches.repartition("archive").sortWithinPartitions("archive", "member", "rank", "task", "seq")
    done = ordered.mapInArrow(run, "archive string, member string, n long").collect()  # a row for each member
    return stretches.sparkSession.createDataFrame(done, "archive string, member string, n long")


def write_members(lines: DataFrame, folder: str) -> DataFrame:
    """Archives under ``folder`` from rows (archive, member, place, line), members and lines in order.

    Returns (archive, member, n) of what was written, as ``join_packed`` does.
    """
    packed = f"{folder.rstrip('/')}/_packed-{uuid.uuid4().hex}"
    ordered = lines.repartition("archive").sortWithinPartitions("archive", "member", "place")
    try:
        return join_packed(pack_lines(ordered, packed), folder)
    finally:
        system, inner, _ = _file_system(packed)
        system.delete_dir(inner)
