"""Helpers shared by the training-data operators.

Texts travel to Python tasks as Arrow batches. ``pieces`` cuts a batch into
runs of about a megabyte, so that the memory of a task depends neither on
the batch size nor on the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpointed as checkpointed

U64 = np.uint64
WHITESPACE_WORD = r"[^\x20\x09-\x0D]+"
#: bytes of text in a block of documents that one task holds at a time
BLOCK_BYTES = 4 << 20
#: bytes of text that are taken through numpy at a time
PIECE_BYTES = 1 << 19


def ascii_lower_table() -> bytes:
    """A-Z to a-z, every other byte as it is."""
    return bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_table() -> bytes:
    """For words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in lower case.

    Every byte outside a word becomes a space, A-Z become a-z, so that
    ``bytes.translate(...).split()`` gives the words. Bytes of multi-byte
    characters are word bytes.
    """
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for lo, hi, shift in ((48, 58, 0), (97, 123, 0), (65, 91, 32)):
        for c in range(lo, hi):
            out[c] = c + shift
    return bytes(out)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes each, whole texts only."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


_OWN = "__n of the table"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs``, written once, with a number ``__n`` that no two rows share.

    A checkpoint, as Spark removes it when nothing refers to it any more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    A column of that name keeps its values under another one until ``unnumbered`` gives it back.
    """
    kept = docs.select(*(F.col(f"`{c}`").alias(_OWN + c) if c.lower() == "__n" else F.col(f"`{c}`") for c in docs.columns))
    return checkpointed(kept.withColumn("__n", F.monotonically_increasing_id()))


def unnumbered(rows: DataFrame) -> DataFrame:
    """Numbered rows as they were."""
    left = rows.drop("__n")
    return left.select(*(F.col(f"`{c}`").alias(c.removeprefix(_OWN)) for c in left.columns))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered rows whose number is not in ``gone`` (``__n``), without the number."""
    return unnumbered(rows.join(gone, "__n", "left_anti"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of fewer rows, as a row holds a whole text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


# ---------------------------------------------------------------- hashing

_ODD = 0x9E3779B97F4A7C15 | 1
_RADIX = 0xD6E8FEB86659FD93
_RADIX_INV = pow(_RADIX, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U64)
        while len(have) < n:
            step = U64(pow(base, len(have), 1 << 64))
            have = np.concatenate([have, have * step])
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the others."""
    h = h ^ (h >> U64(32))
    h *= U64(_ODD)
    h ^= h >> U64(29)
    return h


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * radix**position before each position."""
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum((buf.astype(U64) + U64(1)) * _power_table(_RADIX, len(buf)), out=out[1:])
    return out


def gram_hash(buf: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k bytes at each position; depends on those bytes only."""
    if len(buf) < k:
        return np.zeros(0, U64)
    sums = prefix_hash(buf)
    n = len(buf) - k + 1
    return mix((sums[k:] - sums[:n]) * _power_table(_RADIX_INV, n))


class Words:
    """The words of some texts: where each begins and ends in the joined bytes, and its hash.

    ``table`` takes every byte outside a word to a space.
    """

    def __init__(self, texts: list[bytes], table: bytes):
        self.raw = b" ".join(texts).translate(table)
        buf = np.frombuffer(self.raw, np.uint8)
        inside = np.concatenate([[False], buf != 32, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        sums = prefix_hash(buf)
        power = _power_table(_RADIX_INV, len(buf) + 1)
        self.hash = mix((sums[self.ends] - sums[self.starts]) * power[self.starts])
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        #: of each text, the first byte; of each text and the end, the first word
        self.offsets = np.cumsum(sizes) - sizes
        self.bounds = np.append(np.searchsorted(self.starts, self.offsets), len(self.starts))
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def grams(self, n: int, salt: np.ndarray | None = None) -> np.ndarray:
        """Hash of the n words from each word on; those that reach into the next text are not left out."""
        size = max(0, len(self.hash) - n + 1)
        out = np.zeros(size, U64) if salt is None else salt[:size].astype(U64) * U64(_RADIX)
        for k in range(n):
            out += self.hash[k:size + k] * U64(pow(_ODD, 2 * k + 1, 1 << 64))
        return mix(out)

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each word on are in one text."""
        size = max(0, len(self.hash) - n + 1)
        return self.text[:size] == self.text[n - 1:size + n - 1]

    def words(self, first: int, n: int) -> bytes:
        """Words first .. first + n - 1, joined by one space."""
        return b" ".join(self.raw[self.starts[first]:self.ends[first + n - 1]].split())


def blank_table() -> bytes:
    """For words ``[^\\x20\\x09-\\x0D]+``: every blank becomes a space, the rest stays."""
    return bytes(32 if c in b" \t\n\x0b\x0c\r" else c for c in range(256))


# ------------------------------------------------------- blocks and buckets

def power_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, x)))))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def block_column(n: int, *columns: str) -> Column:
    """Deals rows to n blocks by their values, so a lost task deals them alike."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def sorted_unique(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))] if len(values) else values


def bucket_bounds(keys: np.ndarray, bits: int, key_bits: int = 64) -> np.ndarray:
    """Where each of 2**bits buckets, taken by the leading bits, begins and ends in sorted keys."""
    if not bits:
        return np.array([0, len(keys)])
    edges = np.arange(1, 1 << bits, dtype=U64) << U64(key_bits - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays, one after the other, compressed."""
    parts = []
    for a in arrays:
        raw = a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes()
        parts += [len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes, *kinds) -> list:
    """What ``pack`` was given; a kind is a numpy type, or bytes."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(raw[at + 8:at + 8 + n] if kind is bytes else np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at + 8))
        at += 8 + n
    return out


def thin(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as their differences, in as few bytes each as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=U64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def thick(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, U64)
    width = raw[0]
    steps = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    full = np.zeros((len(steps), 8), np.uint8)
    full[:, :width] = steps
    return np.cumsum(full.view("<u8").ravel().astype(U64), dtype=U64)


class Lookup:
    """Positions of 64-bit keys in an array of distinct keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        at = self._first(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(_ODD)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is absent."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self._first(keys)
        out = self.slots[at]
        wrong = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.mask
            out[wrong] = got = self.slots[at[wrong]]
            wrong = wrong[(got >= 0) & (self.keys[got] != keys[wrong])]
        return out
