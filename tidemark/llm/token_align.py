"""Alignment of two tokenizers by divide and conquer at shared cuts.

Both tokenizers cut the same bytes. ``shared_cuts`` starts from one interval for
each text, whose ends both share. From the token end of A in the middle of an
interval it looks by bisection for the nearest end that both have, to the right and
then to the left; there the interval is divided, and both halves are treated alike.
An interval without a shared end inside is a leaf: its tokens form one group, and
every A token of a group is linked with every B token of it. All intervals of
one depth take their steps together.

A text is encoded in chunks: where a space stands between two characters that are
no blanks, no token of A or of B spans it (A splits words there before merging, and
no piece of B has a space after another character), so long texts need
no more memory than short ones. Tests compare whole texts.

Counts over all documents: each block of documents (``BLOCK`` bytes of text)
writes what its documents are, and once what different id pairs they link, with the
number of documents. These narrow rows are added up by pair; what a block
needs of the sums comes back to it and is met with its documents, whose links
were written as well, so that nothing is encoded twice. A hot pair is one row of a block.

Texts that are null, empty, or that either tokenizer does not give back byte by
byte have no tokens: zeros and an empty column. Rows count as documents of
their own, also with a null or repeated id.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pack, unpack
from tidemark.session import checkpoint_dir

#: where the vocabulary files are, and which are A and B
FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# fixed value: how the vocabulary of A cuts a text before merging
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: an id pair is A's id * SHIFT + B's id
SHIFT = 1 << 21
#: bytes of text in a block
BLOCK = 16 << 20
#: characters of a chunk, and bytes of the chunks that are encoded together
CHUNK, TOGETHER = 1 << 15, 1 << 19
#: links of a group that are written out one by one; beyond, equal ids are counted first
WRITTEN = 1 << 12

_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids and bytes of one tokenizer's tokens; ``table`` has the bytes of each id."""

    def __init__(self, table: list[bytes], encode):
        self.table, self.encode = table, encode
        self.sizes = np.array([len(t) for t in table], np.int64)
        names = [str(i) for i in range(len(table))]
        #: an id as text, followed by each of the separators
        self.text = {c: np.array([n + c for n in names], object) for c in ",|;"}


@lru_cache(maxsize=4)
def encoders(folder: str) -> tuple[Encoder, Encoder]:
    from sentencepiece import SentencePieceProcessor
    from tiktoken import Encoding

    with open(os.path.join(folder, BYTE_FILE), encoding="utf-8") as f:
        kept = json.load(f)
    model, special = kept["model"], {t["id"] for t in kept["added_tokens"]}
    alphabet = byte_alphabet()
    table: list[bytes] = [b""] * (max(model["vocab"].values()) + 1)
    for name, i in model["vocab"].items():
        table[i] = name.encode() if i in special else bytes(alphabet[c] for c in name)
    # ids can stand for the order of merges only if they are in that order
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
        raise ValueError(f"{BYTE_FILE} does not number its tokens by their merges")
    a = Encoding("bytes", pat_str=WORD_PATTERN, mergeable_ranks={table[i]: i for i in range(256 + len(merged))}, special_tokens={})
    b = SentencePieceProcessor(model_file=os.path.join(folder, PIECE_FILE))
    pieces = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in enumerate(b.id_to_piece(list(range(b.get_piece_size()))))]

    def encode_a(chunks: list[str]) -> list[list[int]]:
        return [a.encode_ordinary(" " + c) for c in chunks]

    return Encoder(table, encode_a), Encoder(pieces, lambda chunks: b.encode(chunks, num_threads=1))


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """``text`` in parts of about ``size`` characters, without the spaces at which it was cut."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def _searched(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The first end at or after each value; values are at most the last end."""
    return ends[np.searchsorted(ends, values)]


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sorted ends that both lists have; ``bounds`` are 0 and the shared ends of the texts."""
    found = [bounds[1:]]
    lo, hi = bounds[:-1], bounds[1:]
    first, last = np.searchsorted(a_ends, lo, "right"), np.searchsorted(a_ends, hi)
    while len(lo):
        # an interval of one A token has no end of A inside
        open_ = last > first
        lo, hi, first, last = lo[open_], hi[open_], first[open_], last[open_]
        middle = a_ends[(first + last - 1) // 2]
        cut = np.full(len(lo), -1, np.int64)
        # to the right: the two lists give each other the next end, until both have it or the interval ends
        todo, at = np.arange(len(lo)), middle
        while len(todo):
            other = _searched(b_ends, at)
            same = (other == at) & (at < hi[todo])
            cut[todo[same]] = at[same]
            go = ~same & (other < hi[todo])
            todo = todo[go]
            at = _searched(a_ends, other[go])
        # to the left, where there was none
        todo = np.flatnonzero(cut < 0)
        at = middle[todo]
        while len(todo):
            place = np.searchsorted(a_ends, at)
            at = np.where(place > 0, a_ends[np.maximum(place, 1) - 1], 0)
            go = (at > lo[todo]) & (at < hi[todo])
            todo, at = todo[go], at[go]
            place = np.searchsorted(b_ends, at, "right") - 1
            other = np.where(place >= 0, b_ends[np.maximum(place, 0)], 0)
            same = other == at
            cut[todo[same]] = at[same]
            go = ~same & (other > lo[todo])
            # the next end of A at or before that of B
            todo, at = todo[go], other[go] + 1
        some = cut >= 0
        found.append(cut[some])
        lo, hi, cut, first, last = lo[some], hi[some], cut[some], first[some], last[some]
        at = np.searchsorted(a_ends, cut)
        lo, hi = np.concatenate([lo, cut]), np.concatenate([cut, hi])
        first, last = np.concatenate([first, at + 1]), np.concatenate([at, last])
    return np.sort(np.concatenate(found))


class Aligned:
    """The groups of some texts, of whose tokens A's and B's ids are given, each text's one after the other.

    ``n_a`` and ``n_b`` are the tokens of each text; the bytes of both sides are the same.
    """

    def __init__(self, a: Encoder, b: Encoder, a_ids: np.ndarray, b_ids: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.a, self.b, self.a_ids, self.b_ids, self.n_a, self.n_b = a, b, a_ids, b_ids, n_a, n_b
        a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])
        last = np.cumsum(n_a)
        text_ends = a_ends[last[n_a > 0] - 1]
        cuts = shared_cuts(a_ends, b_ends, np.append(0, text_ends)) if len(a_ids) else np.zeros(0, np.int64)
        a_last, b_last = np.searchsorted(a_ends, cuts) + 1, np.searchsorted(b_ends, cuts) + 1
        self.a_size, self.b_size = np.diff(a_last, prepend=0), np.diff(b_last, prepend=0)
        self.a_first, self.b_first = a_last - self.a_size, b_last - self.b_size
        #: of each text and the end, its first group
        self.bounds = np.searchsorted(a_last, np.append(0, last), "right")
        self.n_groups = np.diff(self.bounds)
        sums = np.append(0, np.cumsum(self.a_size * self.b_size))
        self.n_links = sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def group_texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        parts = np.empty(len(self.a_ids) + len(self.b_ids), object)
        for ids, first, size, encoder, shift, closing in ((self.a_ids, self.a_first, self.a_size, self.a, self.b_first, "|"),
                                                          (self.b_ids, self.b_first, self.b_size, self.b, self.a_first + self.a_size, ";")):
            at = np.arange(len(ids)) + np.repeat(shift, size)
            parts[at] = encoder.text[","][ids]
            end = first + size - 1
            parts[at[end]] = encoder.text[closing][ids[end]]
        listed = parts.tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(listed[s:e])[:-1] for s, e in zip([0, *ends], ends)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id pair, occurrences) of the different linked pairs of each text, by text and pair."""
        text = np.repeat(np.arange(len(self.n_groups)), self.n_groups)
        product = self.a_size * self.b_size
        few = np.flatnonzero(product <= WRITTEN)
        group = np.repeat(few, product[few])
        place = np.arange(len(group)) - np.repeat(np.cumsum(product[few]) - product[few], product[few])
        pair = (self.a_ids[self.a_first[group] + place // self.b_size[group]] * SHIFT
                + self.b_ids[self.b_first[group] + place % self.b_size[group]])
        texts, pairs, times = [text[group]], [pair], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(product > WRITTEN):
            a, m = np.unique(self.a_ids[self.a_first[g]:self.a_first[g] + self.a_size[g]], return_counts=True)
            b, n = np.unique(self.b_ids[self.b_first[g]:self.b_first[g] + self.b_size[g]], return_counts=True)
            pairs.append((a[:, None] * SHIFT + b).ravel())
            times.append((m[:, None] * n).ravel())
            texts.append(np.full(len(pairs[-1]), text[g]))
        return summed(np.concatenate(texts), np.concatenate(pairs), np.concatenate(times))


def summed(text: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (text, pair) added up, sorted."""
    order = np.lexsort((pair, text))
    text, pair, times = text[order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])])) if len(text) else np.zeros(0, int)
    return text[first], pair[first], np.add.reduceat(times, first) if len(first) else times


def encode_texts(texts: list[str | None], folder: str = FOLDER) -> Iterator[tuple[int, Aligned]]:
    """Ranges of texts, each with its first text's place; a text that does not come back whole has no tokens."""
    a, b = encoders(folder)

    def encoded(start: int, parts: list[list[str]]) -> tuple[int, Aligned]:
        flat = [c for p in parts for c in p]
        both = [e.encode(flat) if flat else [] for e in (a, b)]
        ids, counts, at = ([], []), ([], []), 0
        for p in parts:
            own = [[i for part in side[at:at + len(p)] for i in part] for side in both]
            want = b"".join(b" " + c.encode() for c in p)
            at += len(p)
            if any(b"".join(map(e.table.__getitem__, o)) != want for e, o in zip((a, b), own)):
                own = [[], []]
            for k in range(2):
                ids[k].extend(own[k])
                counts[k].append(len(own[k]))
        return start, Aligned(a, b, *(np.array(x, np.int64) for x in (*ids, *counts)))

    start, parts, held = 0, [], 0
    for i, text in enumerate(texts):
        if held >= TOGETHER:
            yield encoded(start, parts)
            start, parts, held = i, [], 0
        parts.append(chunks(text) if text else [])
        held += len(text or "")
    if parts:
        yield encoded(start, parts)


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    return pack(np.diff(pairs, prepend=0).astype(np.int64), times.astype(np.uint32))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, times = unpack(blob, np.int64, np.uint32)
    return np.cumsum(steps), times.astype(np.int64)


_ALIGNED = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, block_links binary"


def align(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Per row its tokens' and groups' numbers, ``groups`` as text, and its links; ``block`` is the block it is in.

    ``block_links``, in the last row of a block only, has its different pairs and how many of its rows link each.
    """

    def rows_of(batch: pa.RecordBatch, block: list[int]) -> Iterator[tuple]:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for start, got in encode_texts(texts, folder):
            text, pair, times = got.links()
            bounds = np.searchsorted(text, np.arange(len(got.n_a) + 1))
            for k, groups in enumerate(got.group_texts()):
                own = slice(bounds[k], bounds[k + 1])
                yield (len(texts[start + k] or ""), ids[start + k], int(got.n_a[k]), int(got.n_b[k]), int(got.n_groups[k]), int(got.n_links[k]), groups,
                       pair[own], times[own])

    def table(block: int, rows: list[tuple], last: bytes | None) -> pa.RecordBatch:
        cols = list(zip(*rows))
        links = [_packed(p, t) for p, t in zip(cols[7], cols[8])]
        arrays = [pa.array([block] * len(rows), pa.int64()), *(pa.array(c, pa.int64()) for c in cols[1:6]), pa.array(cols[6], pa.string()),
                  pa.array(links, pa.binary()), pa.array([None] * (len(rows) - 1) + [last], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _ALIGNED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        seen = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        size = waiting = 0

        def gathered() -> tuple[np.ndarray, np.ndarray]:
            pairs = np.concatenate([seen[0], *(r[7] for r in rows)])
            docs_ = np.concatenate([seen[1], np.ones(len(pairs) - len(seen[0]), np.int64)])
            return summed(np.zeros(len(pairs), np.int8), pairs, docs_)[1:]

        for batch in batches:
            for row in rows_of(batch, block):
                # the last row of a block closes it, so one is held back
                if rows and (waiting >= TOGETHER * 2 or size >= BLOCK):
                    seen = gathered()
                    full = size >= BLOCK
                    yield table(block, rows, _packed(*seen) if full else None)
                    rows, waiting = [], 0
                    if full:
                        block, size, seen = block + 1, 0, (np.zeros(0, np.int64),) * 2
                rows.append(row)
                size, waiting = size + row[0] + 1, waiting + row[0] + 1
        if rows:
            yield table(block, rows, _packed(*gathered()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair) of every block, and (pair, docs, best) of every pair.

    ``docs`` is the number of documents that link the pair, ``best`` whether no pair of the same A id has more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pairs, n = _unpacked(blob)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(n)], ["block", "pair", "n"])

    wanted = aligned.where("block_links IS NOT NULL").select("block", "block_links").mapInArrow(run, "block long, pair long, n long")
    counts = wanted.groupBy("pair").agg(F.sum("n").alias("docs"))
    a_id = F.expr(f"pair div {SHIFT}")
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("highest"))
    # a row for each id of A at most
    counts = counts.withColumn("a_id", a_id).join(highest, "a_id").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    return wanted.select("block", "pair"), counts


_NUMBERS = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]


def scored(aligned: DataFrame, *columns: str) -> DataFrame:
    """Per row its numbers, ``n_best`` and ``count_sum`` by the counts over all rows, and ``columns``.

    ``aligned`` is read more than once: write it first.
    """
    wanted, counts = pair_counts(aligned)
    answers = wanted.join(counts, "pair").select("block", "pair", "docs", "best")
    keep = [*_NUMBERS, *columns]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pair, docs, best = (right.column(c).to_numpy() for c in ("pair", "docs", "best"))
        order = np.argsort(pair)
        pair, docs, best = pair[order], docs[order], best[order].astype(np.int64)
        sums = []
        for blob in left.column("links").to_pylist():
            own, times = _unpacked(blob)
            at = np.searchsorted(pair, own)
            sums.append((int((times * best[at]).sum()), int((times * docs[at]).sum())))
        return pa.table([*(left.column(c) for c in keep), *(pa.array([x[k] for x in sums], pa.int64()) for k in range(2))],
                        names=[*keep, "n_best", "count_sum"])

    rows = aligned.select("block", *keep, "links")
    schema = aligned.select(*keep).withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")}).schema
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def alignment_digest(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Per row the numbers of tokens, groups and links, the links' counts, and a digest of the groups ('' where there are none).

    What is aligned is written to the shared folder, with the digest in place of the groups.
    """
    spark = docs.sparkSession
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.encode("groups", "UTF-8"), 256))
    place = f"{checkpoint_dir(spark).rstrip('/')}/aligned-{uuid.uuid4().hex}"
    align(docs, folder).withColumn("groups_sha256", digest).drop("groups").write.parquet(place)
    return scored(spark.read.parquet(place), "groups_sha256")
