"""Periodic runs of words, found on a run-length grammar built by recompression.

The words of many texts stand one after the other, with a separator of its own
before each and after the last. ``Grammar`` shortens that sequence in turns: a
round of block compression names every stretch of one symbol by (symbol, length),
a round of pair compression deals the symbols to two sides by a hash and names
every pair of a left and a right neighbour. What a symbol becomes depends on its
neighbours alone, so equal stretches of words get equal names but at their ends,
and two places are compared by climbing to the largest common names and, at the
first difference, descending again: an exact extension in a logarithmic number of
steps. All queries of a batch take their steps together.

A run of period q has a matched stretch (words equal to those q further on) of at
least max(q, LEAST - q) words, so one of the places 0, s, 2s, ... with s of that
size lies in it. These places, harmonically many over all q, are the candidates.
Each whose two words agree is extended both ways by the grammar. Candidates of
one stretch that agree in start and end are one run, with the smallest q.

Names are given by sorting, not by hashes of words: results are exact. A task
holds the words of ``WORDS`` words of texts or of one longer text. Null and empty texts have no
words and no runs. Rows are judged by themselves, so ids may be null or repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, mix, texts_of

#: least length of a run in words
LEAST = 12
#: words taken through one grammar
WORDS = 1 << 16
#: candidates held at a time
CANDIDATES = 1 << 20
#: a sequence this short is not compressed further
TOP = 24


class Grammar:
    """Levels of a compressed sequence, all nodes in one numbering; level 0 are the symbols given.

    ``parent`` is the node above, ``head`` and ``tail`` the outermost nodes below,
    ``opens`` and ``shuts`` whether a node is the first or last of its parent,
    ``after`` and ``before`` how many nodes of its block there are from it on, to either side, itself included.
    """

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        names, parents, heads, tails, blocks = [symbols.astype(np.int64)], [], [], [], []
        fresh, failed, level = int(symbols.max(initial=0)) + 1, 0, 0
        while len(names[-1]) > TOP and failed < 4:
            now, level = names[-1], level + 1
            first = self._blocks(now) if level % 2 else self._pairs(now, level)
            if len(first) == len(now):
                failed += 1
                continue
            failed = 0
            last = np.append(first[1:], len(now)) - 1
            upper, joined = now[first], np.flatnonzero(last > first)
            second = last[joined] - first[joined] if level % 2 else now[last[joined]]
            _, number = np.unique(upper[joined] * np.int64(max(fresh, len(now) + 1)) + second, return_inverse=True)
            upper[joined] = fresh + number
            fresh += int(number.max(initial=-1)) + 1
            names.append(upper)
            parents.append(np.repeat(np.arange(len(first)), last - first + 1))
            heads.append(first)
            tails.append(last)
            blocks.append(bool(level % 2))
        self._number(names, parents, heads, tails, blocks)

    @staticmethod
    def _blocks(now: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]]))

    @staticmethod
    def _pairs(now: np.ndarray, level: int) -> np.ndarray:
        salt = U64(level * 0xD1342543DE82EF95 % (1 << 64))
        right = mix(now.astype(U64) ^ salt) >> U64(63) == 1
        ends = ~right[:-1] & right[1:]
        other = right[:-1] & ~right[1:]
        if other.sum() > ends.sum():
            ends = other
        # equal neighbours stand only where the last round of blocks was left out, and never form a pair
        return np.flatnonzero(np.concatenate([[True], ~ends]))

    def _number(self, names, parents, heads, tails, blocks) -> None:
        sizes = np.array([len(x) for x in names])
        at = np.concatenate([[0], np.cumsum(sizes)])
        total, low, top = int(at[-1]), self.size, int(at[-2])
        self.symbol = np.concatenate(names)
        self.parent = np.full(total, -1, np.int32)
        self.head, self.tail = np.arange(total, dtype=np.int32), np.arange(total, dtype=np.int32)
        self.opens, self.shuts = np.zeros(total, bool), np.zeros(total, bool)
        self.after, self.before = np.ones(total, np.int32), np.ones(total, np.int32)
        self.start, self.end = np.arange(total), np.arange(total) + 1
        for h, (parent, head, tail, block) in enumerate(zip(parents, heads, tails, blocks)):
            lower, upper = slice(at[h], at[h + 1]), slice(at[h + 1], at[h + 2])
            self.parent[lower] = parent + at[h + 1]
            self.head[upper], self.tail[upper] = head + at[h], tail + at[h]
            self.opens[at[h] + head] = True
            self.shuts[at[h] + tail] = True
            self.start[upper], self.end[upper] = self.start[at[h] + head], self.end[at[h] + tail]
            if block:
                place = np.arange(len(parent))
                self.after[lower], self.before[lower] = tail[parent] - place + 1, place - head[parent] + 1
        self.low, self.top = low, top

    def _extend(self, i: np.ndarray, j: np.ndarray, edge, run, below, sign: int) -> tuple[np.ndarray, np.ndarray]:
        """The first pair of level-0 nodes that differ, from nodes i and j on in steps of ``sign``."""
        left, right = np.empty(len(i), np.int64), np.empty(len(i), np.int64)
        live, a, b, down = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64), np.zeros(len(i), bool)
        while len(live):
            up = ~down & edge[a] & edge[b]
            same = self.symbol[a] == self.symbol[b]
            step = np.where(same & ~up, np.minimum(run[a], run[b]) * sign, 0)
            miss = ~same & ~up
            done = miss & (a < self.low)
            down |= miss
            a, b = (np.where(up, self.parent[x], np.where(miss, below[x], x + step)) for x in (a, b))
            if done.any():
                left[live[done]], right[live[done]] = a[done], b[done]
                keep = ~done
                live, a, b, down = live[keep], a[keep], b[keep], down[keep]
        return left, right

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i on equal those from j on; i and j differ."""
        return self._extend(i, j, self.opens, self.after, self.head, 1)[0] - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols up to and with i equal those up to and with j."""
        return i - self._extend(i, j, self.shuts, self.before, self.tail, -1)[0]


def candidates(offsets: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the harmonic grids of some texts, in ranges of about ``CANDIDATES``."""
    halves = counts // 2
    text = np.repeat(np.arange(len(counts)), halves)
    period = np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    step = np.maximum(period, least - period)
    places = -(-(counts[text] - period) // step)
    ends = np.cumsum(places)
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CANDIDATES, "right")))
        own = np.repeat(np.arange(a, b), places[a:b])
        number = np.arange(len(own)) - np.repeat(ends[a:b] - places[a:b] - (ends[a - 1] if a else 0), places[a:b])
        yield offsets[text[own]] + number * step[own], period[own]
        a = b


def find_runs(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """Of each text, given as word numbers, the runs as rows (start, length, period) by start, then period.

    A run is a stretch with smallest period q that no neighbouring word extends, of at least max(least, 2 q) words.
    """
    counts = np.array([len(t) for t in texts], np.int64)
    # a separator of its own before each text and after the last
    ends = np.cumsum(counts + 1)
    offsets = ends - counts
    line = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    words = max((int(t.max(initial=-1)) for t in texts), default=-1) + 1
    line[np.append(offsets - 1, len(line) - 1)] = words + np.arange(len(texts) + 1)
    for t, o in zip(texts, offsets):
        line[o:o + len(t)] = t
    grammar = Grammar(line)
    found = []
    for place, period in candidates(offsets, np.where(counts < least, 0, counts), least):
        hit = np.flatnonzero(line[place] == line[place + period])
        place, period = place[hit], period[hit]
        ahead = grammar.forward(place, place + period)
        back = grammar.backward(place - 1, place + period - 1)
        long = ahead + back + period >= np.maximum(least, 2 * period)
        found.append(np.stack([place - back, ahead + back + period, period], 1)[long])
    if not found:
        return [np.zeros((0, 3), np.int64) for _ in texts]
    runs = np.concatenate(found)
    # of the periods of one stretch, the smallest
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(1)])] if len(runs) else runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    bounds = np.append(np.searchsorted(runs[:, 0], offsets), len(runs))
    return [runs[x:y] - np.array([o, 0, 0]) for x, y, o in zip(bounds, bounds[1:], offsets)]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when of every run only its first period does."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _word_numbers(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` has the words that are in the first period of every run they are in, joined by one space.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        runs = find_runs([_word_numbers(t, known) for t in texts], least)
        kept = [b" ".join(compress(t, kept_words(len(t), r).tolist()) if len(r) else t) for t, r in zip(texts, runs)]
        sizes = np.array([len(r) for r in runs])
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type.value_type))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), items)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), lists,
                                           pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = t.split()
                if held and held + len(words) > WORDS:
                    yield done(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(words)
                held += len(words)
            yield done(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, every tenth document by the crc32 of its id with a periodic end; null ids never.

    With h that crc32, g = h // 10 and n words, each word i >= a = g % n becomes
    the word a + (i - a) % p, with p = 1 + (n - a) // (3 + g % 8).
    """

    def change(doc_id: int | None, text: bytes) -> bytes:
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        words = text.split() if h % 10 == 0 else []
        if not words:
            return text
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [change(i, t) for i, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, text string")


def run_digest(collapsed: DataFrame) -> DataFrame:
    """Per row the number of runs, the longest one (ties: smallest start), and digests of all runs and of the kept words."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    text = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = collapsed.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"), "n_words")
