"""Benchmark decontamination by winnowing.

A window is ``SPAN`` consecutive words of a benchmark item (all of a shorter
item). Of each window the smallest k-gram hash is its fingerprint, with
k = (span + 1) // 2 words, so that any two equal windows have the same
fingerprint: every shared span of at least ``SPAN`` words is met. The
documents are winnowed alike in one pass. Windows whose fingerprint is not
marked in a bitmap of the benchmark's fingerprints stop there. The bitmap has
``SLOTS`` bits or more for each of them, so that one in ``SLOTS`` windows that are not
the benchmark's goes on, from ``2**SLOT_BITS[0]`` up to ``2**SLOT_BITS[1]`` bits (8 MB); a
still larger benchmark only lets more through. The others are joined with the benchmark on
fingerprint and words, which extends each hit to its whole window and leaves
no false match.

Null texts have no words. An item without words has no window. Rows with the
same item id count as one item; items with a null id mark words but are not
listed. Each document row is reported, also with a null or repeated id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import U64, Words, checkpointed, numbered, pieces, texts_of, without, word_table

SPAN = 10
#: bits of the bitmap for each fingerprint of the benchmark; its least and greatest size as powers of two
SLOTS = 16
SLOT_BITS = (22, 26)
_TABLE = word_table()
_HIT = "array<struct<start:long,len:int,fp:long,window:binary>>"


def _gram(span: int) -> int:
    return (span + 1) // 2


def window_fingerprints(words: Words, span: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and fingerprint of each window of ``span`` words inside a text."""
    k = _gram(span)
    value, have, width = words.grams(k), 1, span - k + 1
    while have < width:
        step = min(have, width - have)
        value = np.minimum(value[:len(value) - step], value[step:]) if len(value) > step else value[:0]
        have += step
    own = np.flatnonzero(words.whole(span))
    return own, value[own]


def _marked(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Which fingerprints have their leading bits marked in the packed bitmap."""
    slot = fp >> U64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(item_id, len, fp, window): the different windows of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for a, b in pieces(texts):
                words = Words(texts[a:b], _TABLE)
                rows = []
                sizes = np.diff(words.bounds)
                for n in sorted({min(int(x), span) for x in sizes if x}):
                    own, fp = window_fingerprints(words, n)
                    size = sizes[words.text[own]]
                    some = (size >= span) if n == span else size == n
                    rows += [(ids[a + words.text[i]], n, int(f.astype(np.int64)), words.words(i, n)) for i, f in zip(own[some], fp[some])]
                cols = list(zip(*rows)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                                                 ["item_id", "len", "fp", "window"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.mapInArrow(run, "item_id string, len int, fp long, window binary").distinct()


def bitmap(windows: DataFrame) -> np.ndarray:
    """Which leading bits a fingerprint has, packed; one row for 64 bits at most reaches the driver."""
    least, most = SLOT_BITS
    count = windows.agg(F.count_distinct("fp").alias("n")).first()["n"]
    size = min(most, max(least, (count * SLOTS).bit_length()))
    slots = windows.select(F.shiftrightunsigned("fp", 64 - size).alias("slot"))
    words = slots.select(F.shiftright("slot", 6).alias("at"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    out = np.zeros(1 << (size - 6), "<i8")
    for row in words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        out[row["at"]] = row["bits"]
    return out.view(np.uint8)


def _candidates(marked: np.ndarray, spans: list[int]):
    packed = marked.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(packed, np.uint8)
        for batch in batches:
            texts = texts_of(batch.column(1))
            n_words, hits = [], []
            for a, b in pieces(texts):
                words = Words(texts[a:b], _TABLE)
                n_words += np.diff(words.bounds).tolist()
                found: list[list] = [[] for _ in range(a, b)]
                for n in spans:
                    own, fp = window_fingerprints(words, n)
                    some = _marked(held, fp)
                    for i, f in zip(own[some], fp[some]):
                        t = words.text[i]
                        found[t].append({"start": int(i - words.bounds[t]), "len": n, "fp": int(f.astype(np.int64)), "window": words.words(i, n)})
                hits += found
            kind = pa.list_(pa.struct([("start", pa.int64()), ("len", pa.int32()), ("fp", pa.int64()), ("window", pa.binary())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(hits, kind)], ["doc_id", "n_words", "hits"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """Per document row: n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = checkpointed(benchmark_windows(benchmark, span))
    # at most ``span`` rows
    spans = sorted(r["len"] for r in windows.select("len").distinct().collect())
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _candidates(bitmap(windows), spans), f"doc_id long, n_words long, hits {_HIT}")
    found = checkpointed(found.withColumn("__row", F.monotonically_increasing_id()))
    hits = found.select("__row", F.explode("hits").alias("h")).select("__row", "h.*")
    hits = hits.join(windows.select("fp", "window").distinct(), ["fp", "window"], "left_semi")
    by_place = Window.partitionBy("__row").orderBy("start", "len")
    far = F.max(F.col("start") + F.col("len")).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("len")
    counted = hits.select("__row", F.greatest(end - F.greatest("start", F.coalesce(far, F.lit(0))), F.lit(0)).alias("new"))
    counted = counted.groupBy("__row").agg(F.sum("new").alias("n_hit"))
    items = (hits.select("__row", "fp", "window").distinct().join(windows.select("fp", "window", "item_id"), ["fp", "window"])
             .select("__row", "item_id").where("item_id is not null").distinct()
             .groupBy("__row").agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    out = found.select("__row", "doc_id", "n_words").join(counted, "__row", "left").join(items, "__row", "left")
    listed = F.coalesce(F.concat_ws(",", "items"), F.lit(""))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` whose id no row with a word inside a benchmark window has; rows with a null id stay."""
    bad = contamination(docs, benchmark, span).where("contaminated").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(bad, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def drop_contaminated_rows(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` without a word inside a benchmark window, each decided by itself, whatever its id."""
    rows = numbered(docs)
    found = contamination(rows.withColumn("doc_id", F.col("__n")), benchmark, span)
    return without(rows, found.where("contaminated").select(F.col("doc_id").alias("__n")))
