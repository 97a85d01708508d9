"""SimHash near-duplicates, found through Golay-coded fingerprint segments.

*Fingerprint.* 64 bits; a bit is 1 if it is set in over half of the XXH64
values (seed 42) of a text's word shingles.

*Keys.* A fingerprint is cut into four segments of 16 bits. Two fingerprints
that differ in at most three bits either agree in two segments, or agree in
one and differ by exactly one bit in each of the others. The first case is
met by a key for each pair of segments. For the second each segment is
joined with codeword indices of its successor: the 16 bits are padded to a
word of the perfect (23, 12) Golay code, and the word and its 16 one-bit
neighbours are decoded to their codewords, which gives a handful of indices.
Of two words at distance one each is among the other's neighbours, so that
they have an index in common. So every linked pair shares a key.

*Join and verify.* Only different fingerprints are compared: copies are one
row long before. A key with more than ``GROUP`` fingerprints is dealt into tiles
by a hash, and every pair of tiles is a group of its own, of about ``GROUP``
fingerprints; so neither a task's memory nor its time depends on the size of a
key. Of a group a spanning forest of its links is kept, not all pairs. The links
give components by alternating minimum steps, each written to the shared
folder.

Null or empty text, or text without a word, has fingerprint zero and is
linked like any other. Rows with the same id stay rows of their own. A null
id is no candidate for a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, ascii_lower_table, checkpointed, numbered, pieces, sorted_unique, texts_of, without

BITS, SEGMENTS = 64, 4
SEGMENT = BITS // SEGMENTS
#: generator polynomial of the binary Golay code, a fixed value: x^11+x^10+x^6+x^5+x^4+x^2+1
GENERATOR = 0b110001110101
#: fingerprints compared at a time
TILE = 2048
#: fingerprints in a group; larger keys are dealt into pairs of tiles
GROUP = 1 << 15


# ------------------------------------------------------------- fingerprints

def fingerprints(texts: list[bytes], words_per_shingle: int) -> np.ndarray:
    """SimHash of each text; the texts are in lower case already."""
    digest, hashes, sizes = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.split()
        if len(words) <= words_per_shingle:
            hashes += [digest(b" ".join(words), 42)] if words else []
            sizes.append(1 if words else 0)
            continue
        flat = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-words_per_shingle]]).tolist()
        stops = (ends[words_per_shingle - 1:] - 1).tolist()
        hashes += [digest(flat[a:b], 42) for a, b in zip(starts, stops)]
        sizes.append(len(stops))
    out = np.zeros(len(texts), U64)
    size = np.array(sizes, np.int64)
    some = np.flatnonzero(size)
    if len(some):
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = (np.cumsum(size) - size)[some]
        counts = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[some] = np.packbits(counts * 2 > size[some, None], axis=1).view(">u8").ravel().astype(U64)
    return out


def with_fingerprint(docs: DataFrame, words_per_shingle: int, *keep: str) -> DataFrame:
    """(doc_id, fp long) of every row, and the columns ``keep``."""
    lower = ascii_lower_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.translate(lower) for t in texts_of(batch.column(1))]
            fps = [fingerprints(texts[a:b], words_per_shingle) for a, b in pieces(texts)]
            fp = np.concatenate(fps).view(np.int64) if fps else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), *(batch.column(c) for c in keep)], ["doc_id", "fp", *keep])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
    return rows.mapInArrow(run, rows.withColumn("fp", F.lit(0).cast("long")).select("doc_id", "fp", *keep).schema)


# -------------------------------------------------------------------- Golay

def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@lru_cache(1)
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each single bit, and error pattern of each syndrome."""
    single = np.array([_remainder(1 << b) for b in range(23)], np.uint32)
    pattern = np.zeros(1 << 11, np.uint32)
    for n in range(4):
        for bits in combinations(range(23), n):
            syndrome = 0
            for b in bits:
                syndrome ^= int(single[b])
            pattern[syndrome] = sum(1 << b for b in bits)
    return single, pattern


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (the 12 data bits) of the codeword within distance three of each 23-bit word."""
    single, pattern = _decoder()
    syndrome = np.zeros(len(words), np.uint32)
    for b in range(23):
        syndrome ^= np.where(words >> np.uint32(b) & np.uint32(1), single[b], np.uint32(0))
    return (words ^ pattern[syndrome]) >> np.uint32(11)


@lru_cache(1)
def near_codewords() -> tuple[np.ndarray, np.ndarray]:
    """For each 16-bit segment its distinct codeword indices: where they begin, and the indices."""
    segment = np.arange(1 << SEGMENT, dtype=np.uint32)
    flips = np.array([0] + [1 << b for b in range(SEGMENT)], np.uint32)
    # the data bits are the upper twelve: pad below them
    words = ((segment[:, None] ^ flips) << np.uint32(23 - SEGMENT)).ravel()
    pairs = sorted_unique(segment.repeat(len(flips)).astype(U64) << U64(12) | codeword_index(words).astype(U64))
    return np.searchsorted(pairs >> U64(12), np.arange((1 << SEGMENT) + 1)), (pairs & U64(4095)).astype(np.int64)


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) of every key."""
    segment = [(fp >> U64(SEGMENT * s) & U64((1 << SEGMENT) - 1)).astype(np.int64) for s in range(SEGMENTS)]
    here, rows, keys = np.arange(len(fp)), [], []
    for n, (a, b) in enumerate(combinations(range(SEGMENTS), 2)):
        rows.append(here)
        keys.append(n << 32 | segment[a] << SEGMENT | segment[b])
    begin, index = near_codewords()
    for a in range(SEGMENTS):
        b = (a + 1) % SEGMENTS
        first, count = begin[segment[b]], begin[segment[b] + 1] - begin[segment[b]]
        row = np.repeat(here, count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        rows.append(row)
        keys.append((6 + a) << 32 | segment[a][row] << 12 | index[first[row] + nth])
    return np.concatenate(rows), np.concatenate(keys)


# -------------------------------------------------------------------- links

def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def group_links(fp: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one group of different fingerprints."""
    parent, out = np.arange(len(fp)), []
    for a in range(0, len(fp), TILE):
        for b in range(a, len(fp), TILE):
            near = np.bitwise_count(fp[a:a + TILE, None] ^ fp[None, b:b + TILE]) <= most
            for i, j in np.argwhere(np.triu(near, 1) if a == b else near):
                x, y = _find(parent, a + int(i)), _find(parent, b + int(j))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((a + int(i), b + int(j)))
    return out


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy().view(U64)
        for a in range(0, len(fp), 8192):
            row, key = keys_of(fp[a:a + 8192])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[a:a + 8192][row].view(np.int64))], ["key", "fp"])


def _link_batches(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key, part and fingerprint; a group may go on in the next batch."""
        held_key, held_part, held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)

        def links(cut: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            size, first = np.diff(cut), cut[:-1]
            group = np.repeat(np.arange(len(size)), size)
            # small groups: neighbours at each distance in the sorted order, all groups together
            a, b = [], []
            small = np.repeat(size <= 16, size)
            for step in range(1, 16):
                i = np.flatnonzero(small[:-step] & (group[step:] == group[:-step])) if step < len(group) else np.zeros(0, np.int64)
                i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= most]
                a.append(fp[i])
                b.append(fp[i + step])
            for f, n in zip(first[size > 16], size[size > 16]):
                own = fp[f:f + n]
                pairs = np.array(group_links(own, most), np.int64).reshape(-1, 2)
                a.append(own[pairs[:, 0]])
                b.append(own[pairs[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            part = np.concatenate([held_part, batch.column("part").to_numpy()])
            fp = np.concatenate([held, batch.column("fp").to_numpy().view(U64)])
            if len(key):
                cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]), [True]]))
                last = cut[-2]
                if last:
                    yield links(cut[:-1], fp[:last])
                held_key, held_part, held = key[last:], part[last:], fp[last:]
        if len(held):
            yield links(np.array([0, len(held)]), held)

    return run


def grouped(fps: DataFrame, most_rows: int) -> DataFrame:
    """(key, part, fp): any two fingerprints with a common key share a group (key, part), which has about ``most_rows`` rows at most.

    The keys that are too large are few: each has over ``most_rows`` of the rows.
    """
    keyed = fps.select("fp").mapInArrow(_key_batches, "key long, fp long")
    tiles = F.ceil(F.col("n") * 2 / most_rows).cast("long")
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_rows).select("key", tiles.alias("tiles"))
    dealt = keyed.join(checkpointed(large), "key", "left").withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda o: o != F.col("tile"))
    pairs = F.transform(others, lambda o: F.least(o, "tile") * F.col("tiles") + F.greatest(o, "tile"))
    whole = F.array(F.lit(-1).cast("long"))
    return dealt.select("key", F.explode(F.when(F.col("tiles").isNull(), whole).otherwise(pairs)).alias("part"), "fp")


def links_between(fps: DataFrame, most: int, most_rows: int | None = None) -> DataFrame:
    """(a, b): links that connect what all links of at most ``most`` bits connect; ``fps`` has different values."""
    if most > SEGMENTS - 1:
        raise ValueError("the keys are complete up to three differing bits")
    ordered = grouped(fps, most_rows or GROUP).repartition("key", "part").sortWithinPartitions("key", "part", "fp")
    return ordered.mapInArrow(_link_batches(most), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(fp, root): of each linked value the smallest value that is reachable.

    Alternates the large-star and small-star steps: a value's greater
    neighbours are moved to the smallest of its neighbours, then its smaller
    neighbours and itself. Ends when a round leaves the edges as they were.
    """
    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        moved = edges.join(low, "u")
        edges = checkpointed(moved.select(F.col("v").alias("u"), F.col("low").alias("v"))
                             .union(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        before = now


def _components_of(rows: DataFrame, first: Column, max_bits: int) -> DataFrame:
    """(fp, component): of each fingerprint in ``rows`` the least ``first`` of its component's rows."""
    classes = checkpointed(rows.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(links_between(classes, max_bits))
    linked = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = linked.groupBy("root").agg(F.min("first").alias("component"))
    return linked.select("fp", "root").join(low, "root").select("fp", "component")


def near_groups(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id of every row."""
    rows = checkpointed(with_fingerprint(docs, words_per_shingle))
    named = _components_of(rows, F.col("doc_id"), max_bits).withColumnRenamed("component", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of each group that has it, or null."""
    groups = near_groups(docs, words_per_shingle, max_bits)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def keep_one_of_each(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` of each group, whatever the ids: that with the smallest id (null ids last), of several the first numbered."""
    rows = numbered(docs)
    marked = checkpointed(with_fingerprint(rows, words_per_shingle, "__n"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__n")
    named = _components_of(marked, first, max_bits).select("fp", F.col("component.__n").alias("__kept"))
    return without(rows, marked.join(named, "fp").where("__n <> __kept").select("__n"))
