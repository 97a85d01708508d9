"""Quality scores from compression with two dictionaries.

A zstandard dictionary is built from labelled good texts and one from bad
ones. A text is compressed in chunks with each; the difference of the two
sizes, divided by the text's bytes, says which of them it is more like. A
logistic curve, fitted to labelled texts that no dictionary was built from,
turns the difference into a probability.

The dictionaries and the curve are fitted on a bounded sample: of each label
the ``SAMPLE`` documents with the smallest hash of id (half for the
dictionaries, half for the curve) of at most ``LONGEST`` bytes each. Every row
is scored on its whole text. Null text is the empty text; empty texts score
the curve's value at 0. Without labelled rows of both kinds every score is 0.5.
Labels that disagree for an id, or are null, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, texts_of

SAMPLE = 1200
LONGEST = 1 << 16
DICTIONARY = 112 << 10
CHUNK = 2048
LEVEL = 3
PREDICT = 0.7


def labelled_sample(docs: DataFrame, labels: DataFrame, learn) -> tuple[list[tuple[int, bytes]], dict[int, int]]:
    """(quality, text) of at most SAMPLE documents of each label, in order of the hash of their id; how often each label is given."""
    known = labels.where(learn).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("quality").alias("__low"), F.max("quality").alias("__high"))
    known = known.where("__low = __high AND __low IN (0, 1)").select("__id", F.col("__low").alias("__quality"), F.xxhash64("__id").alias("__rank"))
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("__text")).where(F.octet_length("__text").between(1, LONGEST))
    given = {r["__quality"]: r["n"] for r in known.groupBy("__quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for quality in (0, 1):
        chosen = known.where(F.col("__quality") == quality).orderBy("__rank", "__id").limit(2 * SAMPLE).select("__id", "__rank")
        # at most 2 * SAMPLE ids
        rows = texts.join(F.broadcast(chosen), "__id").orderBy("__rank", "__id", "__text").limit(SAMPLE).collect()
        out += [(quality, r["__text"].encode()) for r in rows]
    return out, given


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(raw)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False)


def _dictionary(texts: list[bytes]) -> bytes:
    """Trained content where there is enough text for it, otherwise the texts themselves."""
    chunks = [t[a:a + CHUNK] for t in texts for a in range(0, len(t), CHUNK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:].rjust(8, b" ")


def difference(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """Bytes that the bad dictionary needs beyond the good one, for a byte of text."""
    if not text:
        return 0.0
    more = 0
    for a in range(0, len(text), CHUNK):
        chunk = text[a:a + CHUNK]
        more += len(bad.compress(chunk)) - len(good.compress(chunk))
    return more / len(text)


def fit_curve(x: np.ndarray, y: np.ndarray, given: dict[int, int]) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a slight pull to zero; labels weigh as often as they are given."""
    scale = float(np.std(x)) or 1.0
    z = np.stack([x / scale, np.ones(len(x))], 1)
    weight = np.where(y == 1, given[1] / max(1, (y == 1).sum()), given[0] / max(1, (y == 0).sum())) * len(y) / (given[0] + given[1])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - 1e-2 * beta
        curvature = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


class Model:
    """Two dictionaries and a curve; small enough to travel with a task."""

    def __init__(self, sample: list[tuple[int, bytes]], given: dict[int, int]):
        by = {q: [t for x, t in sample if x == q] for q in (0, 1)}
        self.ready = all(len(v) >= 2 for v in by.values())
        if self.ready:
            self.raw = {q: _dictionary(v[::2]) for q, v in by.items()}
            good, bad = self.compressors()
            held = [(q, difference(t, good, bad)) for q, v in by.items() for t in v[1::2]]
            self.slope, self.offset = fit_curve(np.array([d for _, d in held]), np.array([q for q, _ in held]), given)

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return _compressor(self.raw[1]), _compressor(self.raw[0])


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Learns from labels whose crc32(id as text) modulo ``folds`` is not ``held_fold``; a null id is held out.
    """
    model = Model(*labelled_sample(docs, labels, F.coalesce(crc_mod("doc_id", folds) != held_fold, F.lit(False))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors() if model.ready else None
        for batch in batches:
            if tools:
                x = np.array([difference(t, *tools) for t in texts_of(batch.column(1))], float)
                score = 1 / (1 + np.exp(-np.clip(x * model.slope + model.offset, -60, 60)))
            else:
                score = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(crc_mod("doc_id", folds) == held_fold, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
