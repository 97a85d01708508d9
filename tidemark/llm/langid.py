"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 (a fixed draw for its code
point); a boundary, any run of other characters, has one too. An n-gram's
vector binds its letters: the product of their vectors, each rotated by its
distance from the end. A text's vector bundles (adds up) the vectors of its
n-grams, a language's prototype bundles its training texts, each scaled to length
one. A text gets the language whose prototype has the largest cosine,
after the mean of the prototypes, which all languages share, is taken out of both.

As equal n-grams have equal vectors, a run of texts is encoded as the product
of its n-gram counts and the vectors of its distinct n-grams.

A null text or one without a letter is ``und`` with score 0, and so is every
text if there is nothing to learn from. Rows without a language are not
learned from. Equal cosines: the first language by code point. Texts of any length are
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, pieces, texts_of

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: distinct n-grams whose vectors are held at a time
COLUMNS = 4096


@lru_cache(1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(None)
def letter_vector(code: int) -> np.ndarray:
    """+1 and -1, drawn for a code point; 0 stands for a boundary."""
    return (np.random.Generator(np.random.PCG64([code, 20240229])).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1).astype(np.int8)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: the code points used, each text's n-grams as numbers over them, the text of each."""
    low = ["\0" + t.lower() + "\0" for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(low)), [len(t) for t in low])
    code = np.where(_letters()[code], code, 0)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0) | (text[1:] != text[:-1])
    code, text = code[keep], text[keep]
    used = np.zeros(0x110000, bool)
    used[code] = True
    alphabet = np.flatnonzero(used)
    number = np.zeros(0x110000, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    digit = number[code]
    n = max(0, len(digit) - GRAM + 1)
    gram = np.zeros(n, np.int64)
    for k in range(GRAM):
        gram = gram * len(alphabet) + digit[k:n + k]
    inside = text[:n] == text[GRAM - 1:n + GRAM - 1]
    return alphabet, gram[inside], text[:n][inside]


def encode(texts: list[str]) -> np.ndarray:
    """The vector of each text."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    alphabet, gram, text = _grams(texts)
    if not len(gram):
        return out
    ordered = np.sort(gram)
    distinct = ordered[np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))]
    if len(alphabet) ** GRAM <= 1 << 22:
        place = np.zeros(len(alphabet) ** GRAM, np.int64)
        place[distinct] = np.arange(len(distinct))
        column = place[gram]
    else:
        column = np.searchsorted(distinct, gram)
    letters = np.stack([letter_vector(int(c)) for c in alphabet])
    for at in range(0, len(distinct), COLUMNS):
        own, width = distinct[at:at + COLUMNS], min(COLUMNS, len(distinct) - at)
        vectors = np.ones((width, DIMENSIONS), np.int8)
        for k in range(GRAM):
            vectors *= np.roll(letters, k, axis=1)[own // len(alphabet) ** k % len(alphabet)]
        some = (column >= at) & (column < at + width) if len(distinct) > COLUMNS else slice(None)
        counts = np.bincount(text[some] * width + column[some] - at, minlength=len(texts) * width).reshape(len(texts), width)
        out += counts.astype(np.float32) @ vectors.astype(np.float32)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def _strings(column: pa.Array) -> list[str]:
    return [x.decode("utf-8", "replace") for x in texts_of(column)]


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the sum of the text vectors of each language."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("__lang").to_pylist(), object)
        raw = texts_of(batch.column("__text"))
        for a, b in pieces(raw):
            vectors = _unit(encode([x.decode("utf-8", "replace") for x in raw[a:b]]))
            for lang in sorted(set(langs[a:b])):
                total[lang] = total.get(lang, 0) + vectors[langs[a:b] == lang].sum(0, dtype=np.float64)
    for lang, vector in total.items():
        # whole numbers, so that sums do not depend on their order
        yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                                          pa.array(np.round(vector * 2.0**24).astype(np.int64))], ["lang", "at", "value"])


def prototypes(docs: DataFrame, learn: Column) -> tuple[list[str], np.ndarray]:
    """The languages and their prototypes: one row of ``DIMENSIONS`` numbers for each language comes to the driver."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").alias("__lang"), F.col("text").alias("__text"))
    sums = rows.mapInArrow(_profiles, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum(F.col("value").cast("double")).alias("value"))
    table = sums.toPandas()
    langs = sorted(table["lang"].unique(), key=lambda x: x.encode())
    out = np.zeros((len(langs), DIMENSIONS), np.float64)
    out[[langs.index(x) for x in table["lang"]], table["at"]] = table["value"]
    return langs, _unit(out).astype(np.float32)


def identify(docs: DataFrame, langs: list[str], vectors: np.ndarray) -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    shared = vectors.mean(0) if len(langs) > 1 else np.zeros(DIMENSIONS, np.float32)
    own = _unit(vectors - shared) if len(langs) else vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts_of(batch.column("__text"))
            pred, score = [], []
            for a, b in pieces(raw):
                texts = [x.decode("utf-8", "replace") for x in raw[a:b]]
                coded = _unit(encode(texts))
                for t, cosines in zip(texts, _unit(coded - shared) @ own.T):
                    if not len(langs) or not any(map(str.isalpha, t)):
                        pred.append(UNKNOWN)
                        score.append(0.0)
                    else:
                        best = int(np.argmax(cosines))
                        pred.append(langs[best])
                        score.append(float(min(1.0, max(0.0, (1 + cosines[best]) / 2))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("__text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """Learns from rows whose crc32(id as text) modulo ``folds`` is not ``held_fold``; a null id is held out."""
    fold = crc_mod("doc_id", folds)
    langs, vectors = prototypes(docs, F.coalesce(fold != held_fold, F.lit(False)))
    held = F.coalesce(crc_mod("doc_id", folds) == held_fold, F.lit(True))
    return identify(docs, langs, vectors).select("doc_id", held.alias("held_out"), "lang_pred", "score")
