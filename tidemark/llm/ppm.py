"""Prediction by partial matching: a byte-context trie learned from the corpus.

Texts are lower-cased (A-Z) bytes, ended by a zero byte and preceded by
``ORDER`` zero bytes of context. The trie holds, for each context of up to
``ORDER`` bytes, how often each byte follows it in the training documents.
A byte's probability is looked up from the longest context down: a context
with total n and d different successors gives a seen byte c / (n + d) and an
escape d / (n + d) (method C). After an escape the bytes that the longer
context has are excluded from n and d of the shorter one, and below the empty
context the bytes not seen there share the rest alike.

The model is pretrained, so a byte's code length depends on its (ORDER + 1)-gram
only. Each block of documents asks for its distinct grams once and sends what
its training documents have of them; the trie is built from the sums, one range of
two-byte contexts per task; the code lengths go back to the blocks that asked.
The token counts of the unigram base take the same way. Nothing but 65,536
byte-pair counts and two totals passes the driver.

Null text is the empty text: its only token is the end and its code length
that of the end byte. A null id is scored and never learned from. Rows with
equal ids and texts each count. An empty table gives an empty result; without
training rows every probability is the model's prior.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (U64, Lookup, ascii_lower_table, block_column, bucket_bounds, checkpointed, crc_mod, pack,
                                 pieces, power_of_two, sorted_unique, text_bytes, texts_of, thick, thin, unpack)

ORDER = 4
#: bytes of text in a block: a larger one asks for fewer grams and tokens altogether
BLOCK_BYTES = 16 << 20
GRAM_BITS = 8 * (ORDER + 1)
#: an odd factor takes grams to keys and its inverse takes keys back
_FACTOR = U64(0xD1342543DE82EF95)
_INVERSE = U64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_LOWER = ascii_lower_table()
#: the end token; no word holds a blank
END = b" "


def gram_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and end of the texts, in order, and how many each text has."""
    pad = bytes(ORDER)
    buf = np.frombuffer(pad + b"".join(t + b"\0" + pad for t in texts), np.uint8)
    code = np.zeros(len(buf) - ORDER, U64)
    for k in range(ORDER + 1):
        code <<= U64(8)
        code |= buf[k:len(buf) - ORDER + k]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    return _within(code, sizes) * _FACTOR, sizes


def _within(code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Without the grams whose last byte is padding between texts."""
    first = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    flag = np.zeros(len(code) + 1, np.int8)
    flag[first] = 1
    flag[first + sizes] = -1
    return code[np.cumsum(flag[:-1]).astype(bool)]


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the tokens of the texts, ends included, and how many each text has."""
    digest, out, sizes = xxhash.xxh3_64_intdigest, [], []
    end = digest(END)
    for t in texts:
        words = t.split()
        out += map(digest, words)
        out.append(end)
        sizes.append(len(words) + 1)
    return np.array(out, U64), np.array(sizes, np.int64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], np.diff(np.append(cut, len(keys)))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], np.add.reduceat(counts, cut) if len(cut) else counts


_KINDS = (("gram", gram_keys), ("token", token_keys))


def _ask(bits: int):
    """Per block: its distinct grams and tokens with their training counts, by bucket."""

    def run(table: pa.Table) -> pa.Table:
        block = table["__block"][0].as_py()
        texts = [t.translate(_LOWER) for t in texts_of(table["__text"])]
        learn = table["__learn"].to_pylist()
        cols: dict[str, list] = {"bucket": [], "kind": [], "asked": []}
        for kind, find in _KINDS:
            found = {}
            for own in (True, False):
                some = [t for t, x in zip(texts, learn) if x == own]
                found[own] = [(np.zeros(0, U64), np.zeros(0, np.int64)), *(_counted(find(some[a:b])[0]) for a, b in pieces(some))]
            keys, counts = _summed(*(np.concatenate(x) for x in zip(*found[True])))
            names = sorted_unique(np.concatenate([keys, *(k for k, _ in found[False])]))
            count = np.zeros(len(names), np.int64)
            count[np.searchsorted(names, keys)] = counts
            edges = bucket_bounds(names, bits)
            for b in range(len(edges) - 1):
                if edges[b + 1] > edges[b]:
                    cols["bucket"].append(b)
                    cols["kind"].append(kind)
                    cols["asked"].append(pack(thin(names[edges[b]:edges[b + 1]]), count[edges[b]:edges[b + 1]]))
        n = len(cols["bucket"])
        return pa.table({"block": pa.array([block] * n, pa.int32()), "bucket": pa.array(cols["bucket"], pa.int32()),
                         "kind": pa.array(cols["kind"], pa.string()), "asked": pa.array(cols["asked"], pa.binary())})

    return run


def _total(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The keys of each row, and all keys with their counts over the rows."""
    asked = [(thick(raw), n) for raw, n in (unpack(x, bytes, np.int64) for x in table["asked"].to_pylist())]
    return [k for k, _ in asked], *_summed(*(np.concatenate(x) for x in zip(*asked)))


def _answer_tokens(table: pa.Table) -> pa.Table:
    """To each block the counts of its tokens, in the order asked; on the first row the training tokens and how many differ."""
    names, keys, counts = _total(table)
    rows = [pack(counts[np.searchsorted(keys, n)]) for n in names]
    first = [True] + [False] * (len(rows) - 1)
    return pa.table({"__block": table["block"], "bucket": table["bucket"], "kind": table["kind"], "answer": pa.array(rows, pa.binary()),
                     "n": pa.array([int(counts.sum()) if f else 0 for f in first], pa.int64()),
                     "v": pa.array([int((counts > 0).sum()) if f else 0 for f in first], pa.int64())})


def _context(code: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of a gram's last two context bytes."""
    return ((code >> U64(8)) * U64(0x9E37) & U64(0xFFFF)) >> U64(16 - bits)


def _gather(bits: int):
    """Per range of keys: the grams with their summed counts, dealt by context."""

    def run(table: pa.Table) -> pa.Table:
        _, keys, counts = _total(table)
        code = keys * _INVERSE
        context = _context(code, bits)
        order = np.argsort(context, kind="stable")
        cut = np.searchsorted(context[order], np.arange((1 << bits) + 1, dtype=U64))
        rows = [b for b in range(1 << bits) if cut[b + 1] > cut[b]]
        return pa.table({"context": pa.array(rows, pa.int32()),
                         "grams": pa.array([pack(code[o], counts[o]) for o in (order[cut[b]:cut[b + 1]] for b in rows)], pa.binary())})

    return run


def _pairs(batches):
    """Counts of (last context byte, byte), per batch."""
    for batch in batches:
        total = np.zeros(1 << 16, np.int64)
        for code, count in (unpack(x, U64, np.int64) for x in batch.column(0).to_pylist()):
            total += np.bincount((code & U64(0xFFFF)).astype(np.int64), count, 1 << 16).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])


class Level:
    """The contexts of one length: what follows them, and what their escape excludes one level below."""

    def __init__(self, order: int, code: np.ndarray, count: np.ndarray):
        symbol = code & U64((1 << 8 * (order + 1)) - 1)
        self.symbols = sorted_unique(symbol)
        self.of_symbol = np.searchsorted(self.symbols, symbol)
        self.c = np.bincount(self.of_symbol, count, len(self.symbols))
        self.contexts = sorted_unique(self.symbols >> U64(8))
        self.own = np.searchsorted(self.contexts, self.symbols >> U64(8))
        self.n = np.bincount(self.own, self.c, len(self.contexts))
        self.d = np.bincount(self.own, self.c > 0, len(self.contexts))

    def excluded(self, below: np.ndarray) -> np.ndarray:
        """Of each context the counts that its bytes have below, given for each symbol."""
        return np.bincount(self.own, np.where(self.c > 0, below, 0), len(self.contexts))


def log10_probabilities(code: np.ndarray, count: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Of each gram, from the counts of all grams with the same last two context bytes, and of all byte pairs."""
    c1 = pair.reshape(256, 256)
    c0 = c1.sum(0)
    levels = {o: Level(o, code, count) for o in range(2, ORDER + 1)}
    steps = []  # of each gram: count, total and successors of its context, and what the next level leaves out
    for o in range(ORDER, 1, -1):
        level = levels[o]
        if o > 2:
            low = levels[o - 1]
            below = low.c[np.searchsorted(low.symbols, level.symbols & U64((1 << 8 * o) - 1))]
        else:
            below = pair[(level.symbols & U64(0xFFFF)).astype(np.int64)]
        context = level.own[level.of_symbol]
        steps.append((level.c[level.of_symbol], level.n[context], level.d[context], level.excluded(below)[context]))
    last, byte = (code >> U64(8) & U64(255)).astype(np.int64), (code & U64(255)).astype(np.int64)
    steps.append((c1[last, byte], c1.sum(1)[last], (c1 > 0).sum(1)[last], ((c1 > 0) * c0).sum(1)[last]))
    steps.append((c0[byte], np.full(len(code), c0.sum()), np.full(len(code), (c0 > 0).sum()), np.zeros(len(code))))
    out, open_, n_gone, d_gone = np.zeros(len(code)), np.ones(len(code), bool), 0, 0
    for c, n, d, n_next in steps:
        total, ways = n - n_gone, d - d_gone
        hit = open_ & (c > 0)
        out[hit] += np.log10(c[hit] / (total + ways)[hit])
        open_ &= ~hit
        leave = open_ & (ways > 0)
        out[leave] += np.log10(ways[leave] / (total + ways)[leave])
        n_gone, d_gone = n_next, d
    out[open_] -= math.log10(max(1, 256 - int((c0 > 0).sum())))
    return out


def _compile(pair: np.ndarray, bits: int):
    """Per range of contexts: the code lengths of its grams, by the bucket of their keys."""

    def run(table: pa.Table) -> pa.Table:
        code, count = (np.concatenate(x) for x in zip(*(unpack(x, U64, np.int64) for x in table["grams"].to_pylist())))
        keys, logs = code * _FACTOR, log10_probabilities(code, count, pair)
        order = np.argsort(keys, kind="stable")
        keys, logs = keys[order], logs[order].astype(np.float32)
        edges = bucket_bounds(keys, bits)
        rows = [b for b in range(len(edges) - 1) if edges[b + 1] > edges[b]]
        return pa.table({"bucket": pa.array(rows, pa.int32()),
                         "logs": pa.array([pack(keys[edges[b]:edges[b + 1]], logs[edges[b]:edges[b + 1]]) for b in rows], pa.binary())})

    return run


def _answer_grams(asked: pa.Table, compiled: pa.Table) -> pa.Table:
    keys, logs = (np.concatenate(x) for x in zip(*(unpack(x, U64, np.float32) for x in compiled["logs"].to_pylist())))
    order = np.argsort(keys, kind="stable")
    keys, logs = keys[order], logs[order]
    names = [thick(unpack(x, bytes, np.int64)[0]) for x in asked["asked"].to_pylist()]
    rows = [pack(logs[np.searchsorted(keys, n)]) for n in names]
    zero = pa.array([0] * len(rows), pa.int64())
    return pa.table({"__block": asked["block"], "bucket": asked["bucket"], "kind": asked["kind"], "answer": pa.array(rows, pa.binary()), "n": zero, "v": zero})


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    texts = [t.translate(_LOWER) for t in texts_of(docs["__text"])]
    got = {}
    for kind, find, value in (("gram", gram_keys, np.float32), ("token", token_keys, np.int64)):
        rows = sorted((r for r in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "answer"))) if r[1] == kind), key=lambda r: r[0])
        names = sorted_unique(np.concatenate([sorted_unique(find(texts[a:b])[0]) for a, b in pieces(texts)]))
        got[kind] = (Lookup(names), np.concatenate([unpack(x, value)[0] for _, _, x in rows]))
    score, base, tokens, known = [], [], [], []
    for a, b in pieces(texts):
        keys, sizes = gram_keys(texts[a:b])
        index, logs = got["gram"]
        score.append(np.add.reduceat(logs[index.find(keys)].astype(np.float64), np.cumsum(sizes) - sizes))
        keys, sizes = token_keys(texts[a:b])
        index, counts = got["token"]
        count, first = counts[index.find(keys)], np.cumsum(sizes) - sizes
        base.append(np.add.reduceat(np.log10(count + 1.0), first))
        known.append(np.add.reduceat((count > 0).astype(np.int64), first))
        tokens.append(sizes)
    join = lambda x, kind: pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind))
    return pa.table({"doc_id": docs["__id"], "learned": docs["__learn"], "n_tokens": join(tokens, np.int64), "n_known": join(known, np.int64),
                     "base_sum": join(base, np.float64), "score": join(score, np.float64)})


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """Per row: token counts, the unigram base and the model's log10 probability.

    Learns from rows whose crc32(id as text) modulo ``folds`` is not ``held_fold``.
    """
    total = text_bytes(docs)
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    bits = power_of_two(total / (2 * BLOCK_BYTES)).bit_length() - 1
    learn = F.coalesce(crc_mod("doc_id", folds) != held_fold, F.lit(False))
    blocked = docs.select(block_column(n_blocks, "doc_id", "text").alias("__block"), F.col("doc_id").cast("long").alias("__id"),
                          learn.alias("__learn"), F.col("text").alias("__text"))
    by_block = blocked.groupBy("__block")
    asked = checkpointed(by_block.applyInArrow(_ask(bits), "block int, bucket int, kind string, asked binary"))
    answer = "__block int, bucket int, kind string, answer binary, n long, v long"
    tokens = checkpointed(asked.where("kind = 'token'").groupBy("bucket").applyInArrow(_answer_tokens, answer))
    n, v = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    grams = asked.where("kind = 'gram'")
    summed = checkpointed(grams.groupBy("bucket").applyInArrow(_gather(min(bits, 12)), "context int, grams binary"))
    pair = np.zeros(1 << 16, np.int64)
    # at most 65,536 rows
    for row in summed.select("grams").mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toLocalIterator():
        pair[row["pair"]] = row["n"]
    compiled = summed.groupBy("context").applyInArrow(_compile(pair, bits), "bucket int, logs binary")
    coded = grams.groupBy("bucket").cogroup(compiled.groupBy("bucket")).applyInArrow(_answer_grams, answer)
    scored = by_block.cogroup(tokens.unionByName(coded).groupBy("__block")).applyInArrow(
        _score, "doc_id long, learned boolean, n_tokens long, n_known long, base_sum double, score double")
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         (F.col("base_sum") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"), "score")
