"""Exact substring deduplication with a blockwise suffix sort.

Every suffix stands for its first ``WINDOW`` bytes. A window loses its bytes
when the same bytes start in a document with a smaller id.

1. *Buckets.* The bucket of a suffix is the smallest hash among the
   ``GRAM``-byte strings of its window (the leftmost, on ties). It depends on
   the window alone, so equal suffixes always share a bucket. Neighbouring
   suffixes with the same smallest string form one record.
2. *Which buckets are shared.* Each block of documents asks for the bucket
   names it holds; names held by one document only are answered "no" and
   their suffixes leave the sort.
3. *Blockwise sort.* The remaining records go to their buckets, one copy of
   equal records per block of documents; the names only decide which task
   meets which suffixes. A task takes a run of buckets of about
   ``SORT_WINDOWS`` suffixes, equal records once. The positions of its text whose phase modulo
   ``PERIOD`` is in the difference cover are the sample: their strings are
   ranked in lexicographic order, by doubling. Then the suffixes are split by
   prefix and one lexicographic bucket at a time, of about ``SORT_BUCKET``
   suffixes, is sorted: first by ``PERIOD`` bytes, and ties between any two
   phases by the sample's ranks at the shift at which both stand on cover
   positions. No suffix is compared further than its first ``PERIOD`` bytes.
4. Covered bytes go back to the block of their document and are removed.

Ids: a null id counts as larger than any other; rows with the same id never
remove each other's bytes. Null text is the empty text. Texts under
``WINDOW`` bytes lose nothing. An empty table gives an empty result. Bucket
names are 64-bit hashes, of which equal ones only bring more suffixes
together; what is removed is decided by bytes and exact ranks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (BLOCK_BYTES, PIECE_BYTES, U64, block_column, bucket_bounds, gram_hash, mix, pack,
                                 power_of_two, sorted_unique, text_bytes, thick, thin, unpack)

WINDOW = 50
GRAM = 24
#: difference cover: every distance modulo 13 is a difference of two of these
PERIOD, COVER = 13, (0, 1, 3, 9)
SORT_WINDOWS = 1 << 18
SORT_BUCKET = 1 << 16
#: suffixes of equal records decided at once
MEMBER_WINDOWS = 1 << 20
KEY_BITS = 56
NO_ID = (1 << 63) - 1


def shift_table(period: int, cover: tuple[int, ...]) -> np.ndarray:
    """By two phases: the bytes after which positions of both phases stand on the cover."""
    on = np.isin(np.arange(2 * period) % period, cover)
    both = np.array([[on[i:i + period] & on[j:j + period] for j in range(period)] for i in range(period)])
    if not both.any(axis=2).all():
        raise ValueError(f"{cover} is no difference cover modulo {period}")
    return both.argmax(axis=2)


SHIFT = shift_table(PERIOD, COVER)


def _smallest(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of ``width`` grams: the smallest, and its leftmost place in the run."""
    n = len(grams) - width + 1
    value, place, have = grams, np.zeros(len(grams), np.uint8), 1
    while have < width:
        step = min(have, width - have)
        left, right = value[:len(value) - step], value[step:]
        less = right < left
        place = np.where(less, place[step:] + np.uint8(step), place[:len(left)])
        value, have = np.where(less, right, left), have + step
    return value[:n], place[:n]


def _parts(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(document, offset, bytes) in runs of about a piece; long texts in parts that overlap."""
    held, size = [], 0
    for d, t in enumerate(texts):
        if len(t) < WINDOW:
            continue
        for at in range(0, len(t) - WINDOW + 1, PIECE_BYTES):
            part = t[at:at + PIECE_BYTES + WINDOW - 1]
            held.append((d, at, part))
            size += len(part)
            if size >= PIECE_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _records(texts: list[bytes]) -> Iterator[tuple]:
    """Per run of parts: the bytes, and of each record the bucket, the document,
    the place in the bytes and in the text, the suffixes."""
    for held in _parts(texts):
        raw = b"".join(p for _, _, p in held)
        buf = np.frombuffer(raw, np.uint8)
        sizes = np.array([len(p) for _, _, p in held])
        value, place = _smallest(gram_hash(buf, GRAM), WINDOW - GRAM + 1)
        ends = np.cumsum(sizes)
        part = np.repeat(np.arange(len(held)), sizes)[:len(value)]
        own = np.flatnonzero(np.arange(len(value)) + WINDOW <= ends[part])
        anchor = own + place[own]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1] + 1)]))
        first, count = own[new], np.diff(np.append(new, len(own)))
        of = part[first]
        shift = np.array([o for _, o, _ in held]) - (ends - sizes)
        # the smallest of many hashes is small: spread them again over the buckets
        yield (raw, mix(value[first]) >> U64(64 - KEY_BITS), np.array([d for d, _, _ in held])[of], first,
               first + shift[of], count)


def _documents(table: pa.Table) -> tuple[list[int], list[bytes], list[int]]:
    """Ids and texts in an order that does not depend on arrival, and the rows they come from."""
    ids = [NO_ID if x is None else x for x in table["__id"].to_pylist()]
    texts = [x or b"" for x in table["__text"].cast(pa.binary()).to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order], order


def _ask(bits: int):
    """Per block of documents: the buckets it has, and whether two of its documents share them."""

    def run(table: pa.Table) -> pa.Table:
        block = table["__block"][0].as_py()
        ids, texts, _ = _documents(table)
        found = [(r[1], r[2]) for r in _records(texts)]
        keys = np.concatenate([np.zeros(0, U64), *(k for k, _ in found)])
        doc = np.concatenate([np.zeros(0, np.int64), *(d for _, d in found)])
        ordered = np.sort(keys)
        again = sorted_unique(ordered[1:][ordered[1:] == ordered[:-1]])
        names = sorted_unique(keys)
        shared = np.zeros(len(names), bool)
        if len(again):
            at = np.searchsorted(again, keys)
            at[at == len(again)] = 0
            some = np.flatnonzero(again[at] == keys)
            key, own = keys[some], np.array(ids)[doc[some]]
            by = np.lexsort((own, key))
            key, own = key[by], own[by]
            two = key[1:][(key[1:] == key[:-1]) & (own[1:] != own[:-1])]
            shared[np.searchsorted(names, two)] = True
        edges = bucket_bounds(names, bits, KEY_BITS)
        rows = [b for b in range(len(edges) - 1) if edges[b + 1] > edges[b]]
        return pa.table({"block": pa.array([block] * len(rows), pa.int32()), "bucket": pa.array(rows, pa.int32()),
                         "asked": pa.array([pack(thin(names[edges[b]:edges[b + 1]]), np.packbits(shared[edges[b]:edges[b + 1]])) for b in rows], pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Per run of buckets: which of the asked names two documents have."""
    asked = [unpack(x, bytes, np.uint8) for x in table["asked"].to_pylist()]
    names = [thick(raw) for raw, _ in asked]
    flagged = [np.unpackbits(bits, count=len(n)).astype(bool) for n, (_, bits) in zip(names, asked)]
    every = np.sort(np.concatenate(names))
    shared = sorted_unique(np.concatenate([every[1:][every[1:] == every[:-1]], *(n[f] for n, f in zip(names, flagged))]))
    out = []
    for n in names:
        at = np.searchsorted(shared, n)
        yes = at < len(shared)
        yes[yes] = shared[at[yes]] == n[yes]
        out.append(pack(thin(n[yes])))
    return pa.table({"__block": table["block"], "bucket": table["bucket"], "shared": pa.array(out, pa.binary())})


def _send(bits: int):
    """Per block: its records in shared buckets; of equal ones the first, the others are decided here."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = (docs if len(docs) else answers)["__block"][0].as_py()
        shared = np.sort(np.concatenate([np.zeros(0, U64), *(thick(unpack(x, bytes)[0]) for x in answers["shared"].to_pylist())]))
        cols: dict[str, list] = {"block": [], "bucket": [], "kind": [], "payload": []}
        if len(shared):
            ids, texts, _ = _documents(docs)
            seen: dict[bytes, int] = {}
            keep, done, parts = [], [], []
            for raw, key, doc, at, start, count in _records(texts):
                where = np.searchsorted(shared, key)
                where[where == len(shared)] = 0
                some = np.flatnonzero(shared[where] == key)
                flag = np.zeros(len(some), bool)
                for j, (d, a, c) in enumerate(zip(doc[some].tolist(), at[some].tolist(), count[some].tolist())):
                    if seen.setdefault(text := raw[a:a + c + WINDOW - 1], ids[d]) < ids[d]:
                        flag[j] = True
                    else:
                        parts.append(text)
                sent, local = some[~flag], some[flag]
                keep.append((key[sent], doc[sent], start[sent], count[sent]))
                done.append((doc[local], start[local], start[local] + count[local] + WINDOW - 1))
            doc, start, end = (np.concatenate(x) for x in zip(*done))
            if len(doc):
                cols["block"].append(block)
                cols["bucket"].append(block % (1 << bits))
                cols["kind"].append(0)
                cols["payload"].append(pack(doc.astype(np.uint32), start.astype(np.int64), end.astype(np.int64)))
            key, doc, start, count = (np.concatenate(x) for x in zip(*keep))
            order = np.argsort(key, kind="stable")
            edges = bucket_bounds(key[order], bits, KEY_BITS)
            own = np.array(ids, np.int64)
            for b in range(len(edges) - 1):
                if edges[b + 1] > edges[b]:
                    o = order[edges[b]:edges[b + 1]]
                    cols["block"].append(block)
                    cols["bucket"].append(b)
                    cols["kind"].append(1)
                    cols["payload"].append(pack(key[o], own[doc[o]], doc[o].astype(np.uint32), start[o].astype(np.int64),
                                                count[o].astype(np.uint8), b"".join(parts[i] for i in o)))
        return pa.table({"block": pa.array(cols["block"], pa.int32()), "bucket": pa.array(cols["bucket"], pa.int32()),
                         "kind": pa.array(cols["kind"], pa.int32()), "payload": pa.array(cols["payload"], pa.binary())})

    return run


def _in_order(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys of ``bits`` bits, and whether each in it differs from the one before."""
    place = max(1, (len(key) - 1).bit_length())
    if bits + place <= 64:
        # keys with their places below them sort faster than places by keys
        both = np.sort((key.astype(U64) << U64(place)) | np.arange(len(key), dtype=U64))
        order = (both & U64((1 << place) - 1)).astype(np.int64)
        both >>= U64(place)
        return order, np.concatenate([[False], both[1:] != both[:-1]])[:len(key)]
    order = np.argsort(key)
    held = key[order]
    return order, np.concatenate([[False], held[1:] != held[:-1]])[:len(key)]


def _dense(key: np.ndarray, bits: int = 64) -> np.ndarray:
    """Rank of each key of ``bits`` bits among the distinct ones."""
    order, new = _in_order(key, bits)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _then(rank: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """Keys that order by rank, then by ``low``, and their bits."""
    return (rank.astype(U64) << U64(bits)) | low.astype(U64), bits + len(rank).bit_length()


def _pair(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high.astype(U64) << U64(32)) | low.astype(U64)


class CoverRanks:
    """Lexicographic ranks of the sample of a text: the strings at positions on the cover.

    ``wanted`` marks the places where a string of up to ``WINDOW`` bytes starts. The sample is sorted by doubling, as its
    positions recur after ``PERIOD`` bytes: by 13, 26 and 52 bytes. ``ranks[d]`` ranks the strings of
    ``WINDOW - d`` bytes, for each shift ``d``: one order serves all lengths, neighbours with that many bytes in common share a rank.
    """

    def __init__(self, text: np.ndarray, wanted: np.ndarray):
        n = len(text)
        self.code = np.full(PERIOD, -1)
        self.code[list(COVER)] = np.arange(len(COVER))
        padded = np.concatenate([text, np.zeros(WINDOW + 4 * PERIOD, np.uint8)])
        sample = (np.arange(0, n + 3 * PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
        stride = len(COVER)
        head = first_bytes(padded, sample, 8)
        rank = _dense(head >> U64(24), 40)
        rank = _dense(*_then(rank, head & U64((1 << 24) - 1), 24))
        rank = _dense(*_then(rank, first_bytes(padded, sample + 8, PERIOD - 8), 8 * (PERIOD - 8)))
        doubled = _dense(*_then(rank[:-stride], rank[stride:], len(rank).bit_length()))
        here = np.flatnonzero(wanted[np.minimum(sample, n - 1)] & (sample < n))
        order, new = _in_order(*_then(doubled[here], doubled[here + 2 * stride], len(doubled).bit_length()))
        self.slot = np.full(len(sample), -1, np.int32)
        self.slot[here] = np.arange(len(here))
        # neighbours that differ in the 13 + 13 + 12 bytes that the largest shift leaves of a window, then in one byte more at a time
        starts = sample[here][order]
        pair = doubled[here][order]
        differ = np.zeros(len(here), bool)
        tail = [first_bytes(padded, starts + 2 * PERIOD, 8), first_bytes(padded, starts + 2 * PERIOD + 8, PERIOD - 9)]
        for held in (pair, *tail):
            differ[1:] |= held[1:] != held[:-1]
        self.ranks = np.empty((PERIOD, len(here)), np.int32)
        for d in range(PERIOD - 1, -1, -1):
            if d < PERIOD - 1:
                held = padded[starts + WINDOW - 1 - d]
                differ[1:] |= held[1:] != held[:-1]
            self.ranks[d, order] = np.cumsum(differ)

    def after(self, at: np.ndarray, shift: int) -> np.ndarray:
        """Ranks of what stands ``shift`` bytes after the starts of suffixes, which is on the cover."""
        place = at + shift
        return self.ranks[shift][self.slot[len(COVER) * (place // PERIOD) + self.code[place % PERIOD]]]


def first_bytes(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The up to eight bytes from each place as a number in the order of the bytes."""
    view = np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1))
    return view[at].view(">u8").ravel().astype(U64) >> U64(64 - 8 * n)


def sort_bucket(at: np.ndarray, prefix: np.ndarray, padded: np.ndarray, cover: CoverRanks) -> np.ndarray:
    """Of each suffix, with its first eight bytes, the number of distinct tied suffixes of the bucket before it.

    Suffixes that share their first ``PERIOD`` bytes with no other get -1.
    """
    out = np.full(len(at), -1)
    group = _dense(*_then(_dense(prefix), first_bytes(padded, at + 8, PERIOD - 8), 8 * (PERIOD - 8)))
    tied = np.flatnonzero(np.bincount(group)[group] > 1)
    group, place = group[tied], at[tied]
    phase = place % PERIOD
    phases = []
    for i in range(PERIOD):
        some = np.flatnonzero(phase == i)
        # suffixes of one phase are in order by one rank; of equal ones the first stands for all
        _, one, of = np.unique(_pair(group[some], cover.after(place[some], SHIFT[i, i])), return_index=True, return_inverse=True)
        phases.append((i, some, of, group[some[one]], place[some[one]], np.arange(len(one))))
    phases = [x for x in phases if len(x[1])]
    for x, (i, _, _, group_i, place_i, before_i) in enumerate(phases):
        for j, _, _, group_j, place_j, before_j in phases[:x]:
            left = _pair(group_i, cover.after(place_i, SHIFT[i, j]))
            right = _pair(group_j, cover.after(place_j, SHIFT[i, j]))
            before_i += np.searchsorted(right, left)
            before_j += np.searchsorted(left, right)
    for _, some, of, _, _, before in phases:
        out[tied[some]] = before[of]
    return out


def least_ids(text: np.ndarray, own: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sorts the suffixes of some records; of each, the smallest id among those equal to it.

    The records' texts stand one after the other; a record has ``count`` suffixes.
    """
    size = count + WINDOW - 1
    offset = np.cumsum(size) - size
    record = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(record)) + np.repeat(offset - (np.cumsum(count) - count), count)
    ids = own[record]
    within = np.arange(len(text)) - np.repeat(offset, size)
    cover = CoverRanks(text, within < np.repeat(count + PERIOD - 1, size))
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    prefix = first_bytes(padded, at, 8)
    cuts = np.unique(np.sort(prefix)[SORT_BUCKET::SORT_BUCKET])
    bucket = np.searchsorted(cuts, prefix, "right")
    out = ids.copy()
    for b in range(len(cuts) + 1):
        some = np.flatnonzero(bucket == b)
        rank = sort_bucket(at[some], prefix[some], padded, cover)
        some, rank = some[rank >= 0], rank[rank >= 0]
        if len(some):
            order = np.argsort(rank, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], rank[order[1:]] != rank[order[:-1]]]))
            least = np.minimum.reduceat(ids[some[order]], new)
            out[some[order]] = np.repeat(least, np.diff(np.append(new, len(order))))
    return out


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges of ``count`` numbers from ``start``, one range after the other."""
    return np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)


def _runs(flag: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Record, first and last suffix of each run of flagged suffixes inside a record."""
    record = np.repeat(np.arange(len(count)), count)
    some = np.flatnonzero(flag)
    if not len(some):
        return some, some, some
    new = np.concatenate([[True], (some[1:] != some[:-1] + 1) | (record[some[1:]] != record[some[:-1]])])
    first, last = some[new], some[np.append(np.flatnonzero(new)[1:] - 1, len(some) - 1)]
    base = np.cumsum(count) - count
    of = record[first]
    return of, first - base[of], last - base[of]


def _sort(table: pa.Table) -> pa.Table:
    """Per run of buckets: the bytes to remove, by block of documents."""
    out: dict[int, list] = {}
    kinds, blocks, payloads = (table[c].to_pylist() for c in ("kind", "block", "payload"))
    got = []
    for kind, block, payload in zip(kinds, blocks, payloads):
        if kind:
            *fields, text = unpack(payload, U64, np.int64, np.uint32, np.int64, np.uint8, bytes)
            got.append((*fields, np.full(len(fields[0]), block), text))
        else:
            out.setdefault(block, []).append(unpack(payload, np.uint32, np.int64, np.int64))
    if got:
        key, own, doc, start, count, block = (np.concatenate(x) for x in list(zip(*got))[:-1])
        raw = b"".join(x[-1] for x in got)
        text = np.frombuffer(raw, np.uint8)
        count = count.astype(np.int64)
        size = count + WINDOW - 1
        offset = np.cumsum(size) - size
        # records of the same bytes are sorted once, with the smallest id
        seen: dict[bytes, int] = {}
        same = np.array([seen.setdefault(raw[a:a + n], len(seen)) for a, n in zip(offset.tolist(), size.tolist())])
        del seen, raw
        by_same = np.argsort(same, kind="stable")
        copies = np.bincount(same)
        begins = np.cumsum(copies) - copies
        one, smallest = by_same[begins], np.minimum.reduceat(own[by_same], begins)
        by_key = np.argsort(key[one], kind="stable")
        windows, sorted_keys = np.cumsum(count[one][by_key]), key[one][by_key]
        at = 0
        while at < len(by_key):
            # whole buckets, of about SORT_WINDOWS suffixes together
            before = windows[at - 1] if at else 0
            to = max(np.searchsorted(windows, before + SORT_WINDOWS), at + 1)
            to = np.searchsorted(sorted_keys, sorted_keys[to - 1], "right")
            some = by_key[at:to]
            held = count[one[some]]
            least = least_ids(text[_ranges(offset[one[some]], size[one[some]])], smallest[some], held)
            members = by_same[_ranges(begins[some], copies[some])]
            place = np.repeat(np.cumsum(held) - held, copies[some])
            parts = np.cumsum(count[members]) // MEMBER_WINDOWS
            for few, where in zip(*(np.split(x, np.flatnonzero(np.diff(parts)) + 1) for x in (members, place))):
                flag = np.repeat(own[few], count[few]) > least[_ranges(where, count[few])]
                record, first, last = _runs(flag, count[few])
                record = few[record]
                begin = start[record] + first
                end = start[record] + last + WINDOW
                order = np.argsort(block[record], kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(block[record][order])) + 1) if len(order) else []:
                    out.setdefault(int(block[record][group[0]]), []).append((doc[record][group], begin[group], end[group]))
            at = to
    cols = {"__block": list(out), "spans": [pack(*(np.concatenate(x) for x in zip(*v))) for v in out.values()]}
    return pa.table({"__block": pa.array(cols["__block"], pa.int32()), "spans": pa.array(cols["spans"], pa.binary())})


def _remove(columns: list[str], text_column: bool, schema: pa.Schema):
    """Per block: the documents without the removed bytes."""

    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        _, texts, order = _documents(docs)
        got = [unpack(x, np.uint32, np.int64, np.int64) for x in spans["spans"].to_pylist()]
        doc, begin, end = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int64),) * 3
        by = np.lexsort((begin, doc))
        doc, begin, end = doc[by], begin[by], end[by]
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        n_bytes, removed, runs, digest, kept = ([None] * len(texts) for _ in range(5))
        for i, text in enumerate(texts):
            row = order[i]
            lost, pieces, n, cursor = 0, [], 0, 0
            if bounds[i] < bounds[i + 1]:
                far = -1
                for b, e in zip(begin[bounds[i]:bounds[i + 1]].tolist(), end[bounds[i]:bounds[i + 1]].tolist()):
                    if b > far:
                        pieces.append(text[cursor if far < 0 else far:b])
                        n += 1
                        lost += e - b
                        far = e
                    elif e > far:
                        lost += e - far
                        far = e
                pieces.append(text[far:])
                text = b"".join(pieces)
            n_bytes[row], removed[row], runs[row] = len(text) + lost, lost, n
            digest[row] = hashlib.sha256(text).hexdigest()
            kept[row] = text.decode("utf-8", "ignore") if text_column else None
        out = {c: docs[c] for c in columns}
        out |= {"n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        if text_column:
            out["kept_text"] = pa.array(kept, pa.string())
        return pa.table([out[f.name].cast(f.type) if out[f.name].type != f.type else out[f.name] for f in schema], schema=schema)

    return run


def remove_repeats(docs: DataFrame, keep: list[str] | None = None, text_column: bool = False) -> DataFrame:
    """Per document the size, the bytes and maximal runs removed, and the digest of the rest.

    ``keep``: columns of ``docs`` that come first (default ``doc_id``).
    ``text_column``: adds ``kept_text``, the remaining bytes without the
    fragments of characters that a cut left.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = ["doc_id"] if keep is None else keep
    total = text_bytes(docs)
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    bits = power_of_two(total / BLOCK_BYTES).bit_length() - 1
    blocked = docs.select(block_column(n_blocks, "doc_id", "text").alias("__block"), F.col("doc_id").cast("long").alias("__id"),
                          F.col("text").alias("__text"), *(F.col(c) for c in keep))
    by_block = blocked.groupBy("__block")
    asked = by_block.applyInArrow(_ask(bits), "block int, bucket int, asked binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer, "__block int, bucket int, shared binary")
    sent = by_block.cogroup(answers.groupBy("__block")).applyInArrow(_send(bits), "block int, bucket int, kind int, payload binary")
    spans = sent.groupBy("bucket").applyInArrow(_sort, "__block int, spans binary")
    schema = blocked.select(*keep).withColumns({"n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"),
                                                "n_spans": F.lit(0).cast("long"), "kept_sha256": F.lit("")})
    schema = schema.withColumn("kept_text", F.lit("")) if text_column else schema
    return by_block.cogroup(spans.groupBy("__block")).applyInArrow(_remove(keep, text_column, to_arrow_schema(schema.schema)), schema.schema)
