"""Exact substring deduplication against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import substring_dedup as sd


def brute(rows, w=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        k = sd.NO_ID if d is None else d
        for i in range(len(b) - w + 1):
            s = b[i:i + w]
            first[s] = min(first.get(s, k), k)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        k = sd.NO_ID if d is None else d
        gone = bytearray(len(b))
        for i in range(len(b) - w + 1):
            if first[b[i:i + w]] < k:
                gone[i:i + w] = b"\1" * w
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["the", "of", "and", "é" * 3, "alpha", "be", "x", "nation", "ß", "orange"]
    text = lambda k: " ".join(r.choice(words) + (str(r.randrange(50)) if r.random() < 0.5 else "") for _ in range(k))
    shared = [text(k) for k in (9, 12, 20, 60)]
    rows = []
    for i in range(n):
        t = text(r.randrange(0, 40))
        for _ in range(r.randrange(0, 3)):
            s = r.choice(shared)
            cut = r.randrange(0, len(s) // 2)
            t = t[:len(t) // 2] + s[cut:] + t[len(t) // 2:]
        rows.append((i * 7 % 101, t))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, ""), (204, "a" * 49), (205, "a" * 50), (206, "a" * 300),
             (207, "a" * 51 + "b"), (208, "ab" * 100), (209, "b" + "ab" * 40), (210, "x" * 20 + "a" * 70), (210, "x" * 20 + "a" * 70),
             (None, "a" * 120), (None, rows[3][1]), (211, shared[3]), (212, shared[3])]
    return rows


@pytest.mark.parametrize("seed,block", [(1, 1 << 22), (2, 700), (3, 4000)])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(sd, "BLOCK_BYTES", block)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "src", 1) for d, t in rows], "doc_id long, text string, source string, n_bytes int").repartition(3)
    got = sorted((tuple(x) for x in sd.remove_repeats(df).collect()), key=repr)
    assert got == brute(rows)


def test_long_text_in_parts_and_runs_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE_BYTES", 300)
    monkeypatch.setattr(sd, "SORT_WINDOWS", 500)
    monkeypatch.setattr(sd, "MEMBER_WINDOWS", 70)
    r = random.Random(5)
    long = "".join(r.choice("abcdefgh ") for _ in range(4000))
    rows = [(1, long), (2, long[1000:3000] + "zz" + long[:400]), (3, "q" * 1500), (4, "q" * 900), (5, "ab" * 700), (6, "ba" * 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(x) for x in sd.remove_repeats(df).collect()), key=repr) == brute(rows)


def test_empty_table_and_kept_text(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    t = "one two three four five six seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(1, t, "a"), (2, "é" + t + "è", "b")], "doc_id long, text string, __x string")
    got = {x["doc_id"]: x for x in sd.remove_repeats(df, ["doc_id", "__x"], True).collect()}
    assert got[1]["kept_text"] == t and got[2]["kept_text"] == "éè" and got[2]["__x"] == "b"


def test_smallest_gram_of_each_run():
    grams = np.array([5, 1, 1, 7, 0, 9], np.uint64)
    value, place = sd._smallest(grams, 3)
    assert value.tolist() == [1, 1, 0, 0] and place.tolist() == [1, 0, 2, 1]


def records(seed):
    """Texts of 50 to 75 bytes over few letters, cut from common strings at any phase, some with a byte changed."""
    r = random.Random(seed)
    letters = b"ab c"[:r.choice([1, 2, 4])]
    base = [bytes(r.choice(letters) for _ in range(r.randrange(50, 200))) for _ in range(4)]
    texts = []
    for _ in range(r.randrange(1, 25)):
        t = r.choice(base)
        a = r.randrange(0, len(t) - sd.WINDOW + 1)
        t = bytearray(t[a:a + sd.WINDOW + r.randrange(0, 26)])
        if r.random() < 0.5:
            t[r.randrange(len(t))] = r.randrange(256)
        texts.append(bytes(t))
    return texts, [r.randrange(12) for _ in texts]


def sorted_flags(texts, own):
    count = np.array([len(t) - sd.WINDOW + 1 for t in texts])
    least = sd.least_ids(np.frombuffer(b"".join(texts), np.uint8), np.array(own), count)
    return (np.repeat(own, count) > least).tolist()


def wanted_flags(texts, own):
    windows = [(t[i:i + sd.WINDOW], o) for t, o in zip(texts, own) for i in range(len(t) - sd.WINDOW + 1)]
    first = {}
    for w, o in windows:
        first[w] = min(first.get(w, o), o)
    return [first[w] < o for w, o in windows]


@pytest.mark.parametrize("bucket", [5, 50, 1 << 16])
def test_sort_equals_brute_force(monkeypatch, bucket):
    monkeypatch.setattr(sd, "SORT_BUCKET", bucket)
    for seed in range(40):
        assert sorted_flags(*records(seed)) == wanted_flags(*records(seed))


def test_bucket_is_in_order_of_bytes():
    for seed in range(20):
        text = np.frombuffer(b"".join(records(seed)[0]), np.uint8)
        at = np.arange(len(text) - sd.WINDOW + 1)
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        rank = sd.sort_bucket(at, sd.first_bytes(padded, at, 8), padded, sd.CoverRanks(text, np.ones(len(text), bool)))
        of = {}
        for i, k in zip(at.tolist(), rank.tolist()):
            if k >= 0:
                of.setdefault(text[i:i + sd.WINDOW].tobytes(), set()).add(k)
        assert all(len(k) == 1 for k in of.values())
        in_order = [min(of[w]) for w in sorted(of)]
        assert in_order == sorted(set(in_order))


def test_a_set_that_is_no_difference_cover_fails(monkeypatch):
    for cover in ((0, 6), (0, 7), (0, 5, 10), (0, 1, 2, 3)):
        with pytest.raises(ValueError):
            sd.shift_table(sd.PERIOD, cover)
    # ranks that are not those of the shift where both stand on the cover give wrong results
    monkeypatch.setattr(sd, "COVER", (0, 1, 3, 8))
    assert any(sorted_flags(*records(seed)) != wanted_flags(*records(seed)) for seed in range(10))


def test_another_difference_cover_gives_the_same(monkeypatch):
    monkeypatch.setattr(sd, "COVER", (0, 2, 3, 7, 12))
    monkeypatch.setattr(sd, "SHIFT", sd.shift_table(13, (0, 2, 3, 7, 12)))
    for seed in range(20):
        assert sorted_flags(*records(seed)) == wanted_flags(*records(seed))
