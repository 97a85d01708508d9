"""Code lengths against a trie walked byte by byte."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import ppm


def slow(rows, folds=7, held=2):
    low = [(d, (t or "").encode().translate(ppm.ascii_lower_table())) for d, t in rows]
    learn = [d is not None and zlib.crc32(str(d).encode()) % folds != held for d, _ in low]
    trie, words = defaultdict(Counter), Counter()
    for (d, t), own in zip(low, learn):
        if own:
            s = bytes(ppm.ORDER) + t + b"\0"
            for i in range(ppm.ORDER, len(s)):
                for o in range(ppm.ORDER + 1):
                    trie[s[i - o:i]][s[i]] += 1
            words.update(t.split())
            words[None] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for (d, t), own in zip(low, learn):
        s, score = bytes(ppm.ORDER) + t + b"\0", 0.0
        for i in range(ppm.ORDER, len(s)):
            excluded = set()
            for o in range(ppm.ORDER, -1, -1):
                seen = {k: c for k, c in trie[s[i - o:i]].items() if k not in excluded}
                total = sum(seen.values()) + len(seen)
                if s[i] in seen:
                    score += math.log10(seen[s[i]] / total)
                    break
                if seen:
                    score += math.log10(len(seen) / total)
                    excluded |= set(seen)
            else:
                score -= math.log10(256 - len(excluded))
        tokens = [*t.split(), None]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((d, not own, len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return out


def check(got, want):
    key = lambda x: (repr(x[0]), x[2], round(x[6], 2))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("seed,block", [(1, 1 << 22), (2, 400)])
def test_equals_the_trie(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block)
    r = random.Random(seed)
    words = ["the", "The", "of", "nation", "é", "straße", "x\x00y", "a1", "日本"]
    rows = [(i, " ".join(r.choice(words) + r.choice(["", "s", "\n", "?"]) for _ in range(r.randrange(0, 30)))) for i in range(50)]
    rows += [(60, None), (61, ""), (62, " \t"), (None, "the of unseen"), (63, rows[0][1]), (64, "Q" * 3000), (65, "zq~"), (65, "zq~")]
    df = spark.createDataFrame([(d, t, "s", 1.0) for d, t in rows], "doc_id long, text string, source string, score double").repartition(3)
    check(ppm.score_documents(df).collect(), slow(rows))


def test_probabilities_add_up():
    import numpy as np

    r = random.Random(3)
    texts = [bytes(r.choice(b"abcd ") for _ in range(r.randrange(200))) for _ in range(8)]
    keys, counts = ppm._counted(ppm.gram_keys(texts)[0])
    code = keys * ppm._INVERSE
    pair = np.bincount((code & np.uint64(0xFFFF)).astype(int), counts, 65536).astype(np.int64)
    for context in (b"abcd", b"zzab", b"zzzz", bytes(4)):
        ask = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        new = ask[~np.isin(ask, code)]
        logs = ppm.log10_probabilities(np.concatenate([code, new]), np.concatenate([counts, np.zeros(len(new), np.int64)]), pair)
        have = dict(zip(np.concatenate([code, new]).tolist(), logs.tolist()))
        assert sum(10 ** have[int(a)] for a in ask) == pytest.approx(1)


def test_no_rows_and_nothing_to_learn(spark):
    schema = "doc_id long, text string"
    assert ppm.score_documents(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(held, "ab")]
    check(ppm.score_documents(spark.createDataFrame(rows, schema)).collect(), slow(rows))
