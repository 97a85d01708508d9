"""Winnowing against brute force over all windows."""

import hashlib
import random
import re

import numpy as np

from tidemark.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return WORD.findall(low)


def brute(docs, items):
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[x]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    r = random.Random(1)
    vocabulary = ["the", "of", "a", "é1", "ß", "x9", "日本", "and"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(r.choice([3, 4, 7, 9, 10, 11, 25]))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "Only-Once!"), (None, "null id item of just these words here and now then"), (3, "second text of item three with more than ten words in it"),
              (60, "tie tie tie tie tie tie tie tie tie tie tie tie")]
    docs = []
    for i in range(60):
        t = say(r.randrange(0, 60))
        item = r.choice(items)[1] or ""
        w = item.split()
        docs.append((i, t[:len(t) // 2] + " " + " ".join(w[r.randrange(2):r.choice([None, -1])]).upper() + ", " + t[len(t) // 2:]))
    docs += [(100, None), (101, ""), (102, "?! --"), (None, items[5][1]), (103, items[5][1]), (103, items[5][1]), (104, "tie " * 30), (105, "only once"),
             (106, "x\x00y z" * 2000 + (items[10][1] or "")), (107, " null id item of just these words HERE and now then ")]
    a = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, fp string, start int").repartition(3)
    b = spark.createDataFrame([(d, t, 5) for d, t in items], "item_id long, text string, len int").repartition(2)
    assert sorted(map(tuple, dc.contamination(a, b).collect()), key=repr) == brute(docs, items)
    kept = dc.drop_contaminated(a, b)
    assert kept.columns == a.columns
    bad = {x[0] for x in brute(docs, items) if x[5] and x[0] is not None}
    assert sorted((x["doc_id"] for x in kept.collect()), key=repr) == sorted((d for d, _ in docs if d not in bad), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(x)[1:4] for x in dc.contamination(docs, items).collect()] == [(2, 0, 0)]
    assert dc.contamination(docs.limit(0), items).count() == 0


def test_bitmap_grows_with_the_benchmark(spark, monkeypatch):
    r = random.Random(12)
    fps = [r.getrandbits(64) for _ in range(5000)]
    windows = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    other = np.array([r.getrandbits(64) for _ in range(20000)], np.uint64)
    for bits, size, share in (((10, 26), 17, 0.06), ((10, 12), 12, 0.8), ((20, 26), 20, 0.01)):
        monkeypatch.setattr(dc, "SLOT_BITS", bits)
        marked = dc.bitmap(windows)
        assert len(marked) * 8 == 1 << size
        assert dc._marked(marked, np.array(fps, np.uint64)).all()
        assert dc._marked(marked, other).mean() < share
