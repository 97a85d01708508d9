"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import xxhash

from tidemark.llm import golay_simhash as g


def slow_fingerprint(text, k=3):
    words = (text or "").encode().translate(g.ascii_lower_table()).split()
    sh = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def slow_groups(ids, fps):
    n, comp = len(ids), list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    low = {}
    for i, c in zip(ids, comp):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    return [low.get(c) for c in comp]


def test_every_near_pair_shares_a_key():
    r = random.Random(3)
    fps = [r.getrandbits(64) for _ in range(300)]
    near = []
    for f in fps:
        x = f
        for b in r.sample(range(64), r.randrange(0, 4)):
            x ^= 1 << b
        near.append(x)
    ra, ka = g.keys_of(np.array(fps, np.uint64))
    rb, kb = g.keys_of(np.array(near, np.uint64))
    for i in range(300):
        assert set(ka[ra == i]) & set(kb[rb == i])


def test_decoder_corrects_three_errors():
    r = random.Random(4)
    for _ in range(200):
        data = r.getrandbits(12)
        word = data << 11
        word |= g._remainder(word)
        assert g._remainder(word) == 0
        for b in r.sample(range(23), r.randrange(0, 4)):
            word ^= 1 << b
        assert int(g.codeword_index(np.array([word], np.uint32))[0]) == data


def test_links_and_components(spark, monkeypatch):
    monkeypatch.setattr(g, "TILE", 16)
    r = random.Random(5)
    fps = []
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(r.randrange(1, 25)):  # chains: each differs from the one before
            fps.append(x)
            for b in r.sample(range(64), r.randrange(1, 4)):
                x ^= 1 << b
    hub = r.getrandbits(64)
    fps += [hub ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(a)]
    fps = list(dict.fromkeys(fps))
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long").repartition(5)
    want = slow_groups(list(range(len(fps))), fps)
    for most_rows in (None, 20):  # the hub's keys are dealt into tiles
        roots = {x["fp"] % (1 << 64): x["root"] for x in g.components(g.links_between(df, 3, most_rows)).collect()}
        got = [roots.get(f, f - (1 << 64) if f >> 63 else f) for f in fps]
        pairs = {}
        for a, b in zip(got, want):
            assert pairs.setdefault(a, b) == b
        assert len(pairs) == len(set(want))


def test_one_key_over_many_groups(spark):
    r = random.Random(9)
    low = r.getrandbits(32)  # two segments in common: one key holds every row
    fps = sorted({low | r.getrandbits(32) << 32 for _ in range(20000)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long").repartition(4)
    groups = g.grouped(df, 2000).groupBy("key", "part").count().orderBy("count", ascending=False).collect()
    assert groups[0]["count"] < 2400 and sum(x["part"] >= 0 for x in groups) >= 190
    together = {(x["a"], x["b"]) for x in g.links_between(df, 3, 2000).collect()}
    near = np.array(fps, np.uint64)
    parent = np.arange(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(near[i + 1:] ^ near[i]) <= 3) + i + 1:
            parent[max(g._find(parent, i), g._find(parent, int(j)))] = min(g._find(parent, i), g._find(parent, int(j)))
    place = {x - (1 << 64) if x >> 63 else x: i for i, x in enumerate(fps)}
    got = np.arange(len(fps))
    for a, b in together:
        x, y = g._find(got, place[a]), g._find(got, place[b])
        got[max(x, y)] = min(x, y)
    assert [g._find(got, i) for i in range(len(fps))] == [g._find(parent, i) for i in range(len(fps))]


def test_documents(spark):
    r = random.Random(6)
    words = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(300)]
    rows = []
    for i in range(40):
        t = [r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 4, 80, 300]))]
        rows.append((i * 3, " ".join(t)))
        if len(t) > 50:
            u = list(t)
            u[r.randrange(len(u))] = "changed"
            rows += [(i * 3 + 1, "\n".join(t).upper() if i % 2 and "é" not in "".join(t) else "\t".join(t)), (1000 - i, " ".join(u))]
    rows += [(500, None), (501, ""), (502, " \n"), (None, rows[1][1]), (503, rows[1][1]), (503, rows[1][1]), (504, "long " * 30000)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, fp string, key int")
    fps = [slow_fingerprint(t) for _, t in rows]
    want = sorted(((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, slow_groups([d for d, _ in rows], fps))), key=repr)
    assert sorted((tuple(x) for x in g.near_groups(df).collect()), key=repr) == want
    kept = g.drop_near_copies(df)
    assert kept.columns == df.columns
    assert {x["doc_id"] for x in kept.collect()} == {d for d, f, c in want if d is None or d == c}
    assert g.near_groups(df.limit(0)).count() == 0
