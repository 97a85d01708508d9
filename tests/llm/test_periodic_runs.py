"""Runs, extensions and collapsed texts against brute force."""

import hashlib
import random
import zlib

import numpy as np

from tidemark.llm import periodic_runs as pr


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute_runs(w, least=12):
    out = set()
    n = len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            s, e, i = i, e + q, e
            if e - s >= max(least, 2 * q) and smallest_period(w[s:e]) == q:
                out.add((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_text(r):
    out = []
    while len(out) < r.randrange(1, 150):
        unit = [r.randrange(r.choice([1, 2, 3, 30])) for _ in range(r.randrange(1, 15))]
        out += unit * r.randrange(1, 6) + unit[:r.randrange(len(unit))]
    return out


def test_runs_equal_brute_force():
    r = random.Random(4)
    for _ in range(60):
        texts = [some_text(r) for _ in range(r.randrange(1, 6))] + [[]]
        got = pr.find_runs([np.array(t, np.int64) for t in texts])
        assert [[tuple(x) for x in g.tolist()] for g in got] == [brute_runs(t) for t in texts]


def test_extensions_are_exact():
    r = random.Random(5)
    for size in (30, 400, 3000):
        body = [r.randrange(2) for _ in range(size)] * 2 + [0] * 70
        line = np.array([7, *body, 8])
        grammar = pr.Grammar(line)
        i = np.array([r.randrange(1, len(body)) for _ in range(300)])
        j = np.array([r.choice([x for x in (r.randrange(1, len(body) + 1), (k + size) % len(body) + 1) if x != k] or [len(body) + 1]) for k in i])
        for a, b, ahead, back in zip(i, j, grammar.forward(i, j), grammar.backward(i, j)):
            n = 0
            while line[a + n] == line[b + n]:
                n += 1
            m = 0
            while line[a - m] == line[b - m]:
                m += 1
            assert (n, m) == (ahead, back)


def test_a_long_run_takes_few_rounds():
    line = np.array([5, *([0, 1, 2] * 40_000), 6])
    grammar = pr.Grammar(line)
    assert grammar.forward(np.array([1]), np.array([4]))[0] == 119_997
    (runs,) = pr.find_runs([line[1:-1]])
    assert runs.tolist() == [[0, 120_000, 3]]


def test_candidates_in_small_ranges(monkeypatch):
    r = random.Random(6)
    text = np.array(some_text(r) + [1, 2, 3] * 20)
    whole = pr.find_runs([text, text])
    monkeypatch.setattr(pr, "CANDIDATES", 7)
    assert [x.tolist() for x in pr.find_runs([text, text])] == [x.tolist() for x in whole]


def want_row(doc_id, text):
    words = [w for w in (text or "").replace("\x0b", " ").split(" ") if w]
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    r = random.Random(8)
    rows = [(i, " ".join(f"é{x}" for x in some_text(r)), "x") for i in range(60)]
    rows += [(i, " ".join(str(r.randrange(50)) for _ in range(r.randrange(1, 90))), None) for i in range(100, 160)]
    rows += [(None, "a b " * 9, "x"), (3, None, "y"), (3, None, "y"), (4, "", None), (5, " \x0b ", "x"), (6, "a\x0b" * 12, "x"), (7, "a " * 11, "x"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = pr.run_digest(pr.collapse_runs(pr.planted(docs))).drop("n_words").collect()
    assert sorted(map(tuple, got), key=str) == sorted((want_row(i, t) for i, t, _ in rows), key=str)
    assert pr.run_digest(pr.collapse_runs(pr.planted(docs.limit(0)))).count() == 0
