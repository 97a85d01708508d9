"""Suffix automaton and phrases against brute force."""

import random
import re

from tidemark.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def test_statistics_equal_brute_force():
    r = random.Random(2)
    for _ in range(30):
        templates = [[r.choice([b"a", b"b", b"c"]) for _ in range(r.randrange(1, 12))] for _ in range(4)]
        auto = ls.Automaton(templates, 2)
        runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        text = [r.choice([b"a", b"b", b"c"]) for _ in range(60)]
        for i, (state, n) in enumerate(auto.statistics([auto.vocabulary.get(w, -1) for w in text])):
            best = max([k for k in range(1, i + 2) if tuple(text[i + 1 - k:i + 1]) in runs], default=0)
            assert n == best
            if n:
                own = text[i + 1 - n:i + 1]
                want = {(t, e) for t, w in enumerate(templates) for e in range(len(w)) if e + 1 >= n and w[e + 1 - n:e + 1] == own}
                assert set(auto.places[state]) == want
            got = sorted(p for p, size in auto.phrases[state] if size <= n)
            assert got == [p for p in range(2) if text[max(0, i + 1 - len(templates[p])):i + 1] == templates[p] and i + 1 >= len(templates[p])]


def slow_chain(anchors):
    """All sets of anchors with both places increasing."""
    best = (0, 0, 0, 0)
    for bits in range(1, 1 << len(anchors)):
        own = sorted(a for i, a in enumerate(anchors) if bits >> i & 1)
        if any(x[0] >= y[0] or x[1] >= y[1] for x, y in zip(own, own[1:])):
            continue
        covered, gaps = own[0][2], 0
        for x, y in zip(own, own[1:]):
            covered += min(y[2], y[0] - x[0], y[1] - x[1])
            gaps += max(0, y[0] - y[2] - x[0])
        best = max(best, (ls.WORD * covered - gaps, covered, -(own[0][0] - own[0][2] + 1), -own[-1][0]))
    return best[0], best[1], -best[2], -best[3]


def test_chain_takes_the_heaviest():
    assert ls.chain([(4, 4, 5), (20, 3, 4), (12, 9, 5)], 12)[1:] == (10, 0, 12)
    assert ls.chain([], 5) == (0, 0, 0, 0)
    assert ls.chain([(3, 3, 4), (4, 3, 4)], 4)[1] == 4
    assert ls.chain([(6, 6, 6), (37, 3, 4), (16, 3, 4), (9, 16, 9), (32, 19, 5), (21, 18, 8)], 20)[1] == 15
    r = random.Random(8)
    for _ in range(1500):
        size, length = r.choice([8, 20, 40]), r.choice([20, 60, 400])
        anchors = []
        for _ in range(r.randrange(1, 8)):
            end, place = r.randrange(length), r.randrange(size)
            anchors.append((end, place, r.randrange(1, 1 + min(end + 1, place + 1))))
        assert ls.chain(anchors, size) == slow_chain(anchors), anchors


def labels_of(text):
    phrases, templates = tuple(ls.PHRASES.items()), tuple((t, label) for label, t in ls.TEMPLATES.items())
    return {s["label"] for s in ls.settled(ls.scan(text.encode(), ls._automaton(phrases, templates), phrases, templates)["spans"])}


def test_overlapping_and_scattered():
    notice = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation"
    assert labels_of(notice.format("")) == {"gpl"}
    assert labels_of(notice.format("Affero ")) == {"agpl"}
    assert labels_of(notice.format("Lesser ")) == {"lgpl"}
    assert labels_of(notice.format("Affero ") + " x " * 5 + notice.format("")) == {"agpl", "gpl"}
    assert labels_of(ls.TEMPLATES["cc-by"]) == {"cc-by"} and labels_of(ls.TEMPLATES["cc-by-nc"]) == {"cc-by-nc"}
    mit = words(ls.TEMPLATES["mit"])
    cut = [" ".join(mit[i:i + 6]) for i in range(0, len(mit), 6)]
    assert labels_of((" other" * 10000 + " ").join(cut)) == set()
    assert labels_of(" other other ".join(cut)) == {"mit"}


def brute_base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in ls.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_documents(spark):
    r = random.Random(3)
    pool = [w for p in ls.PHRASES for w in p.split()] + ["foo", "é", "the"]
    rows = [(i, " ".join(r.choice(list(ls.PHRASES) + pool * 2) for _ in range(r.randrange(0, 40)))) for i in range(60)]
    mit = ls.TEMPLATES["mit"]
    rows += [(100, None), (101, ""), (102, "Under the MIT-License,under THE mit license"), (None, "cc by nc"), (103, "w " * 9 + mit + " end"),
             (104, " ".join(mit.split()[:12]) + " broken by words " + " ".join(mit.split()[20:])), (105, "plain text " * 20000), (105, "cc by nc 4"), (105, "cc by nc 4")]
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, labels string, n_words int")
    got = ls.license_scan(df).collect()
    key = lambda x: repr((x[0], x[1:6]))
    assert sorted((tuple(x)[:6] for x in got), key=key) == sorted(((d, *brute_base(t)) for d, t in rows), key=key)
    by = {x["doc_id"]: x for x in got}
    assert by[103]["labels"] == "mit" and by[103]["score"] == 1.0 and by[103]["n_base"] == 0
    span = max(by[103]["spans"], key=lambda s: s["share"])
    assert (span["label"], span["first"], span["last"]) == ("mit", 9, 9 + len(words(mit)) - 1)
    assert by[104]["labels"] == "mit" and 0.5 < by[104]["score"] < 1
    assert by[100]["labels"] == "" and by[100]["score"] == 0
    assert ls.license_scan(df.limit(0)).count() == 0
