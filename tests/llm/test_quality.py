"""Quality rules against brute force and planted outliers; quality score on held-out labels."""

import math
import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import quality_model, quality_rules
from tidemark.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_stats(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


VOCABULARY = ["".join(random.Random(i).choices("etaoinshrdlu", k=2 + i % 7)) for i in range(800)]


def clean(r, n):
    return ". ".join(" ".join(r.choice(VOCABULARY) for _ in range(n // 10)).capitalize() for _ in range(10))


def corpus():
    r = random.Random(1)
    rows = [(i, clean(r, r.randrange(60, 400)), r.choice(["en", "de"]), r.choice(["a", "a", "a", "b", "rare"])) for i in range(900)]
    junk = []
    for i in range(1000, 1030):
        w = clean(r, 200).split()
        junk.append((i, " ".join(x + r.choice(["%%%", "$$$", "&&&"]) for x in w), "en", "a"))
        junk.append((i + 100, " ".join(w).upper(), "de", "a"))
    edge = [(2000, None, "en", "a"), (2001, "", None, None), (2002, "a b\na b\n\n a b\na b", "en", None), (2003, "x " * 80, "en", "a"), (None, clean(r, 100), "en", "a"),
            (2004, rows[0][1], "en", "a"), (2004, rows[0][1], "en", "a"), (2005, "é\x0bü\x0c\n \nö" * 9, "xx", "only"), (2006, "long " + clean(r, 60000), "en", "a"),
            (2007, "one two three four five\n" * 30, "en", "a")]
    return rows, junk, edge


def test_rules(spark, monkeypatch):
    rows, junk, edge = corpus()
    every = rows + junk + edge
    df = spark.createDataFrame([(*x, 1) for x in every], "doc_id long, text string, lang string, source string, n_words int").repartition(5)
    got = quality_rules.judge(df).collect()
    want = []
    for d, t, _, _ in every:
        s = slow_stats(t)
        want.append((d, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert sorted((tuple(x)[:7] for x in got), key=repr) == sorted(want, key=repr)
    kept = {x["doc_id"] for x in got if x["kept"]}
    assert all(not x["kept"] for x in got if x["base_failed"])
    assert all(d in kept for d, *_ in rows) and not any(d in kept for d, *_ in junk)
    shown = sorted((tuple(x) for x in got), key=repr)
    with monkeypatch.context() as m:
        # more groups than may be broadcast: the salted join gives the same
        m.setattr(quality_rules, "BROADCAST_GROUPS", 0)
        salted = sorted((tuple(x) for x in quality_rules.judge(df).collect()), key=repr)
    assert [x[:8] for x in salted] == [x[:8] for x in shown]
    left = quality_rules.drop_rejected(df)
    assert left.columns == df.columns and {x["doc_id"] for x in left.collect()} == kept
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_symbols_are_a_share_of_the_words(spark):
    r = random.Random(2)
    rows = [(i, clean(r, r.randrange(60, 400))) for i in range(400)]
    short = []
    for i in range(1000, 1010):
        w = clean(r, 60).split()
        short.append((i, " ".join(x + "#" if k % 5 == 0 else x for k, x in enumerate(w))))
    df = spark.createDataFrame([(*x, "en", "a") for x in rows + short], "doc_id long, text string, lang string, source string").repartition(3)
    got = {x["doc_id"]: x for x in quality_rules.judge(df).collect()}
    assert not any(x["base_failed"] for x in got.values())
    assert {d for d, x in got.items() if x["kept"]} == {d for d, _ in rows}


def test_score(spark):
    rows, junk, _ = corpus()
    labels = [(d, 1, 0) for d, *_ in rows] + [(d, 0, 0) for d, *_ in junk] + [(5, 0, 1), (5, None, 1), (None, 1, 0), (99999, 1, 0)]
    extra = [(3000, None, None, None), (3001, "", "en", "a"), (None, "text", "en", "a"), (3002, junk[0][1] * 50, "en", "a")]
    docs = spark.createDataFrame([(*x, 2) for x in rows + junk + extra], "doc_id long, text string, lang string, source string, quality int").repartition(3)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_model.score_quality(docs, marked).collect()
    assert len(got) == len(rows + junk + extra)
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7) for x in got)
    by = {x["doc_id"]: x for x in got}
    held = [d for d, x in by.items() if x["held_out"] and d is not None and d < 3000]
    right = sum(by[d]["predicted"] == int(d < 1000) for d in held)
    assert right >= 0.97 * len(held) and by[3002]["score"] < 0.5
    none = quality_model.score_quality(docs, marked.limit(0)).collect()
    assert {x["score"] for x in none} == {0.5}
    assert quality_model.score_quality(docs.limit(0), marked).count() == 0


def _least_determinant(rows, core, starts=400):
    """The least logarithm of a determinant that concentration from random starts finds."""
    r, best = np.random.default_rng(1), None
    for _ in range(starts):
        own = rows[r.choice(len(rows), rules.SIZE + 1, replace=False)]
        for _ in range(30):
            spread = np.cov(own.T, bias=True) + 1e-9 * np.eye(rules.SIZE)
            diff = rows - own.mean(0)
            distance = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(spread), diff)
            own = rows[np.argsort(distance)[:core]]
        # correlations are shrunk by a twentieth, as the estimates' are
        spread = np.cov(own.T, bias=True)
        value = np.linalg.slogdet(np.where(np.eye(rules.SIZE), spread, 0.95 * spread))[1]
        best = value if best is None else min(best, value)
    return best


def test_estimate_has_about_the_least_determinant(spark):
    # spreads above the floors, correlated, and a fifth of the rows far off on one side
    r = np.random.default_rng(2)
    mix = np.eye(rules.SIZE) * 2 + r.normal(size=(rules.SIZE, rules.SIZE)) * 0.6
    good, bad = r.normal(size=(160, rules.SIZE)) @ mix, r.normal(size=(40, rules.SIZE)) * 0.5 + 14
    rows = np.concatenate([good, bad])
    frame = spark.createDataFrame([(["sA"], *map(float, x)) for x in rows], "feeds array<string>, " + ", ".join(f"x{i} double" for i in range(rules.SIZE)))
    (found,) = rules.estimates(frame, 1).collect()
    core = math.ceil(rules.CORE * len(rows))
    # the core is cut in bins, so it may have a few rows more
    assert found["logdet"] <= _least_determinant(rows, core) + 0.1
    diff = rows - np.array(found["mean"])
    distance = np.einsum("ij,jk,ik->i", diff, np.array(found["inv"]).reshape(rules.SIZE, -1), diff) / found["scale"]
    limit = rules.normal_quantile(rules.CUT)
    assert (distance[160:] > limit).all() and (distance[:160] <= limit).all()


def test_small_tables_are_judged(spark):
    r = random.Random(5)
    good = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]) + str(r.randrange(1000)) for _ in range(r.randrange(60, 300))) for _ in range(140)]
    junk = [" ".join("#" * 12 + str(r.randrange(10**9)) + "$" * 9 for _ in range(70)) for _ in range(10)]
    docs = spark.createDataFrame([(i, t, f"l{i % 3}", f"s{i % 9}") for i, t in enumerate(good + junk)], "doc_id long, text string, lang string, source string")
    kept = {row["doc_id"]: row["kept"] for row in rules.judge(docs).collect()}
    assert not any(kept[i] for i in range(140, 150)) and all(kept[i] for i in range(140))
    one = rules.judge(docs.limit(1)).collect()
    assert [row["kept"] for row in one] == [True] and rules.judge(docs.limit(0)).count() == 0
