"""Targets against water filling, and what the mix must keep."""

import random

import pytest

from tidemark.llm import mixing


def slow_targets(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: most * sizes[s] for s in over}


def rows_of(spark, rows, parts=4):
    return spark.createDataFrame([(d, t, s, 1, 2) for d, t, s in rows], "doc_id long, text string, source string, size int, node int").repartition(parts)


def test_targets_sizes_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 30)
    monkeypatch.setattr(mixing, "FAN", 3)
    r = random.Random(1)
    rows = [(i, " w\x0b" * r.randrange(1, 60), r.choice(["a", "b", "b", "b", "b", "é", "Z", None])) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", "b"), (1002, " \n", "empty"), (None, "x y", "a"), (7, "again", "a"), (7, "again", "a"), (1003, "tiny", "q")]
    got = mixing.mix_documents(rows_of(spark, rows)).collect()
    sizes = {}
    for d, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    want = slow_targets(sizes)
    assert len(got) == len(rows)
    taken = {}
    for x in got:
        assert x["source_size"] == sizes[x["source"]] and x["target"] == pytest.approx(want[x["source"]])
        assert x["taken"] in [c * x["size"] for c in range(4)]
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 30
    again = mixing.mix_documents(rows_of(spark, rows[::-1], 7)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, again)))


def test_fractions_are_kept_on_average():
    ups = 0
    for seed in range(3000):
        items = [((seed, i), size, 0.3) for i, size in enumerate([9, 7, 7, 5, 3, 2, 1] * 3)]
        out = mixing.settle(items, True)
        assert sorted(k for k, _, _ in out) == [k for k, _, _ in items] and all(p in (0, 1) for _, _, p in out)
        ups += [p for k, _, p in out if k[1] == 0][0]
        left = mixing.settle(items, False)
        assert sum(s * p for _, s, p in left) == pytest.approx(0.3 * 102)
        assert sum(0 < p < 1 for _, _, p in left) <= 1
    assert abs(ups / 3000 - 0.3) < 0.03


def test_empty_table_and_no_words(spark):
    assert mixing.mix_documents(rows_of(spark, [])).count() == 0
    got = mixing.mix_documents(rows_of(spark, [(1, None, None), (2, "", "a")])).collect()
    assert all(x["taken"] == 0 and x["target"] == 0 for x in got)


def test_rows_alike_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 500)
    monkeypatch.setattr(mixing, "ALIKE", 50)
    seen = spark.sparkContext.accumulator(0)
    node = mixing._node

    def counted(last):
        run = node(last)

        def count(frame):
            assert len(frame) < 1000
            seen.add(len(frame))
            return run(frame)

        return count

    monkeypatch.setattr(mixing, "_node", counted)
    rows = [(None, "a", 7)] * 6000 + [(i, "b", 5) for i in range(1000)] + [(3, None, 11)] * 1000
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(4)).collect()
    assert seen.value >= 6000 and len(got) == 8000
    for source in ("a", "b", None):
        own = [x for x in got if x["source"] == source]
        assert abs(sum(x["taken"] for x in own) - own[0]["target"]) <= 11
        assert all(x["taken"] <= 3 * x["size"] for x in own)
