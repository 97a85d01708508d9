import datetime as dt
import random

from tidemark.operators import asof_backward


def test_tolerance_edges(spark):
    d = dt.date
    left = spark.createDataFrame([("x", d(2025, 1, 11)), ("y", d(2025, 1, 12))], "k string, day date")
    right = spark.createDataFrame([("x", d(2025, 1, 1), 1.0), ("y", d(2025, 1, 1), 2.0)], "k string, d date, v double")
    out = {r.k: r.m_v for r in asof_backward(left, right, ["k"], "day", "d", dt.timedelta(days=10), ["v"], "m_").collect()}
    assert out == {"x": 1.0, "y": None}


def test_against_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    right = {(rnd.randrange(20), base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 30))) for _ in range(2000)}
    right = [(k, t, float(i)) for i, (k, t) in enumerate(sorted(right))]
    left = [(i, rnd.randrange(20), base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 30))) for i in range(800)]
    tol = dt.timedelta(hours=6)
    L = spark.createDataFrame(left, "id long, k long, ts timestamp_ntz")
    R = spark.createDataFrame(right, "k long, rts timestamp_ntz, v double")
    got = {r.id: r.m_v for r in asof_backward(L, R, ["k"], "ts", "rts", tol, ["v"], "m_").collect()}
    for i, k, t in left:
        cands = [(rt, v) for kk, rt, v in right if kk == k and t - tol <= rt <= t]
        want = max(cands)[1] if cands else None
        assert got[i] == want, (i, k, t)


def test_null_keys_and_times_match_nothing(spark):
    d = dt.date
    left = spark.createDataFrame([(None, d(2025, 1, 5), 1), ("a", None, 2), ("a", d(2025, 1, 5), 3)], "k string, d date, n int")
    right = spark.createDataFrame([(None, d(2025, 1, 4), 10.0), ("a", d(2025, 1, 4), 20.0), ("a", None, 30.0)], "k string, d date, v double")
    got = asof_backward(left, right, ["k"], "d", "d", dt.timedelta(days=10), ["v"])
    assert {r.n: r.match_v for r in got.collect()} == {1: None, 2: None, 3: 20.0}


def test_small_ranges_equal_brute_force(spark, monkeypatch):
    from tidemark.operators import asof
    monkeypatch.setattr(asof, "ROWS", 40)
    rnd = random.Random(4)
    day = dt.date(2025, 1, 1)
    # one key holds most rows, days tie, and the tolerance spans everything
    right = [(rnd.choice("aaaab"), day + dt.timedelta(days=rnd.randrange(400)), float(i % 50)) for i in range(300)]
    left = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), day + dt.timedelta(days=rnd.randrange(420) - 10)) for i in range(900)]
    for days in (5, 10_000):
        got = asof_backward(spark.createDataFrame(left, "id int, k string, day date"), spark.createDataFrame(right, "k string, d date, v double"),
                            ["k"], "day", "d", dt.timedelta(days=days), ["v"], "m_").collect()
        assert len(got) == len(left)
        for r in got:
            some = [(d, v) for k, d, v in right if k == r.k and d <= r.day and (r.day - d).days <= days]
            assert (r.m_d, r.m_v) == (max(some) if some else (None, None))


def test_one_key_is_cut_into_ranges(spark, monkeypatch):
    from tidemark.operators import asof
    kept = {}

    def keep(df):
        kept["ranges"] = checkpointed(df)
        return kept["ranges"]
    checkpointed = asof.checkpointed
    monkeypatch.setattr(asof, "checkpointed", keep)
    monkeypatch.setattr(asof, "ROWS", 100_000)
    left = spark.range(600_000).selectExpr("'k' AS k", "timestamp_micros(id * 1000) AS t", "id")
    right = spark.range(400_000).selectExpr("'k' AS k", "timestamp_micros(id * id % 599999989 * 1) AS t", "id AS v")
    got = asof_backward(left, right, ["k"], "t", "t", dt.timedelta(days=365), ["v"])
    assert got.where("match_v IS NOT NULL AND match_t <= t").count() == 600_000
    sizes = [r["count"] for r in kept["ranges"].groupBy("_range").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 300_000
