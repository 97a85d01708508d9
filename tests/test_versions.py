import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import effective_versions


def _loop(rows):
    """Plain loop over each key, the definition of the operator."""
    out = set()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for _, g in by.items():
        g.sort(key=lambda r: ((r[1] is not None, r[1]), (r[2] is not None, r[2]), r[3]))
        base = 0
        for i, r in enumerate(g):
            if not r[4] or r[5] != "NEW HOLDINGS":
                base = i
        out.update(r[3] for r in g[base:])
    return out


SCHEMA = "cik string, filing_date date, amendment_no long, acc string, is_amendment boolean, amendment_type string"


def _run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    rep = ~F.coalesce(F.col("is_amendment"), F.lit(False)) | (F.col("amendment_type") != "NEW HOLDINGS")
    return {r.acc for r in effective_versions(df, ["cik"], ["filing_date", "amendment_no", "acc"], rep).collect()}


def test_fixture_cases(spark):
    d = dt.date
    rows = [
        ("A", d(2025, 5, 1), None, "a1", False, ""), ("A", d(2025, 5, 2), 1, "a2", True, "RESTATEMENT"),
        ("A", d(2025, 5, 3), 2, "a3", True, "NEW HOLDINGS"),
        ("B", d(2025, 5, 1), None, "b1", False, ""), ("B", d(2025, 5, 2), 1, "b2", True, "NEW HOLDINGS"),
        ("C", d(2025, 5, 1), None, "c1", False, ""), ("C", d(2025, 5, 2), 1, "c2", True, ""),
        ("D", d(2025, 5, 1), 1, "d1", True, "NEW HOLDINGS"), ("D", d(2025, 5, 2), 2, "d2", True, "NEW HOLDINGS"),
        ("E", d(2025, 5, 1), None, "e1", None, ""), ("E", d(2025, 5, 2), 1, "e2", True, "NEW HOLDINGS"),
        ("F", d(2025, 5, 1), 1, "f2", True, "RESTATEMENT"), ("F", d(2025, 5, 1), None, "f1", False, ""),
    ]
    assert _run(spark, rows) == {"a2", "a3", "b1", "b2", "c2", "d1", "d2", "e1", "e2", "f2"}


def test_against_loop_random(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        rows.append((f"m{rnd.randrange(150)}", dt.date(2025, 5, 1) + dt.timedelta(days=rnd.randrange(20)),
                     rnd.choice([None, 1, 2, 3]), f"acc{i:05d}", rnd.choice([None, True, False]),
                     rnd.choice(["", "NEW HOLDINGS", "RESTATEMENT"])))
    assert _run(spark, rows) == _loop(rows)
