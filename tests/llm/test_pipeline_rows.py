"""Stages of the pipeline: rows decided by themselves, empty tables, clashing columns, the whole run."""

import random

import pytest

import corpus_pipeline
from tests.llm.test_quality import clean

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], COLUMNS).repartition(3)


def left(df):
    assert df.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    return sorted(((x["doc_id"], x["text"]) for x in df.collect()), key=repr)


def test_quality_by_row(spark):
    r = random.Random(1)
    good = [(i, clean(r, r.randrange(60, 400))) for i in range(250)]
    rows = good + [(None, "too short"), (None, clean(r, 100)), (5, "too short too")]
    want = good + [rows[251]]
    assert left(corpus_pipeline.quality(spark, frame(spark, rows), "")) == sorted(want, key=repr)


def test_one_of_each_group_by_row(spark):
    r = random.Random(2)
    a, b, c, d = (clean(r, 200) for _ in range(4))
    rows = [(5, a), (5, b), (3, b), (None, c), (None, c), (None, c), (7, d), (7, d), (None, d), (8, d)]
    assert left(corpus_pipeline.near_copies(spark, frame(spark, rows), "")) == sorted([(5, a), (3, b), (None, c), (7, d)], key=repr)


def test_benchmark_by_row(spark, tmpdir_path):
    r = random.Random(3)
    item, other, more = clean(r, 40), clean(r, 60), clean(r, 60)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    rows = [(None, item), (None, other), (4, item), (4, more)]
    assert left(corpus_pipeline.benchmark_passages(spark, frame(spark, rows), tmpdir_path)) == sorted([(None, other), (4, more)], key=repr)


def test_repeated_passages(spark):
    r = random.Random(4)
    a, b, c = (clean(r, 80) for _ in range(3))
    shared = "é" + clean(r, 60)
    rows = [(1, f"{a} {shared}"), (2, f"{shared}{b}"), (3, a), (4, None), (None, "short"), (5, c), (6, "")]
    df = spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in rows], COLUMNS).repartition(3)
    got = {x["doc_id"]: (x["text"], x["n_chars"]) for x in corpus_pipeline.repeated_passages(spark, df, "").collect()}

    def removed(text, earlier):
        """Characters left when every byte inside a 50-byte string of an earlier text is taken out."""
        raw, cut = text.encode(), set()
        for i in range(len(raw) - 49):
            if any(raw[i:i + 50] in e.encode() for e in earlier):
                cut.update(range(i, i + 50))
        return bytes(x for i, x in enumerate(raw) if i not in cut).decode(errors="ignore")

    assert got[1] == (rows[0][1], len(rows[0][1])) and got[5] == (c, len(c)) and got[None] == ("short", 5)
    text = removed(rows[1][1], [rows[0][1]])
    assert got[2] == (text, len(text)) and b[1:] in text and shared not in text
    assert 3 not in got and got[4] == (None, 0) and got[6] == ("", 0)


def test_mixed(spark):
    rows = [(i, "w " * (i % 9), "en", "ab"[i % 5 == 0], 1) for i in range(400)] + [(None, None, "en", None, 0)]
    got = corpus_pipeline.mixed(spark, spark.createDataFrame(rows, COLUMNS), "").collect()
    assert sorted(((x["doc_id"], x["size"]) for x in got), key=repr) == sorted(((d, len((t or "").split())) for d, t, *_ in rows), key=repr)
    for s in "ab":
        own = [x for x in got if x["source"] == s]
        assert abs(sum(x["taken"] for x in own) - own[0]["target"]) <= 9


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_empty_table(spark, tmpdir_path, number):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    out = corpus_pipeline.STAGES[number][1](spark, spark.createDataFrame([], COLUMNS), tmpdir_path)
    assert out.count() == 0


def test_clashing_columns(spark, tmpdir_path):
    r = random.Random(5)
    spark.createDataFrame([(1, clean(r, 40))], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    rows = [(i, clean(r, 100), "en", "a", 1, i + 0.5, f"k{i}") for i in range(60)]
    df = spark.createDataFrame(rows, COLUMNS + ", __n double, fp string")
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_copies, corpus_pipeline.repeated_passages, corpus_pipeline.benchmark_passages):
        out = stage(spark, df, tmpdir_path)
        assert out.columns == df.columns
        assert sorted(tuple(x) for x in out.collect()) == rows


def test_whole_run(spark, tmpdir_path):
    r = random.Random(6)
    item, passage = clean(r, 30), clean(r, 70)
    texts = [clean(r, r.randrange(80, 300)) for _ in range(200)]
    texts[50] += " " + passage
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(300, texts[3]), (301, " ".join(texts[4].split())), (302, "far too short"), (303, f"{clean(r, 100)} {item} {clean(r, 60)}"),
             (304, f"{clean(r, 100)} {passage} {clean(r, 60)}")]
    table = spark.createDataFrame([(d, t, "en", "ab"[d % 3 == 0], len(t)) for d, t in rows], COLUMNS)
    table.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    got = {x["doc_id"]: x for x in corpus_pipeline.run(spark, tmpdir_path).collect()}
    assert set(got) == set(range(200)) | {304}
    for d in range(200):
        assert got[d]["size"] == len(texts[d].split())
    assert 155 <= got[304]["size"] <= 165
    assert sum({x["source"]: x["target"] for x in got.values()}.values()) == pytest.approx(sum(x["size"] for x in got.values()))
    for s in "ab":
        own = [x for x in got.values() if x["source"] == s]
        assert abs(sum(x["taken"] for x in own) - own[0]["target"]) <= max(x["size"] for x in own)
