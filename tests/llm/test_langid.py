"""Language identification: encoding against letter by letter, held-out accuracy, edge rows."""

import random

import numpy as np
import pytest

from tidemark.llm import langid


def slow_encode(text):
    out, low, symbols = np.zeros(langid.DIMENSIONS), "\0" + text.lower() + "\0", []
    for c in low:
        s = ord(c) if c.isalpha() else 0
        if s or not symbols or symbols[-1]:
            symbols.append(s)
    for i in range(len(symbols) - langid.GRAM + 1):
        v = np.ones(langid.DIMENSIONS)
        for k in range(langid.GRAM):
            v *= np.roll(langid.letter_vector(symbols[i + langid.GRAM - 1 - k]), k)
        out += v
    return out


@pytest.mark.parametrize("columns", [4096, 7])
def test_encoding(monkeypatch, columns):
    monkeypatch.setattr(langid, "COLUMNS", columns)
    texts = ["Straße, été!", "", "a", "!!", "日本語 und ABC abc", "x" * 50 + " y1z"]
    assert np.array_equal(langid.encode(texts), np.stack([slow_encode(t) for t in texts]).astype(np.float32))


def test_held_out_and_edges(spark):
    r = random.Random(1)
    sound = {"aa": "bado kimu", "bb": "xyzq wrst", "cc": "éàü ßöä"}
    rows = []
    for i in range(300):
        lang = r.choice(list(sound))
        rows.append((i, "".join(r.choice(sound[lang]) for _ in range(r.randrange(30, 200))), lang))
    rows += [(400, None, "aa"), (401, "", "bb"), (402, "12 !? \n", "cc"), (None, "bado bado kimu", "zz"), (403, "bado kimu", None), (404, rows[0][1], rows[0][2]),
             (404, rows[0][1], rows[0][2]), (405, "bado " * 30000, "aa")]
    df = spark.createDataFrame([(d, t, x, 1) for d, t, x in rows], "doc_id long, text string, lang string, score int").repartition(4)
    got = {}
    for x in langid.language_id(df).collect():
        got.setdefault(x["doc_id"], []).append(x)
    assert sum(map(len, got.values())) == len(rows)
    held = [d for d in range(300) if got[d][0]["held_out"]]
    assert len(held) > 30 and all(got[d][0]["lang_pred"] == rows[d][2] for d in held)
    assert all(0 <= x["score"] <= 1 for v in got.values() for x in v)
    assert [got[d][0]["lang_pred"] for d in (400, 401, 402)] == ["und"] * 3
    assert got[None][0]["lang_pred"] == "aa" and got[403][0]["lang_pred"] == "aa" and got[405][0]["lang_pred"] == "aa"
    assert len(got[404]) == 2


def test_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    assert langid.language_id(spark.createDataFrame([], schema)).count() == 0
    assert [x["lang_pred"] for x in langid.language_id(spark.createDataFrame([(1, "abc", None)], schema)).collect()] == ["und"]
