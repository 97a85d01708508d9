"""Shared cuts, groups and pair counts against brute force."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import token_align as ta

pytestmark = pytest.mark.skipif(not os.path.isdir(ta.FOLDER), reason="needs the vocabulary files")


def brute_groups(a_sizes, b_sizes):
    """Groups as token ranges, by walking both lists."""
    out, i, j, x, y, s, t = [], 0, 0, 0, 0, 0, 0
    while i < len(a_sizes) or j < len(b_sizes):
        if x <= y:
            x, i = x + a_sizes[i], i + 1
        else:
            y, j = y + b_sizes[j], j + 1
        if x == y:
            out.append((range(s, i), range(t, j)))
            s, t = i, j
    return out


def test_shared_cuts_equal_intersection():
    r = random.Random(1)
    for _ in range(300):
        texts = [sorted(r.sample(range(1, 60), r.randrange(0, 30))) + [60] for _ in range(r.randrange(1, 4) * 2)]
        a = np.array([60 * k + e for k, t in enumerate(texts[::2]) for e in t])
        b = np.array([60 * k + e for k, t in enumerate(texts[1::2]) for e in t])
        bounds = np.arange(len(texts) // 2 + 1) * 60
        assert ta.shared_cuts(a, b, bounds).tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_a_long_stretch_without_a_cut_is_one_leaf():
    a, b = np.arange(2, 200_001, 2), np.append(np.arange(1, 200_000, 2), 200_000)
    assert ta.shared_cuts(a, b, np.array([0, 200_000])).tolist() == [200_000]


def samples():
    r = random.Random(2)
    words = ["the", "naïve", "</s>", "<s>", "<|endoftext|>", "日本語", "\n\n", "  ", "\t", "😀", "١٢٣", "12345", "don't", "<0x41>", "é", "a" * 40, "=" * 30, "ﬁ", " ", "\r\n"]
    out = ["", " ", "a", "\n", "x▁y", "\x00 a", "one two\x85three four", " lead", "trail ", "<unk>", "﻿bom"]
    return out + ["".join(r.choice(words) + r.choice([" ", "", "  "]) for _ in range(r.randrange(1, 80))) for _ in range(60)]


def test_chunks_give_the_tokens_of_whole_texts(monkeypatch):
    a, b = ta.encoders(ta.FOLDER)
    for text in samples():
        for encoder in (a, b):
            (whole,) = encoder.encode([text])
            for size in (1, 7, 40):
                parts = ta.chunks(text, size)
                assert " ".join(parts) == text
                assert [i for p in encoder.encode(parts) for i in p] == whole


def test_ids_equal_those_of_the_vocabulary_file():
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{ta.FOLDER}/{ta.BYTE_FILE}")
    a.encode_special_tokens = True
    texts = samples() + ["".join(map(chr, [*range(0, 0xD800, 7), *range(0xE000, 0x11000, 5), *range(0x1D400, 0x1D800, 3), *range(0x20000, 0x20400, 9)]))]
    texts += [" ".join(texts[-1]), "a".join(texts[-2])]
    assert ta.encoders(ta.FOLDER)[0].encode(texts) == [a.encode(" " + t, add_special_tokens=False).ids for t in texts]


def brute_rows(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(f"{ta.FOLDER}/{ta.BYTE_FILE}"), SentencePieceProcessor(model_file=f"{ta.FOLDER}/{ta.PIECE_FILE}")
    a.encode_special_tokens = True
    tables = [e.table for e in ta.encoders(ta.FOLDER)]
    rows, linked = [], []
    for text in texts:
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
        if any(b"".join(t[i] for i in x) != (" " + (text or "")).encode() for t, x in zip(tables, ids)):
            ids = [[], []]
        groups = brute_groups(*([len(t[i]) for i in x] for t, x in zip(tables, ids)))
        said = ";".join(",".join(str(ids[0][i]) for i in g) + "|" + ",".join(str(ids[1][j]) for j in h) for g, h in groups)
        links = Counter((ids[0][i], ids[1][j]) for g, h in groups for i in g for j in h)
        linked.append(links)
        rows.append([len(ids[0]), len(ids[1]), len(groups), sum(links.values()), hashlib.sha256(said.encode()).hexdigest() if said else ""])
    counts = Counter(p for links in linked for p in links)
    highest = Counter()
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [(*r[:4], r[4], sum(m for p, m in links.items() if counts[p] == highest[p[0]]), sum(m * counts[p] for p, m in links.items()))
            for r, links in zip(rows, linked)]


def test_decoded_tokens_give_the_text():
    a, b = ta.encoders(ta.FOLDER)
    assert sorted(ta.byte_alphabet().values()) == list(range(256))
    for encoder in (a, b):
        (ids,) = encoder.encode(["Ünï <|endoftext|> 日本"])
        assert b"".join(encoder.table[i] for i in ids).decode() == " Ünï <|endoftext|> 日本"


@pytest.mark.parametrize("block", [1, 300, ta.BLOCK])
def test_query_equals_brute_force(spark, monkeypatch, block):
    texts = [*samples(), None, "the same", "the same", "b" * 700, "x " * 300]
    monkeypatch.setattr(ta, "BLOCK", block)
    monkeypatch.setattr(ta, "TOGETHER", 200)
    docs = spark.createDataFrame([(None if k % 9 == 0 else k // 2, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, block string")
    got = ta.alignment_digest(docs).select("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()
    assert sorted(map(tuple, got)) == sorted(brute_rows(texts))


def test_large_leaves_count_equal_ids_first(monkeypatch):
    a, b = ta.encoders(ta.FOLDER)
    texts = ["日本語 text", "aaaa bb", ""]
    links = [g.links() for _, g in ta.encode_texts(texts)]
    monkeypatch.setattr(ta, "WRITTEN", 0)
    for (_, g), want in zip(ta.encode_texts(texts), links):
        assert [x.tolist() for x in g.links()] == [x.tolist() for x in want]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ta.alignment_digest(docs).count() == 0
