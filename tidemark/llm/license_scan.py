"""License scans with a generalised suffix automaton of licence tokens.

The automaton accepts every run of consecutive words of every template. A
text's words are streamed through it, which gives its matching statistics:
at each word the longest run that ends there and stands in some template, and
the automaton state that knows all its places. Words that no template has
reset the stream, so only stretches of template words are walked.

* Base phrases are templates too. A phrase ends at a word exactly when the
  phrase's state is reached from the word's state by suffix links, with a
  match at least as long; this is looked up in a table made beforehand.
* Long matches (``LEAST`` words or more) that do not go on to the right are
  anchors with a place in the text and in a template. For each template they are
  chained: the heaviest chain with both places increasing gives the covered
  share of the template. A gap in the text costs, so that a chain ends
  where the words up to the next match outweigh it: scattered pieces are no span.
  A share of ``COVERED`` or more adds the template's label; of spans that overlap in
  the text the one covered best does (an AGPL notice holds most of the GPL's).

Null text is the empty text; texts without words and an empty table give
empty or no findings. Every place counts, repeats included.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of, word_table

_TABLE = word_table()
LEAST = 4
COVERED = 0.5
#: what a covered word weighs in a chain, in words of a gap
WORD = 8

#: fixed values: phrase, label
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: fixed values: label, opening of the licence or its customary notice
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
           "to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
           "sublicense, and or sell copies of the software",
    "isc": "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted, provided that "
           "the above copyright notice and this permission notice appear in all copies",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "apache-2": "Licensed under the Apache License, Version 2.0, you may not use this file except in compliance with the License. "
                "You may obtain a copy of the License at",
    "gpl": "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License as published by "
           "the Free Software Foundation",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "lgpl": "GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl": "GNU Affero General Public License as published by the Free Software Foundation",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "proprietary": "All rights reserved. No part of this publication may be reproduced, distributed or transmitted in any form or by any means "
                   "without the prior written permission of the publisher",
}


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self, templates: list[list[bytes]], n_phrases: int):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.templates = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in t] for t in templates]
        ends: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate(self.templates):
            state = 0
            for place, w in enumerate(words):
                state = self._extend(state, w)
                ends.setdefault(state, []).append((number, place))
        # places of a state: its own and those of the states that link to it
        self.places: list[list[tuple[int, int]]] = [list(ends.get(s, ())) for s in range(len(self.next))]
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.places[self.link[s]] += self.places[s]
        self.places[0] = []
        phrase_at: dict[int, list[int]] = {}
        for number in range(n_phrases):
            state = 0
            for w in self.templates[number]:
                state = self.next[state][w]
            phrase_at.setdefault(state, []).append(number)
        #: by state: phrases that end wherever a long enough match ends in it
        self.phrases: list[list[tuple[int, int]]] = []
        for s in range(len(self.next)):
            own, at = [], s
            while at > 0:
                own += [(p, len(self.templates[p])) for p in phrase_at.get(at, ())]
                at = self.link[at]
            self.phrases.append(own)

    def _new(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state for the longest run of p and w, apart from longer ones that shared a state with it."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        state = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and w not in self.next[last]:
            self.next[last][w] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, w)
        return state

    def statistics(self, numbers: list[int]) -> list[tuple[int, int]]:
        """(state, length) after each word."""
        out, state, n = [], 0, 0
        for w in numbers:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                n += 1
            else:
                state = n = 0
            out.append((state, n))
        return out


def chain(anchors: list[tuple[int, int, int]], size: int) -> tuple[int, int, int, int]:
    """(weight, covered words, first, last word of the text) of the heaviest chain; ``size`` is that of the template.

    An anchor is (last word in the text, last word in the template, words).
    Both places increase along a chain. An anchor adds the words that the one
    before it covers neither in the text nor in the template, ``WORD`` each, and
    costs 1 for each word of the text between the two. Of chains with the same weight
    that with more words is taken, then the one that starts first, then the one that ends first.

    An anchor that ends ``size`` words back or more lies before any match that
    ends here, so that its cost differs only by the distance: of those one is
    kept for each template place. The others are compared one by one.
    """
    far: list[tuple[int, int, int] | None] = [None] * size
    near: deque[tuple[int, int, int, int, int]] = deque()
    top = (0, 0, 0, 0)
    for end, place, n in sorted(anchors):
        while near and end - near[0][0] >= size:
            e, q, weight, covered, first = near.popleft()
            there = (weight + e, covered, -first)
            if far[q] is None or far[q] < there:
                far[q] = there
        begin = end - n + 1
        best = (WORD * n, n, -begin)
        for q in range(place):
            if far[q] is not None:
                weight, covered, first = far[q]
                new = min(n, place - q)
                best = max(best, (weight - begin + 1 + WORD * new, covered + new, first))
        for e, q, weight, covered, first in near:
            if e < end and q < place:
                new = min(n, end - e, place - q)
                best = max(best, (weight + WORD * new - max(0, begin - 1 - e), covered + new, -first))
        near.append((end, place, best[0], best[1], -best[2]))
        top = max(top, (*best, -end))
    return top[0], top[1], -top[2], -top[3]


def settled(spans: list[dict]) -> list[dict]:
    """Of the spans with a share of ``COVERED`` or more those that meet no better one; better is the greater share, then more words, then the label."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (-s["share"], -s["covered"], s["label"])):
        if s["share"] >= COVERED and all(s["last"] < t["first"] or t["last"] < s["first"] for t in out):
            out.append(s)
    return out


@lru_cache(4)
def _automaton(phrases: tuple, templates: tuple) -> Automaton:
    return Automaton([words_of(t) for t, _ in (*phrases, *templates)], len(phrases))


def scan(text: bytes, auto: Automaton, phrases: tuple, templates: tuple) -> dict:
    """Words, base places and covered spans (label, share, first and last word) of one text."""
    words = text.translate(_TABLE).split()
    numbers = np.fromiter(map(auto.vocabulary.get, words, repeat(-1)), np.int32, len(words))
    known = np.concatenate([[False], numbers >= 0, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1])
    least = min([LEAST, *(len(auto.templates[i]) for i in range(len(phrases)))])
    places, anchors = [], {}
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a < least:
            continue
        stats = auto.statistics(numbers[a:b].tolist())
        for i, (state, n) in enumerate(stats):
            places += [(a + i - size + 1, p) for p, size in auto.phrases[state] if size <= n]
            if n >= LEAST and (i + 1 == len(stats) or stats[i + 1][1] <= n):
                for number, place in auto.places[state]:
                    anchors.setdefault(number, []).append((a + i, place, n))
    spans = []
    for number, own in sorted(anchors.items()):
        if number >= len(phrases):
            size = len(auto.templates[number])
            _, covered, first, last = chain(own, size)
            spans.append({"label": templates[number - len(phrases)][1], "share": covered / size, "covered": covered, "first": first, "last": last})
    return {"n_words": len(words), "places": places, "spans": spans}


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``score`` is the largest covered share of a template, 1 where a base phrase stands. ``spans`` holds the heaviest chain of
    every template with a long match, whatever its share.
    """
    phrases_ = tuple((PHRASES if phrases is None else phrases).items())
    templates_ = tuple((t, label) for label, t in (TEMPLATES if templates is None else templates).items())
    span = pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("covered", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
    kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
             "labels": pa.string(), "score": pa.float64(), "spans": span}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(phrases_, templates_)
        for batch in batches:
            rows = []
            for text in texts_of(batch.column(1)):
                got = scan(text, auto, phrases_, templates_)
                starts = [s for s, _ in got["places"]]
                base = {phrases_[p][1] for _, p in got["places"]}
                labels = base | {s["label"] for s in settled(got["spans"])}
                share = max([0.0, *(s["share"] for s in got["spans"])])
                rows.append((got["n_words"], len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                             ",".join(sorted(labels)), 1.0 if base else min(1.0, share), got["spans"]))
            cols = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds.values()))], ["doc_id", *kinds])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
             "spans array<struct<label:string,share:double,covered:long,first:long,last:long>>")
