"""Base matches, counts and disclosing terms against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

from tidemark.llm import disclosure as d

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def card(r, n=16):
    body = "4" + "".join(r.choice("0123456789") for _ in range(n - 2))
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    parts = ["a@b.c", "@", ".", "_", "1", "25", "300", "0255", "+", "+1 (555) 010-0199", " ", "-", "é", "x.y", "@b.c_d@e.f", "1.2.3.4", "..", "+-", "(", "a%b+c"]
    seen = Counter()
    for _ in range(4000):
        text = "".join(r.choice([*parts, card(r), card(r, 19)]) for _ in range(r.randrange(0, 14)))
        got = [s[:3] for s in d.base_spans(text)]
        assert got == plain_spans(text), text
        seen.update(k for k, _, _ in got)
    assert min(seen[k] for k in range(4)) > 50


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a." * 200_000 + "@", "+1" + "(" * 400_000, "@" * 200_000, "1 " * 200_000):
        d.base_spans(text)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    spans = plain_spans(text)
    return [(m.start(), m.end(), m.group()) for m in WORD.finditer(low) if not any(s < m.end() and m.start() < e for _, s, e in spans)]


def plain_disclosing(texts):
    """term -> action, from whole lists of occurrences."""
    all_terms, together, contexts = Counter(), Counter(), {}
    for t in texts:
        words = plain_words(t)
        all_terms.update(w for _, _, w in words)
        near = {}
        for kind, s, e in plain_spans(t):
            value = t[s:e].lower() if kind < 2 else re.sub("[^0-9]", "", t[s:e])
            left, right = [i for i, w in enumerate(words) if w[0] < s][-d.NEAR:], [i for i, w in enumerate(words) if w[0] >= s][:d.NEAR]
            near.setdefault((kind, value), set()).update(left + right)
        for entity, places in near.items():
            together.update((entity, words[i][2]) for i in places)
            rest = [d._word_hash(w[2]) for i, w in enumerate(words) if i not in places] or [d._word_hash(w[2]) for w in words]
            for w in {words[i][2] for i in places}:
                contexts.setdefault((entity, w), Counter())[min(rest)] += 1
    out = {}
    for (entity, w), n in together.items():
        c = contexts[entity, w].values()
        if sum(c) ** 2 / sum(x * x for x in c) < d.CONTEXTS or math.log2(all_terms[w] / n) > d.MOST_BITS:
            continue
        head = w[:d.HEAD]
        whole = sum(n for v, n in all_terms.items() if v[:d.HEAD] == head)
        own = sum(n for (e, v), n in together.items() if e == entity and v[:d.HEAD] == head)
        general = len(w) > d.HEAD and math.log2(whole / own) > d.MOST_BITS
        out[w] = "generalise" if general and out.get(w) != "remove" else "remove"
    return out


def corpus():
    r = random.Random(11)
    filler = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]

    def prose(n):
        return " ".join(r.choice(filler) for _ in range(n))

    texts = [prose(r.randrange(50, 120)) for _ in range(120)]
    # a name that only stands with one address, and one that stands elsewhere as often
    texts += [f"{prose(60)} Zebulon Quartz writes from zq.77@mail.example.com {prose(60)}" for _ in range(6)]
    texts += [f"{prose(40)} dispatcher common, {prose(40)}" for _ in range(30)]
    texts += [f"{prose(40)} writes from {prose(40)}" for _ in range(30)]
    texts += [f"{prose(40)} Dispatcher +1 (555) 010-0123 {prose(60)}" for _ in range(5)]
    # a class with many other members, and a clean text that gives the first entity away
    texts += [f"{prose(30)} zebra zebrine zebu {prose(30)}" for _ in range(9)] + [f"{prose(30)} as ZEBULON said"]
    # near copies of one text are one context
    one = f"{prose(80)} Copernica Lunde, 10.0.0.7, {prose(80)}"
    texts += [one.replace(" ", f" v{k} ", 1) for k in range(20)] + [one] * 20
    return texts + ["", "   ", "é" * 5000]


def test_disclosing_terms_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = d.disclosures(docs).collect()
    want = plain_disclosing(texts)
    got = {}
    for row in found:
        got[row["term"]] = "remove" if "remove" in (row["action"], got.get(row["term"])) else row["action"]
        assert abs(row["information"] - row["pmi"] - row["left_open"]) < 1e-9 and row["left_open"] <= d.MOST_BITS
    assert got == want
    assert got["zebulon"] == "generalise" and got["quartz"] == "remove"
    assert "dispatcher" not in got and "copernica" not in got


def test_spans_and_texts(spark):
    texts = [*corpus(), None, "only a@b.c"]
    rows = [(None if i % 5 == 0 else i // 2, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, term int")
    terms = plain_disclosing([t or "" for t in texts])
    want = []
    for i, t, _, _ in rows:
        base = [f"{d.KINDS[k]}:{s}:{e}" for k, s, e in plain_spans(t or "")]
        more = [f"term:{s}:{e}" for s, e, w in plain_words(t or "") if w in terms]
        kinds = Counter(b.split(":")[0] for b in base)
        want.append((i, *(kinds[k] for k in d.KINDS), hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(base + more)))
    got = d.span_digest(d.personal_data(docs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    clean = {r["term"]: r["text"] for r in d.sanitise(docs).collect()}
    assert len(clean) == len(rows) and clean[len(texts) - 2] is None and clean[len(texts) - 1] == "only [EMAIL]"
    said = clean[next(i for i, t in enumerate(texts) if "Zebulon" in (t or ""))]
    assert " zeb* [TERM] writes from [EMAIL] " in said
    assert clean[next(i for i, t in enumerate(texts) if "ZEBULON" in (t or ""))].endswith(" as zeb* said")
    assert clean[0] == texts[0]


def test_overlapping_spans_become_one(spark):
    docs = spark.createDataFrame([(1, "call +1 10.20.30.40 55 now")], "doc_id long, text string")
    assert d.sanitise(docs).first()["text"] == "call [PHONE] now"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert d.span_digest(d.personal_data(docs)).count() == 0 and d.sanitise(docs).count() == 0
