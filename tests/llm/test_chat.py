"""Chat rendering: exact round trip, masks and digests."""

import hashlib
import random

import pytest

from tidemark.llm import chat


def slow(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def rows_for(seed):
    r = random.Random(seed)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", "\n", " [/INST]", "é", "日本", "ok ", "[", "<", "/s>", "\\n", "<</s>", "$1", ""]
    say = lambda: "".join(r.choice(bits) for _ in range(r.randrange(0, 9)))
    rows = [(i // 6, i % 6, r.choice(["user", "assistant", "system", "tool\n<s>", "\\n"]), say()) for i in range(240)]
    return rows + [(100, 0, None, None), (100, 1, "assistant", None), (None, None, "assistant", "x"), (None, 1, "user", ""), (101, 5, "assistant", "long " * 40000),
                   (102, 1, "assistant", "same"), (102, 1, "assistant", "same"), (102, 1, "assistant", "other"), (102, None, "user", "first"),
                   (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def frame(spark, rows):
    return spark.createDataFrame([(*x, "p") for x in rows], "conv_id long, turn long, role string, text string, piece string").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip_and_digests(spark, seed):
    rows = rows_for(seed)
    got = chat.chat_digest(frame(spark, rows)).collect()
    assert sorted((tuple(x)[:5] for x in got), key=repr) == slow(rows)


def test_only_the_template_is_unescaped(spark):
    for x in chat.render(frame(spark, rows_for(3))).collect():
        piece, found = x["piece"], [m for m in chat.re.finditer(rf"\\.|{chat.CONTROL}", x["piece"], chat.re.S)]
        marks = [m for m in found if not m[0].startswith("\\")]
        assert [m[0] for m in marks] == (["<s>", "</s>"] if x["target"] else ["[INST]", "[/INST]"])
        assert x["piece_end"] - x["piece_start"] == len(piece)
        assert chat.escape_text(chat.read_piece(piece)[1]) in piece


def test_examples_are_prefixes(spark):
    rendered = chat.render(frame(spark, [x for x in rows_for(4) if x[0] in (1, 2, 3, None)]))
    pieces = {}
    for x in sorted(rendered.collect(), key=lambda x: x["turn_no"]):
        pieces.setdefault(x["conv_id"], []).append(x)
    texts = chat.example_texts(rendered).collect()
    points = {(x["conv_id"], x["target_turn"]): x for x in chat.expand(rendered).collect()}
    assert len(texts) == len(points) == sum(x["target"] for own in pieces.values() for x in own)
    for x in texts:
        own = pieces[x["conv_id"]]
        whole = "".join(p["piece"] for p in own)
        point = points[x["conv_id"], x["target_turn"]]
        assert x["text"] == whole[:point["text_end"]]
        assert chat.read_piece(own[x["target_turn"]]["piece"])[1] == chat.unescape(x["text"][x["loss_start"]:x["loss_end"]])


def test_digest_covers_the_examples(spark, monkeypatch):
    rows = [x for x in rows_for(5) if x[0] in (1, 2, 3, None, 100, 102)]
    rendered = chat.render(frame(spark, rows))
    points = {(x["conv_id"], x["target_turn"]): x for x in chat.expand(rendered).collect()}
    want = {x["conv_id"]: [0, 0, hashlib.sha256()] for x in rendered.collect()}
    for x in sorted(chat.example_texts(rendered).collect(), key=lambda x: x["target_turn"]):
        p, own = points[x["conv_id"], x["target_turn"]], want[x["conv_id"]]
        pointers = [p["target_turn"], p["prompt_end"], p["loss_start"], p["loss_end"], p["text_end"]]
        own[0] += 1
        own[1] += len(x["text"])
        own[2].update(f"{pointers} {hashlib.sha256(x['text'].encode()).hexdigest()}\n".encode())
    got = {x["conv_id"]: x for x in chat.digest(rendered).collect()}
    assert {c: (x["n_examples"], x["example_chars"], x["examples_sha256"]) for c, x in got.items()} == {c: (n, k, d.hexdigest()) for c, (n, k, d) in want.items()}
    expand = chat.expand
    with monkeypatch.context() as m:
        m.setattr(chat, "expand", lambda x: expand(x).where("target_turn <> 1 OR conv_id <> 102"))
        lost = {x["conv_id"]: x for x in chat.digest(rendered).collect()}
    assert lost[102] != got[102] and {c: x for c, x in lost.items() if c != 102} == {c: x for c, x in got.items() if c != 102}
    with monkeypatch.context() as m:
        m.setattr(chat, "expand", lambda x: expand(x).withColumn("prompt_end", chat.F.col("prompt_end") + 1))
        with pytest.raises(Exception, match="does not fit its rendering"):
            chat.digest(rendered).collect()


def test_empty(spark):
    assert chat.chat_digest(frame(spark, [])).count() == 0
