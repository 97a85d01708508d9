"""Chat formatting by prefix-target expansion.

A conversation is rendered once. A turn becomes ``[INST] `` + role + newline +
text + `` [/INST]`` or, for a trainable role, ``<s>`` + role + newline + text +
``</s>``. Control strings inside roles and texts, and the escape character,
get a backslash before them, so that the rendering can be read back. In a
role a newline is written as a backslash and ``n``.

Every assistant turn is an example of its own: its text is the rendering
from the start to that turn's end, and only the reply is under the loss mask.
Examples are rows that point into the rendering (``prompt_end``,
``loss_start``, ``loss_end``), as the texts of all prefixes would grow with the
square of the turns; ``example_texts`` writes them out where that is wanted.
The digest of a conversation reads every example back, its context included.

Turns are ordered by turn, then role and text; null turns come first, null
roles and texts are empty, rows that repeat are turns of their own, and rows with
a null conversation id make one conversation. A conversation may hold any
share of the rows: rows are rendered and escaped one by one, offsets are
running sums that spill, and the digest reads its rows as a sorted stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRAINABLE = "assistant"
CONTROL = r"</?s>|\[/?INST\]"
_ESCAPE = re.compile(rf"\\|{CONTROL}")
_READ = re.compile(rf"\\(\\|n|{CONTROL})")
_PIECE = re.compile(rf"(\[INST\] |<s>)((?:\\.|[^\\\n])*)\n(.*?)( \[/INST\]|</s>)\Z", re.S)


def escape(column) -> F.Column:
    return F.regexp_replace(column, r"(\\|" + CONTROL + ")", r"\\$1")


def escape_text(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _READ.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    found = _PIECE.match(piece)
    if not found:
        raise ValueError("not a rendered turn")
    return unescape(found[2]), unescape(found[3])


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, turn_no (from 0), piece, piece_start, piece_end, target, loss_start, loss_end of every turn."""
    empty = F.lit("")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    target = role == TRAINABLE
    head = F.concat(F.when(target, "<s>").otherwise("[INST] "), F.regexp_replace(escape(role), "\n", r"\\n"), F.lit("\n"))
    body = escape(text)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), target.alias("target"), head.alias("head"), body.alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.when(F.col("target"), "</s>").otherwise(" [/INST]")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    end = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumns({"turn_no": F.row_number().over(order).cast("long") - 1, "piece_end": end})
    rows = rows.withColumn("piece_start", F.col("piece_end") - F.length("piece"))
    start = F.col("piece_start") + F.length("head")
    return rows.select("conv_id", "turn_no", "piece", "piece_start", "piece_end", "target",
                       F.when(F.col("target"), start).alias("loss_start"), F.when(F.col("target"), start + F.length("body")).alias("loss_end"))


def expand(rendered: DataFrame) -> DataFrame:
    """One row for each assistant turn: the prefix of the rendering that is its text, and its loss mask."""
    return rendered.where("target").select("conv_id", F.col("turn_no").alias("target_turn"), F.col("piece_start").alias("prompt_end"),
                                           "loss_start", "loss_end", F.col("piece_end").alias("text_end"))


def example_texts(rendered: DataFrame) -> DataFrame:
    """conv_id, target_turn, text, loss_start, loss_end with the context written out in every example.

    The size of the result is that of all prefixes together.
    """
    examples, pieces = expand(rendered).alias("e"), rendered.alias("p")
    same = F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("p.turn_no") <= F.col("e.target_turn"))
    rows = examples.join(pieces, same).groupBy("e.conv_id", "e.target_turn", "e.loss_start", "e.loss_end")
    ordered = F.sort_array(F.collect_list(F.struct("p.turn_no", "p.piece")))
    return rows.agg(F.concat_ws("", F.transform(ordered, lambda x: x["piece"])).alias("text")).select("conv_id", "target_turn", "text", "loss_start", "loss_end")


def with_examples(rendered: DataFrame) -> DataFrame:
    """The rendered turns in whose rows an example ends, with its pointers; they are null in the other rows."""
    examples, pieces = expand(rendered).alias("e"), rendered.select("conv_id", "turn_no", "piece").alias("p")
    same = F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("e.target_turn") == F.col("p.turn_no"))
    return pieces.join(examples, same, "left").select("p.*", "e.target_turn", "e.prompt_end", "e.loss_start", "e.loss_end", "e.text_end")


def digest(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendering and its examples: turns, their digest, loss text, its digest, characters,
    examples, the characters of all their texts, and a digest of their pointers and texts.

    The text of an example is a prefix of the rendering, so that its digest is that of the stream up to its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            out = []
            for conv, piece, *example in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", *_POINTERS))):
                if held is None or held["conv_id"] != conv:
                    out += [held] if held else []
                    held = {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0,
                            "n_examples": 0, "example_chars": 0, "examples": hashlib.sha256(), "stream": hashlib.sha256()}
                role, text = read_piece(piece)
                held["n_turns"] += 1
                held["turns"].update(f"{role}\n{text}\n".encode())
                if example[0] is not None:
                    _, prompt_end, first, last, text_end = example
                    # what comes before the piece is its context: every pointer counts from the start of the rendering
                    if prompt_end != held["chars"] or not prompt_end <= first <= last <= text_end <= prompt_end + len(piece):
                        raise ValueError("an example does not fit its rendering")
                    loss = unescape(piece[first - prompt_end:last - prompt_end])
                    held["loss_chars"] += len(loss)
                    held["loss"].update(loss.encode())
                    whole = held["stream"].copy()
                    whole.update(piece[:text_end - prompt_end].encode())
                    held["n_examples"] += 1
                    held["example_chars"] += text_end
                    held["examples"].update(f"{example} {whole.hexdigest()}\n".encode())
                held["stream"].update(piece.encode())
                held["chars"] += len(piece)
            yield _digests(out)
        if held:
            yield _digests([held])

    ordered = with_examples(rendered).repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
                                   "n_examples long, example_chars long, examples_sha256 string")


_POINTERS = ("target_turn", "prompt_end", "loss_start", "loss_end", "text_end")


def _digests(rows: list[dict]) -> pa.RecordBatch:
    fields = {"conv_id": "conv_id", "n_turns": "n_turns", "turns_sha256": "turns", "loss_chars": "loss_chars", "loss_sha256": "loss",
              "formatted_chars": "chars", "n_examples": "n_examples", "example_chars": "example_chars", "examples_sha256": "examples"}
    cols = [pa.array([x[f].hexdigest() for x in rows], pa.string()) if n.endswith("sha256") else pa.array([x[f] for x in rows], pa.int64()) for n, f in fields.items()]
    return pa.RecordBatch.from_arrays(cols, list(fields))


def chat_digest(conversations: DataFrame) -> DataFrame:
    return digest(render(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")))
