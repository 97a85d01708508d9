"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target t and total size s should be taken t / s
times: the whole part always, the fraction p by chance. Fractions are settled
in pairs: the largest open document of a source and the other open ones, which
take part as one mass. The two exchange words: one gains what the other loses,
until the document's fraction is 0 or 1; which of the two possible transfers is made is drawn so
that no probability changes on average. So a source's words are exactly
conserved until its last open document, a small one, which alone is rounded.

The pairing is a reduction tree: leaves of about ``LEAF`` documents, dealt by a hash of
id, source and size (rows that share all three, if more than ``ALIKE``, also by their number in
the table), settle all but one document of each source; groups of ``FAN``
nodes settle what is left of theirs, until one node remains. A hot source is
spread over all leaves and no task holds more than a leaf, or ``FAN`` open
documents of each source. Draws are hashes of the documents' ids, so that reruns and lost tasks agree.

Null source is a source of its own (last in the order of weights). Null and
empty texts have size 0 and are taken 0 times. Rows with the same id,
source and size are separate documents with draws alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, texts_of

LEAF = 20_000
#: rows with the same id, source and size that may go to one leaf
ALIKE = 1_000
FAN = 64
EPS = 1e-9


def with_size(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the number of words of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([len(t.split()) for t in texts_of(batch.column("__text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), sizes], [*columns, "__size"])

    rows = docs.select(*columns, F.col("text").alias("__text"))
    return rows.mapInArrow(run, rows.drop("__text").withColumn("__size", F.lit(0).cast("long")).schema)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, target) of the sources.

    A target is weight * level, at most ``most`` times the source's size; the
    level is the one at which the targets add up to all sizes. The sources
    sorted by where they stop show how many do: the level is what the stopped
    ones leave, divided by the weights of the others.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighted = totals.select("source", "source_size", weight.alias("w"), (F.col("source_size") * most).alias("stop"))
    every = Window.partitionBy()
    by_stop = Window.orderBy(F.col("stop") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    open_ = F.sum("w").over(by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighted.withColumn("level", left / open_)
    # the first source that does not stop at its level fixes it for all that follow, whose own figures are lower
    level = F.max(F.when(F.col("level") * F.col("w") <= F.col("stop"), F.col("level"))).over(every)
    first = levels.withColumn("free", F.col("level") * F.col("w") <= F.col("stop")).withColumn("common", level)
    return first.select("source", "source_size", F.when(F.col("common").isNull(), F.col("stop"))
                        .otherwise(F.least("stop", F.col("common") * F.col("w"))).alias("target"))


def _draw(*parts) -> float:
    return xxhash.xxh64_intdigest(repr(parts).encode(), 7) / 2.0**64


def settle(items: list[tuple], last: bool) -> list[tuple]:
    """Settles (key, size, p) items of one source: p is 0 or 1 after it, but for one open item unless ``last``.

    The largest open item is paired with the others together; theirs is one
    mass, so that a transfer moves each of their fractions by the same rule,
    p to alpha * p + beta. If they can balance one of the transfers only, that
    one is made: a large document would otherwise miss the target by up to its
    size. Items that they cannot balance either way are paired one by one at the
    end, and the last is rounded to the nearer side.
    """
    out, late = [], []
    items = sorted(items, key=lambda x: (-x[1], x[0]))
    mass = float(sum(s for _, s, _ in items))
    ones = float(sum(s * p for _, s, p in items))
    alpha, beta = 1.0, 0.0
    for key, size, p0 in items:
        p = min(1.0, max(0.0, alpha * p0 + beta))
        mass, ones = mass - size, max(0.0, ones - size * p)
        if size <= 0 or p <= EPS or p >= 1 - EPS:
            out.append((key, size, round(p) if size > 0 else 0))
            continue
        can_rise, can_fall = size * (1 - p) < ones, size * p < mass - ones
        if can_rise or can_fall:
            up = _draw(key) < p if can_rise and can_fall else can_rise
            out.append((key, size, int(up)))
            if up:
                shrink = 1 - size * (1 - p) / ones
                alpha, beta, ones = alpha * shrink, beta * shrink, ones - size * (1 - p)
            else:
                shrink = 1 - size * p / (mass - ones)
                alpha, beta, ones = alpha * shrink, 1 - shrink * (1 - beta), ones + size * p
        else:
            late.append((key, size, p))
    held = None
    for key, size, p in late:
        if held is None:
            held = (key, size, p)
            continue
        k, a, q = held
        # words that can go from the held one to this, and the other way
        there, back = min(a * q, size * (1 - p)), min(a * (1 - q), size * p)
        move = there if _draw(k, key) * (there + back) < back else -back
        q, p = q - move / a, p + move / size
        one, two = (k, a, q), (key, size, p)
        held = None
        for x in (one, two):
            if EPS < x[2] < 1 - EPS and held is None:
                held = x
            else:
                out.append((x[0], x[1], round(x[2])))
    if held is not None:
        k, a, q = held
        out.append((k, a, int(q >= 0.5) if last else q))
    return out


def _node(last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "row"], kind="stable").reset_index(drop=True)
        key, size, p = (frame[c].tolist() for c in ("key", "size", "p"))
        for rows in frame.groupby("source_no", sort=True).indices.values():
            place = {(key[i], n): i for n, i in enumerate(rows)}
            for k, _, q in settle([(k, size[i], p[i]) for k, i in place.items()], last):
                p[place[k]] = float(q)
        frame["p"] = p
        return frame

    return run


def mix(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``sized`` has doc_id, source, size; adds source_size, target and taken."""
    targets = checkpointed(source_targets(sized, weights, most).withColumn("source_no", F.xxhash64(F.coalesce("source", F.lit("\0null")))))
    rows = sized.withColumn("row", F.monotonically_increasing_id())
    same = F.col("t.source").eqNullSafe(F.col("r.source"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.alias("r").join(targets.alias("t"), same).select("r.*", "source_size", "target", "source_no", share.alias("share"))
    whole = F.floor(F.col("share") + EPS)
    rows = rows.withColumn("whole", whole.cast("long")).withColumn("p", F.greatest(F.col("share") - whole, F.lit(0.0)))
    n = max(1, sized.count())
    nodes = -(-n // LEAF)
    rows = rows.withColumn("key", F.xxhash64("doc_id", "source", "size"))
    alike = checkpointed(sized.groupBy(F.xxhash64("doc_id", "source", "size").alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ALIKE).select("key", "n"))
    number = F.when(F.col("n").isNull(), F.lit(0).cast("long")).otherwise(F.col("row"))
    rows = checkpointed(rows.join(alike, "key", "left").withColumn("node", F.pmod(F.xxhash64("key", number), F.lit(nodes))).drop("n"))
    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    schema = "row long, key long, source_no long, size long, p double, node long"
    left = rows.select("row", "key", "source_no", "size", "p", "node").where("p > 0")
    settled = None
    while True:
        done = checkpointed(left.groupBy("node").applyInPandas(_node(nodes == 1), schema))
        closed = done if nodes == 1 else done.where(~open_)
        settled = closed if settled is None else settled.unionByName(closed)
        if nodes == 1:
            break
        nodes = -(-nodes // FAN)
        left = done.where(open_).withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
    chosen = settled.select("row", F.col("p").alias("chance"))
    copies = F.col("whole") + F.coalesce(F.round("chance"), F.lit(0.0)).cast("long")
    return rows.join(chosen, "row", "left").withColumn("taken", copies * F.col("size")).drop("row", "source_no", "share", "whole", "p", "key", "node", "chance")


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row."""
    sized = checkpointed(with_size(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"),
                                   "doc_id", "source").withColumnRenamed("__size", "size"))
    return mix(sized, weights, most).select("doc_id", "source", "size", "source_size", "target", "taken")
