"""Quality rules: robust multivariate outliers per language and source.

Base rules, exact: words, characters in words, symbols, repeated lines, words
in repeated three-word windows; a text with under 50 words or with over half
of its words in repeated windows fails.

Method: the statistics of the other texts become a vector of six logarithms
and shares. For each language and source the minimum-covariance-determinant
estimate of its centre and spread is found by concentration steps: distances
under the current estimate, the share (``CORE``) of the rows that is nearest,
mean and covariance of those, again, until no group's determinant falls any more. There are
two starts, the medians with the floors as spread, and mean and covariance of all rows; of all
steps of both the estimate with the least determinant counts. All steps are aggregations over the
rows: distances are counted in fine bins and a table of estimates comes to
the rows, so no group's rows meet in one task. The spread is scaled so that the median distance is that of a normal
sample, and each variance has a floor, so that a statistic that hardly varies
in a group does not reject what differs from it by a trifle. Rows beyond
``CUT`` standard deviations of the chi-square distance (Wilson and Hilferty) are rejected.

Groups with fewer than ``FEWEST`` rows that pass the base rules, five for each entry of the vector, use
the estimate of their language, and if that has fewer too the estimate of all rows, however many those are. Null language or source is a group of its own; null text has no words
and fails; every row is judged, also with a null or repeated id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import U64, Words, blank_table, checkpointed, numbered, pieces, sorted_unique, texts_of, without

CORE = 0.75
#: most concentration steps, and the fall of a logarithm of a determinant that asks for another
STEPS, FALL = 12, 1e-2
STARTS = 2
CUT = 9.0
BIN = 0.02
MIN_WORDS = 50
#: most groups whose estimates (under 500 bytes each) are broadcast, and the tasks a group is split over beyond
BROADCAST_GROUPS, SALTS = 10000, 64
_TABLE = blank_table()
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), range(65, 91))
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: by vector entry: least standard deviation
FLOORS = (0.5, 0.08, 0.35, 0.05, 0.05, 0.04)
SIZE = len(FLOORS)
#: rows that an estimate needs
FEWEST = 5 * SIZE


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier one, and lines with a word."""
    if b"\n" not in text:
        return 0, 1 if text.strip() else 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines)), len(lines)


def text_stats(texts: list[bytes]) -> dict[str, np.ndarray]:
    """STATS of each text."""
    words = Words(texts, _TABLE)
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    begin = words.offsets
    end = begin + np.array([len(t) for t in texts], np.int64)

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[end] - total[begin]

    gram = words.grams(3, words.text)
    inside = np.flatnonzero(words.whole(3))
    gram = gram[inside]
    ordered = np.sort(gram)
    twice = sorted_unique(ordered[1:][ordered[1:] == ordered[:-1]])
    marked = np.zeros(len(words.hash) + 1, np.int64)
    if len(twice):
        at = np.searchsorted(twice, gram)
        at[at == len(twice)] = 0
        first = inside[twice[at] == gram]
        for k in range(3):
            marked[first + k] = 1
    repeated = np.concatenate([[0], np.cumsum(marked)])
    lines = [repeated_lines(t) for t in texts]
    return {"n_words": np.diff(words.bounds), "word_chars": count(~_BLANK[raw] & ((raw & 0xC0) != 0x80)), "n_symbols": count(_SYMBOLS[raw]),
            "n_dup_lines": np.array([d for d, _ in lines], np.int64), "n_repeat_words": repeated[words.bounds[1:]] - repeated[words.bounds[:-1]],
            "n_lines": np.array([n for _, n in lines], np.int64), "n_upper": count(_UPPER[raw])}


def with_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(3))
            got = [text_stats(texts[a:b]) for a, b in pieces(texts)]
            cols = [pa.array(np.concatenate([np.zeros(0, np.int64), *(g[s] for g in got)])) for s in STATS]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *cols], ["doc_id", "lang", "source", *STATS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    return rows.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{s} long" for s in STATS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics of a row."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return [F.log(words), F.log(chars / words), F.log((F.col("n_symbols") + 1.0) / (words + 50.0)),
            F.col("n_dup_lines") / lines, F.col("n_repeat_words") / words, F.col("n_upper") / chars]


def _key(level: str, *columns: str) -> Column:
    """Name of a group; null and any text have different names."""
    return F.concat(F.lit(level), F.to_json(F.struct(*columns)))


def with_group(rows: DataFrame, table: DataFrame, n: int, on: str = "grp", how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group in ``table``, which has ``n`` rows.

    Up to ``BROADCAST_GROUPS`` of them are broadcast and the rows stay where they are.
    More are repeated for every salt, so that the rows of one group go to ``SALTS`` tasks.
    """
    if n <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(table), on, how)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [on, "__salt"], how).drop("__salt")


def grouped(stats: DataFrame) -> tuple[DataFrame, int]:
    """The rows that pass the base rules, and how many languages with sources they have.

    Each row has ``grp``, the group that is large enough for an estimate, and ``feeds``, the groups
    with an estimate in use that it takes part in.
    """
    rows = stats.where(~base_failed()).withColumns({f"x{i}": x for i, x in enumerate(vector())})
    rows = rows.withColumn("pair", _key("s", "lang", "source"))
    sizes = rows.groupBy("pair").agg(F.first("lang").alias("lang"), F.count(F.lit(1)).alias("n"))
    of_lang, everything = Window.partitionBy("lang"), Window.partitionBy()
    own, lang, all_rows = F.col("pair"), _key("l", "lang"), F.lit("all")
    group = F.when(F.col("n") >= FEWEST, own).when(F.sum("n").over(of_lang) >= FEWEST, lang).otherwise(all_rows)
    names = sizes.withColumn("grp", group)
    feeds = [F.when(F.col("grp") == own, own), F.when(F.max(F.col("grp") == lang).over(of_lang), lang),
             F.when(F.max(F.col("grp") == all_rows).over(everything), all_rows)]
    names = checkpointed(names.select("pair", "grp", F.array_compact(F.array(*feeds)).alias("feeds")))
    n = names.count()
    return with_group(rows, names, n, "pair").drop("pair"), n


def _members(rows: DataFrame) -> DataFrame:
    """Each row in every group that estimates from it, once for each start; ``grp`` is the start's digit and the group."""
    names = F.flatten(F.transform("feeds", lambda g: F.array(*[F.concat(F.lit(str(k)), g) for k in range(STARTS)])))
    return rows.select(F.explode(names).alias("grp"), *(f"x{i}" for i in range(SIZE)))


def normal_quantile(z: float, k: int = SIZE) -> float:
    """Of the chi-square distribution with k degrees, at z standard deviations."""
    return k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3


def _estimates(moments: pd.DataFrame) -> pd.DataFrame:
    """Centre and inverse spread of each group from its sums."""
    out = []
    for row in moments.itertuples(index=False):
        n = row.n
        mean = np.array([getattr(row, f"s{i}") for i in range(SIZE)]) / n
        spread = np.array([[getattr(row, f"p{min(i, j)}_{max(i, j)}") for j in range(SIZE)] for i in range(SIZE)]) / n - np.outer(mean, mean)
        own = np.sqrt(np.maximum(np.diag(spread), 1e-12))
        wide = np.maximum(own, np.array(FLOORS))
        # the floor widens a variance and leaves the correlations
        spread = spread / np.outer(own, own) * 0.95 * np.outer(wide, wide)
        spread[np.diag_indices(SIZE)] = wide**2
        out.append((row.grp, mean.tolist(), np.linalg.inv(spread).ravel().tolist(), float(np.linalg.slogdet(spread)[1])))
    return pd.DataFrame(out, columns=["grp", "mean", "inv", "logdet"])


def _distance() -> Column:
    diff = [F.col(f"x{i}") - F.col("mean")[i] for i in range(SIZE)]
    return sum((diff[i] * diff[j] * F.col("inv")[i * SIZE + j] * (1 if i == j else 2) for i in range(SIZE) for j in range(i, SIZE)), F.lit(0.0))


def _moments(rows: DataFrame) -> DataFrame:
    sums = [F.count(F.lit(1)).alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(SIZE)),
            *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i in range(SIZE) for j in range(i, SIZE))]
    estimate = lambda batches: map(_estimates, batches)
    return rows.groupBy("grp").agg(*sums).mapInPandas(estimate, "grp string, mean array<double>, inv array<double>, logdet double")


def _bins(rows: DataFrame, share: float) -> DataFrame:
    """(grp, bin): the bin of the logarithm of the distance below which that share of a group's rows lies."""
    counts = rows.groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp")
    below = F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = counts.withColumns({"below": below, "all": F.sum("n").over(whole)}).where(F.col("below") >= share * F.col("all"))
    return at.groupBy("grp").agg(F.min("bin").alias("cut"))


def estimates(rows: DataFrame, n: int) -> DataFrame:
    """(grp, mean, inv, logdet, scale) of every group; ``n`` is that of ``grouped``."""
    # no more groups have rows than languages with sources, those languages and all
    n = STARTS * (2 * n + 1)
    members = checkpointed(_members(rows))
    first, second = members.where("grp LIKE '0%'"), members.where("grp LIKE '1%'")
    middle = first.groupBy("grp").agg(*(F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(SIZE)))
    start = np.diag(1 / np.array(FLOORS) ** 2).ravel().tolist()
    now = middle.select("grp", F.array(*(f"m{i}" for i in range(SIZE))).alias("mean"), F.array(*map(F.lit, start)).alias("inv"))
    now = checkpointed(now.unionByName(_moments(second).drop("logdet")))
    steps: list[DataFrame] = []
    for _ in range(STEPS):
        placed = with_group(members, now, n).withColumn("bin", F.floor(F.log(_distance() + 1e-6) / BIN))
        cuts = checkpointed(_bins(placed.select("grp", "bin"), CORE))
        core = with_group(placed.select("grp", "bin", *(f"x{i}" for i in range(SIZE))), cuts, n).where("bin <= cut")
        now = checkpointed(_moments(core.select("grp", *(f"x{i}" for i in range(SIZE)))))
        steps.append(now)
        if len(steps) > 1:
            fall = steps[-2].select("grp", F.col("logdet").alias("was")).join(now, "grp").agg(F.max(F.col("was") - F.col("logdet"))).first()[0]
            if fall is None or fall <= FALL:
                break
    every = steps[0]
    for step in steps[1:]:
        every = every.unionByName(step)
    # a row for each step and start
    least = F.min_by(F.struct("mean", "inv", "logdet"), F.struct("logdet", "grp"))
    best = checkpointed(every.groupBy(F.expr("substring(grp, 2)").alias("__grp")).agg(least.alias("e")).select(F.col("__grp").alias("grp"), "e.*"))
    own = first.withColumn("grp", F.expr("substring(grp, 2)"))
    placed = with_group(own, best, n).select("grp", F.floor(F.log(_distance() + 1e-6) / BIN).alias("bin"))
    half = _bins(placed, 0.5).select("grp", (F.exp((F.col("cut") + 1) * BIN) / normal_quantile(0.0)).alias("scale"))
    # a floor on the spread leaves distances smaller than a normal sample's: never scale them up
    return best.join(half, "grp").withColumn("scale", F.greatest("scale", F.lit(1.0)))


def judge(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    stats = checkpointed(with_stats(docs))
    rows, n = grouped(stats)
    rows = checkpointed(rows)
    found = checkpointed(estimates(rows, n))
    passed = with_group(rows, found.drop("logdet"), 2 * n + 1, how="left").withColumn("distance", _distance() / F.col("scale"))
    passed = passed.withColumn("kept", F.coalesce(F.col("distance") <= normal_quantile(CUT), F.lit(True)))
    shown = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = stats.where(base_failed()).select(*shown, F.lit(True).alias("base_failed"), F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return passed.select(*shown, F.lit(False).alias("base_failed"), "kept", "distance").unionByName(failed)


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, each decided by itself, also with a null or repeated id."""
    rows = numbered(docs)
    judged = judge(rows.withColumn("doc_id", F.col("__n")))
    return without(rows, judged.where(~F.col("kept")).select(F.col("doc_id").alias("__n")))
