"""Ordered string aggregation of referenced names.

A holding line lists other managers as numbers in free text (``"1,5"``);
each number is looked up in a (document, number) table and the names are
joined by ``"; "`` in number order, nulls dropped, empty -> null.

The group is the natural pair (document key, reference text), never a row
id, and its size is the number of digit runs in one text field, so the
collected list is bounded by the length of that field. Where every row is
wanted with its names, the list is that of one document's numbered names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import digit_runs


def _field(name: str):
    def get(x):  # one-argument lambda: transform passes the index to two-argument ones
        return x.getField(name)
    return get


def ordered_concat(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   values: dict[str, str], sep: str = "; ") -> DataFrame:
    """Per ``keys``: for each ``out -> col`` in ``values``, the non-null values
    sorted by ``order_cols`` and joined by ``sep``; null when nothing is left."""
    item = F.struct(*[F.col(c) for c in order_cols], *[F.col(v).alias(o) for o, v in values.items()])
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    outs = [F.nullif(F.concat_ws(sep, F.transform("_items", _field(o))), F.lit("")).alias(o)
            for o in values]
    return g.select(*keys, *outs)


def resolve_references(rows: DataFrame, doc_key: str | Sequence[str], ref_text: str, lookup: DataFrame,
                       lookup_seq: str, values: dict[str, str], sep: str = "; ", each_row: bool = False) -> DataFrame:
    """Distinct (doc_key, ref_text) pairs -> names resolved through ``lookup``.

    ``lookup`` has ``doc_key`` (one column or several), ``lookup_seq`` (bigint) and the value columns.
    Numbers without a lookup row contribute nothing. Returns one row per pair
    that has at least one number, with ``values`` columns (may be null). With ``each_row`` it returns
    all of ``rows`` with these columns: one join by document, where a document's lookup rows
    are one list (as long as the document's own table), in place of joins by number and by text.
    """
    keys = [doc_key] if isinstance(doc_key, str) else [*doc_key]
    if each_row:
        item = F.struct(F.col(lookup_seq).alias("_seq"), *[F.col(v).alias(o) for o, v in values.items()])
        lists = lookup.where(F.col(lookup_seq).isNotNull()).groupBy(*keys).agg(F.collect_list(item).alias("_list"))
        numbers = digit_runs(ref_text).cast("array<bigint>")
        # a number that stands twice gives its names twice
        found = F.flatten(F.transform(numbers, lambda n: F.filter("_list", lambda x: x["_seq"] == n)))
        joined = rows.join(lists, keys, "left").withColumn("_items", F.sort_array(found)).drop("_list")
        outs = {o: F.nullif(F.concat_ws(sep, F.col("_items")[o]), F.lit("")) for o in values}
        return joined.withColumns(outs).drop("_items")
    pairs = rows.select(*keys, ref_text).where(F.col(ref_text).isNotNull()).distinct()
    seqs = (pairs.select(*keys, ref_text, F.explode(digit_runs(ref_text)).alias("_seq_txt"))
                 .withColumn("_seq", F.col("_seq_txt").cast("bigint"))
                 .drop("_seq_txt"))
    lk = lookup.select(*keys, F.col(lookup_seq).alias("_seq"), *values.values())
    joined = seqs.join(lk, [*keys, "_seq"], "left")
    return ordered_concat(joined, [*keys, ref_text], ["_seq"], {o: v for o, v in values.items()}, sep)
