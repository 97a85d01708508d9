"""The corpus pipeline: rules, near copies, repeated passages, benchmark passages, mix.

``STAGES`` are applied in order. Each takes the rows that its predecessor
kept, reread from Parquet in the shared folder; all but the last return the
columns of ``documents``. Every row is decided by itself, also with a null or repeated id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, golay_simhash, mixing, quality_rules, substring_dedup
from tidemark.llm.common import small_batches
from tidemark.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    small_batches(spark)
    return quality_rules.drop_rejected(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return golay_simhash.keep_one_of_each(docs, words_per_shingle=3, max_bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start in a document with a smaller id go from the text; a document of nothing else goes.

    A character that a cut split is left out. ``n_chars`` is that of the remaining text.
    """
    small_batches(spark)
    done = substring_dedup.remove_repeats(docs, docs.columns, text_column=True)
    left = done.where("n_removed = 0 OR n_removed < n_bytes")
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(F.col("n_chars"))
    return left.withColumns(changed).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside a benchmark window go."""
    small_batches(spark)
    return decontaminate.drop_contaminated_rows(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: one row for each document with its target and the words taken."""
    small_batches(spark)
    return mixing.mix_documents(docs)


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_copies), ("suffix-array dedup", repeated_passages),
          ("benchmark decontamination", benchmark_passages), ("mixing to target weights", mixed)]

#: no SQL: quality rules and SimHash cannot be written in it
ORACLE_SQL = None


def discard(spark: SparkSession, folder: str) -> None:
    """Removes a finished stage's rows from the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again.

    A stage's rows are removed when those of the next one are written; the last one's stay.
    """
    place = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
        if number:
            discard(spark, f"{place}/{number - 1}")
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
