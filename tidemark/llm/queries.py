"""Driver queries of the training-data operators, on their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, disclosure, golay_simhash, langid, license_scan, mixing, periodic_runs, ppm, quality_model, quality_rules, substring_dedup, token_align
from tidemark.llm.common import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"], s["last"], s["covered"]))
    return license_scan.license_scan(table(spark, sf_dir, "documents")).withColumn("spans", F.concat_ws(",", F.array_sort(told)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.chat_digest(rows.unionByName(extra))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.span_digest(disclosure.personal_data(table(spark, sf_dir, "documents")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment_digest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(periodic_runs.collapse_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bi),
ns AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM di),
m AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

QUERIES = {
    "op1_language_id": (op1_language_id, None),
    "op2_license_scan": (op2_license_scan, None),
    "op3_decontamination": (op3_decontamination, OP3_SQL),
    "op4_chat_format": (op4_chat_format, None),
    "op5_quality_rules": (op5_quality_rules, None),
    "op6_quality_score": (op6_quality_score, None),
    "op7_substring_dedup": (op7_substring_dedup, None),
    "op8_lm_score": (op8_lm_score, None),
    "op9_near_dedup": (op9_near_dedup, None),
    "op10_mix": (op10_mix, None),
    "op11_personal_data": (op11_personal_data, None),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
