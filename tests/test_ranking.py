"""Global ranks of rows that carry more than the sort columns."""

from pyspark.sql import functions as F

from tidemark.operators import global_rank


def test_ranks_with_payload_are_a_numbering(spark):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(F.xxhash64("id").alias("k"), F.concat(F.lit("payload "), F.col("id")).alias("payload"))
    got = global_rank(df, [F.asc("k"), F.asc("payload")], partitions=8)
    assert got.columns == ["k", "payload", "rank"]
    row = got.agg(F.countDistinct("rank").alias("d"), F.min("rank").alias("lo"), F.max("rank").alias("hi")).first()
    assert tuple(row) == (n, 1, n)
    inside = got.select("rank", "k", F.floor(F.col("rank") / 1000).alias("g")).groupBy("g").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("g").collect()
    assert all(a.hi <= b.lo for a, b in zip(inside, inside[1:]))


def test_a_second_file_of_a_date_adds_to_it(spark, tmpdir_path):
    from tidemark.sources.sinks import existing_keys, write_partitioned
    assert existing_keys(spark, f"{tmpdir_path}/none", ["day"]) is None
    rows = spark.createDataFrame([("2025-01-01", 1), ("2025-01-01", 2), ("2025-01-02", 3)], "day string, v int")
    write_partitioned(rows, f"{tmpdir_path}/t", ["day"])
    assert existing_keys(spark, f"{tmpdir_path}/t", ["day"]).count() == 2
    assert spark.read.parquet(f"{tmpdir_path}/t").count() == 3
