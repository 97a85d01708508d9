"""Sources and sinks round trips on the driver tables.

Files are staged under the session's shared ``spark.checkpoint.dir`` (a
fresh folder per call).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.cot import cot_filter
from ..plans.summaries import observations
from ..session import checkpoint_dir
from ..sources.checked import Checked, check_auctions, check_bls_series, check_fred_csv, check_release_dates
from ..sources.readers import file_date, read_bls_series, read_cot_text, read_csv_typed, read_sec_tsv
from ..sources.sinks import write_partitioned, write_text_rows
from .base import Tables


def _stage(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"


def q_write_read(spark, sf):
    """Partitioned zstd write, one partition overwritten with fewer rows, read back."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus",
                        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
    out = _stage(spark)
    write_partitioned(o, out, ["month"], [F.col("o_orderkey")])
    # dynamic overwrite replaces only partitions present in the new data (an
    # empty key keeps its old files), so the rewritten month keeps some rows
    first = o.select(F.min("month")).scalar()
    write_partitioned(o.where((F.col("month") == first) & (F.col("o_orderstatus") == "F")), out, ["month"])
    back = spark.read.parquet(out)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


SQL_WRITE_READ = """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice, o_orderstatus FROM orders),
m AS (SELECT min(month) AS first FROM o)
SELECT month, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM o, m
WHERE month > m.first OR o_orderstatus = 'F' GROUP BY month
"""


def q_text_roundtrip(spark, sf):
    """Orders written as gz CSV (one folder per month, date in the path) and as a
    tab-separated member file, then read back with forced types and file dates."""
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").cast("string").alias("key"),
                        F.col("o_totalprice").cast("string").alias("price"),
                        F.col("o_orderpriority").alias("prio"),
                        F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "MM"), "yyyy-MM-dd").alias("day"))
    base = _stage(spark)
    csv_dir = os.path.join(base, "csv")
    (o.hint("rebalance", "day").write.partitionBy("day").option("header", True)
       .option("compression", "gzip").csv(csv_dir))
    bars = read_csv_typed(spark, os.path.join(csv_dir, "day=*", "*.csv.gz"), "key long, price double, prio string")
    bars = bars.withColumn("date", file_date(r"day=(\d{4}-\d{2}-\d{2})"))
    tsv_dir = os.path.join(base, "tsv")
    o.select("key", "prio").write.option("sep", "\t").option("header", True).option("quote", "").csv(tsv_dir)
    tsv = read_sec_tsv(spark, tsv_dir, ["KEY", "PRIO"])
    cot_dir = os.path.join(base, "cot")
    write_text_rows(o.select("prio", "key"), cot_dir)
    urgent = cot_filter(read_cot_text(spark, cot_dir), ["URGENT"], ["NOT"])
    j = (bars.join(tsv.select(F.col("KEY").cast("long").alias("key"), F.col("PRIO").alias("tprio")), "key")
             .join(urgent.select(F.col("key").cast("long").alias("key"), F.lit(True).alias("urgent")), "key", "left"))
    return j.groupBy(F.trunc("date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("total"),
        F.count("urgent").alias("n_urgent"), F.count(F.when(F.col("tprio") == F.col("prio"), 1)).alias("n_same"))


SQL_TEXT_ROUNDTRIP = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent, count(*) AS n_same
FROM orders GROUP BY 1
"""


def q_landed_observations(spark, sf):
    """Monthly revenue landed as series payloads, read back and joined by daily event maxima.

    Every payload is landed twice, one priority's payload failed, and each has a
    yearly period and a value that is no number.
    """
    t = Tables(spark, sf)
    day = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    monthly = (t.orders.groupBy(F.col("o_orderpriority").alias("seriesID"), day.alias("d"))
                .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).cast("string").alias("value")))
    point = F.struct(F.date_format("d", "yyyy").alias("year"), F.date_format("d", "'M'MM").alias("period"), "value")
    noise = [F.struct(F.lit("1997").alias("year"), F.lit(p).alias("period"), F.lit(v).alias("value"))
             for p, v in (("M13", "1"), ("Q01", "2"), ("M01", "-"))]
    # one point for each month of a series
    data = F.concat(F.array_sort(F.collect_list(point)), F.array(*noise))
    series = monthly.groupBy("seriesID").agg(data.alias("data"))
    status = F.when(F.col("seriesID") == "5-LOW", "REQUEST_NOT_PROCESSED").otherwise("REQUEST_SUCCEEDED")
    payload = series.select(status.alias("status"), F.struct(F.array(F.struct("seriesID", "data")).alias("series")).alias("Results"))
    landed = _stage(spark)
    payload.union(payload).write.json(landed)
    daily = (t.events.groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("d"))
              .agg(F.max("value").alias("value")))
    return observations(read_bls_series(spark, landed), daily)


SQL_LANDED_OBSERVATIONS = """
SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS d,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS value
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2
UNION ALL SELECT event_type, CAST(ts AS DATE), max(value) FROM events GROUP BY 1, 2
"""


def _by_reason(source: str, check: Checked, place: str, total) -> DataFrame:
    """Rows by reason, ``ok`` for the usable ones: their number, a total of those, and the characters of the raw text of the others."""
    check = check.written(place)
    good = check.good.agg(F.lit("ok").alias("reason"), F.count(F.lit(1)).alias("n"), total.cast("double").alias("total"), F.lit(0).cast("long").alias("chars"))
    bad = check.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.lit(0.0).alias("total"), F.sum(F.length("raw")).alias("chars"))
    return good.unionByName(bad).select(F.lit(source).alias("source"), "*", F.lit(check.counts["good"] + check.counts["rejected"]).cast("long").alias("n_all"))


def q_payload_checks(spark, sf):
    """Landed payloads of four shapes, some of each malformed: every one is either read or listed with its reason."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.round("o_totalprice").cast("long").alias("price"), "o_orderpriority")
    base = _stage(spark)

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def auction(day, key):
        return text('{"type":"Note","originalSecurityTerm":"2-Year","auctionDate":"', day, '","cusip":"', key, '","offeringAmount":"', F.col("price"), '"}')

    second = auction(F.when(F.col("o_orderkey") % 5 == 0, F.lit("soon")).otherwise(F.col("day").cast("string")), text(F.col("o_orderkey"), "x"))
    line = text("[", auction(F.col("day"), F.col("o_orderkey")), ",", second, "]")
    cut = F.when(F.col("o_custkey") % 10 == 7, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    o.withColumn("value", line).select(cut.alias("value")).write.text(f"{base}/auctions")
    auctions = check_auctions(spark, {"announced": f"{base}/auctions"}, payload_lines=True)

    month = F.trunc("day", "MM")
    monthly = o.groupBy("o_orderpriority", month.alias("m")).agg(F.sum("price").alias("price"))
    value = text('{"status":"', F.when(F.col("o_orderpriority") == "5-LOW", "REQUEST_FAILED").otherwise("REQUEST_SUCCEEDED"),
                 '","Results":{"series":[{"seriesID":"', F.col("o_orderpriority"), '","data":[{"year":"', F.year("m"), '","period":"M', F.date_format("m", "MM"),
                 '","value":"', F.col("price"), '"},{"year":"', F.year("m"), '","period":"M13","value":"1"}]}]}}')
    cut = F.when(F.month("m") == 2, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    monthly.withColumn("value", value).select(cut.alias("value")).write.text(f"{base}/series")
    series = check_bls_series(spark, f"{base}/series")

    other = F.when(F.month("m") == 3, F.lit("soon")).otherwise(F.last_day("m").cast("string"))
    dates = text('[{"date":"', F.col("m"), '"},{"date":"', other, '"}]')
    listed = F.when(F.month("m") == 4, F.lit("null")).when(F.month("m") == 5, F.lit("[")).when(F.month("m") == 6, F.lit("[]")).otherwise(dates)
    value = text('{"release":"', F.col("o_orderpriority"), '","year":', F.year("m"), ',"release_dates":', listed, "}")
    monthly.select(value.alias("value")).write.text(f"{base}/dates")
    release = check_release_dates(spark, f"{base}/dates")

    daily = t.events.groupBy(F.col("event_type"), F.col("ts").cast("date").alias("d")).agg(F.max(F.floor("value")).alias("v"))
    number = F.when(F.dayofmonth("d") == 1, F.lit(".")).when(F.dayofmonth("d") == 2, F.lit("n/a")).otherwise(F.col("v").cast("string"))
    rows = daily.select("event_type", F.when(F.dayofmonth("d") == 3, F.lit("someday")).otherwise(F.col("d").cast("string")).alias("observation_date"), number.alias("value"))
    for headed in (True, False):
        kind = F.col("event_type") == "purchase"
        rows.where(~kind if headed else kind).drop("event_type").write.option("header", headed).csv(f"{base}/csv/{headed}")
    csv = check_fred_csv(spark, f"{base}/csv/*")

    out = [_by_reason("auctions", auctions, f"{base}/out/auctions", F.sum(F.col("offeringAmount").cast("long"))),
           _by_reason("series", series, f"{base}/out/series", F.sum("value")),
           _by_reason("dates", release, f"{base}/out/dates", F.count("d")),
           _by_reason("csv", csv, f"{base}/out/csv", F.sum("value"))]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


SQL_PAYLOAD_CHECKS = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice) AS BIGINT) AS price, o_orderpriority AS p FROM orders),
a AS (SELECT *, '{"type":"Note","originalSecurityTerm":"2-Year","auctionDate":"' AS head, '","offeringAmount":"' || price || '"}' AS tail FROM o),
b AS (SELECT *, head || day || '","cusip":"' || o_orderkey || tail AS one,
             head || CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE CAST(day AS VARCHAR) END || '","cusip":"' || o_orderkey || 'x' || tail AS two FROM a),
auctions AS (SELECT CASE WHEN o_custkey % 10 = 7 THEN 'not an array of auctions' ELSE 'ok' END AS reason, price, length(one) + length(two) + 2 AS chars FROM b
  UNION ALL SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'bad auction date' ELSE 'ok' END, price, length(two) FROM b WHERE o_custkey % 10 <> 7),
m AS (SELECT p, CAST(date_trunc('month', day) AS DATE) AS m, sum(price) AS price FROM o GROUP BY 1, 2),
s AS (SELECT *, length('{"status":"","Results":{"series":[{"seriesID":"","data":[{"year":"","period":"M","value":""},{"year":"","period":"M13","value":"1"}]}]}}')
               + length(CASE WHEN p = '5-LOW' THEN 'REQUEST_FAILED' ELSE 'REQUEST_SUCCEEDED' END) + length(p) + 10 + length(CAST(price AS VARCHAR)) AS chars FROM m),
series AS (SELECT CASE WHEN month(m) = 2 THEN 'not JSON' WHEN p = '5-LOW' THEN 'not succeeded' ELSE 'ok' END AS reason, price, chars - CASE WHEN month(m) = 2 THEN 1 ELSE 0 END AS chars FROM s),
r AS (SELECT month(m) AS k, length(p) + length('{"release":"","year":1995,"release_dates":}') AS chars FROM m),
dates AS (SELECT CASE k WHEN 3 THEN 'bad date' WHEN 4 THEN 'no release dates' WHEN 5 THEN 'not JSON' ELSE 'ok' END AS reason, CASE WHEN k = 6 THEN 0 ELSE 1 END AS price,
                 chars + CASE k WHEN 3 THEN length('[{"date":"1995-01-01"},{"date":"soon"}]') WHEN 4 THEN 4 ELSE 1 END AS chars
          FROM r, (SELECT unnest([1, 2]) AS twice) WHERE twice = 1 OR k NOT IN (3, 4, 5, 6)),
e AS (SELECT event_type, CAST(ts AS DATE) AS d, max(CAST(floor(value) AS BIGINT)) AS v FROM events GROUP BY 1, 2),
c AS (SELECT event_type, day(d) AS k, v, CASE WHEN day(d) = 3 THEN 'someday' ELSE CAST(d AS VARCHAR) END || ',' ||
             CASE day(d) WHEN 1 THEN '.' WHEN 2 THEN 'n/a' ELSE CAST(v AS VARCHAR) END AS line FROM e),
csv AS (SELECT CASE WHEN event_type = 'purchase' THEN 'no header' WHEN k = 3 THEN 'bad date' WHEN k = 2 THEN 'bad value' ELSE 'ok' END AS reason, v AS price, length(line) AS chars
        FROM c WHERE event_type = 'purchase' OR k <> 1),
u AS (SELECT 'auctions' AS source, * FROM auctions UNION ALL SELECT 'series', * FROM series UNION ALL SELECT 'dates', * FROM dates UNION ALL SELECT 'csv', * FROM csv)
SELECT source, reason, count(*) AS n, CAST(sum(CASE WHEN reason = 'ok' THEN price ELSE 0 END) AS DOUBLE) AS total,
       CAST(sum(CASE WHEN reason = 'ok' THEN 0 ELSE chars END) AS BIGINT) AS chars, CAST(sum(count(*)) OVER (PARTITION BY source) AS BIGINT) AS n_all
FROM u GROUP BY source, reason
"""


QUERIES = {
    "payload_checks": (q_payload_checks, SQL_PAYLOAD_CHECKS),
    "landed_observations": (q_landed_observations, SQL_LANDED_OBSERVATIONS),
    "write_read": (q_write_read, SQL_WRITE_READ),
    "text_roundtrip": (q_text_roundtrip, SQL_TEXT_ROUNDTRIP),
}
