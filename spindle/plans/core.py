"""Queries: sources, projections, filters, scalar functions, bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (ampm_text_from_ts, ampm_time_bin, click_hour_bin, format_us_date,
                         hour_from_log_line, parse_us_date)
from ..operators.clean import drop_header_lines, equals_typed, year_open_range
from ..operators.split import key_hash_bucket
from ..session import scratch_path
from ..sinks.writers import write_text
from ..sources.readers import (read_csv, read_lines, read_table, read_whole_texts, run_sql,
                               stack_batches)
from .registry import query

_HOUR_BIN_SQL = """
    CASE WHEN h >= 0 AND h < 6 THEN '0-6'
         WHEN h >= 6 AND h < 12 THEN '6-12'
         WHEN h >= 12 AND h < 18 THEN '12-18'
         ELSE '18-24' END"""


@query("hour_bin_counts", "SCL-04 AGG-04 UDF-06", f"""
SELECT {_HOUR_BIN_SQL} AS hour_bin, count(*) AS n_clicks
FROM (SELECT hour(ts) AS h FROM events) t
GROUP BY 1
""")
def hour_bin_counts(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return (ev.select(click_hour_bin(F.hour("ts")).alias("hour_bin"))
            .groupBy("hour_bin").agg(F.count(F.lit(1)).alias("n_clicks")))


CLICK_LOG_HEADER = "date time user_id event_type"


@query("click_log_bins", "SRC-03 FLT-04 SCL-05 SCL-04 AGG-04 SNK-01 SNK-02", f"""
SELECT {_HOUR_BIN_SQL} AS hour_bin, count(*) AS n_clicks
FROM (SELECT hour(ts) AS h FROM events) t
GROUP BY 1
""")
def click_log_bins(spark, sf_dir):
    """The click-log job end to end: events are written as a text log with a
    header line (sharded text sink), read back as lines, the header lines are
    removed, the hour is parsed from the text and binned, the four counts are
    written as one small text file and returned."""
    ev = read_table(spark, sf_dir, "events")
    log_dir = scratch_path(spark, "click-log")
    lines = ev.select(F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"),
                                  F.col("user_id").cast("string"), "event_type").alias("value"))
    header = spark.range(1).select(F.lit(CLICK_LOG_HEADER).alias("value"))
    write_text(header.unionByName(lines), log_dir, col="value")
    # the header is taken from the log itself: the first line of its first file
    text = drop_header_lines(read_lines(spark, log_dir, line_sep="\n"), folder=log_dir)
    counts = (text.select(click_hour_bin(hour_from_log_line("value")).alias("hour_bin"))
              .groupBy("hour_bin").agg(F.count(F.lit(1)).alias("n_clicks")))
    out_dir = scratch_path(spark, "click-bins")
    write_text(counts, out_dir, single_file=True)
    return spark.read.schema("hour_bin string, n_clicks long").csv(out_dir)


@query("ampm_bin_counts", "SCL-03 SCL-06 UDF-01", """
SELECT CAST(CASE
  WHEN hr IN ('00','01','02','03','12') AND p = 'A' THEN 1
  WHEN hr IN ('04','05','06','07') AND p = 'A' THEN 2
  WHEN hr IN ('08','09','10','11') AND p = 'A' THEN 3
  WHEN hr IN ('12','00','01','02','03') AND p = 'P' THEN 4
  WHEN hr IN ('04','05','06','07') AND p = 'P' THEN 5
  WHEN hr IN ('08','09','10','11') AND p = 'P' THEN 6
  ELSE 3 END AS BIGINT) AS time_bin,
  count(*) AS n
FROM (SELECT substr(vt, 1, 2) AS hr, upper(right(vt, 1)) AS p
      FROM (SELECT strftime(ts, '%I%M') || left(strftime(ts, '%p'), 1) AS vt FROM events) a) b
GROUP BY 1
""")
def ampm_bin_counts(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return (ev.select(ampm_time_bin(ampm_text_from_ts("ts")).cast("bigint").alias("time_bin"))
            .groupBy("time_bin").agg(F.count(F.lit(1)).alias("n")))


@query("date_parts", "SCL-01 SCL-02 UDF-02 PRJ-05 PRJ-06", """
SELECT o_orderkey,
       strftime(o_orderdate, '%m/%d/%Y') AS issue_date,
       CAST(dayofweek(d) + 1 AS BIGINT) AS issue_day,
       CAST(month(d) AS BIGINT) AS issue_month,
       CAST(year(d) AS BIGINT) AS issue_year,
       (d = d2) AS same_parse
FROM (SELECT o_orderkey, o_orderdate,
             CAST(try_strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') AS DATE) AS d,
             CAST(try_strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS DATE) AS d2
      FROM orders) t
""")
def date_parts(spark, sf_dir):
    """Dates rendered as ``M/d/yyyy`` text (one-digit parts) and as
    ``MM/dd/yyyy`` are parsed back; day of week, month and year derived."""
    o = read_table(spark, sf_dir, "orders")
    df = o.select("o_orderkey", format_us_date("o_orderdate").alias("issue_date"),
                  F.date_format("o_orderdate", "M/d/yyyy").alias("short_text"))
    d = parse_us_date("short_text")
    d2 = parse_us_date("issue_date")
    return df.select("o_orderkey", "issue_date",
                     F.dayofweek(d).cast("bigint").alias("issue_day"),
                     F.month(d).cast("bigint").alias("issue_month"),
                     F.year(d).cast("bigint").alias("issue_year"),
                     (d == d2).alias("same_parse"))


@query("year_filter", "FLT-02", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS issue_year
FROM orders
WHERE year(o_orderdate) > 1996 AND year(o_orderdate) < 2000
""")
def year_filter(spark, sf_dir):
    """The open year range as a pushed-down range on the typed date (text
    dates, as in the original data, go through ``open_range`` on the parsed
    year instead; see ``clean``)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.where(year_open_range("o_orderdate", 1996, 2000))
            .select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("issue_year")))


@query("like_filter_count", "SRC-06 SRC-07 FLT-03 AGG-01", """
SELECT count(*) AS n FROM part
WHERE p_type LIKE 'ECONOMY' AND p_size > 3 AND p_retailprice < 1000
""")
def like_filter_count(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return run_sql(spark, """
        SELECT count(*) AS n FROM part_v
        WHERE p_type LIKE 'ECONOMY' AND p_size > 3 AND p_retailprice < 1000""", part_v=part)


@query("typed_key_lookup", "FLT-01 PRJ-01", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)
""")
def typed_key_lookup(spark, sf_dir):
    """A numeric key compared with a text literal (cast to the key's type).
    The literal is the largest key, read from the table itself."""
    o = read_table(spark, sf_dir, "orders")
    key_text = str(o.agg(F.max("o_orderkey")).first()[0])
    return (o.where(equals_typed(o, "o_orderkey", key_text))
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


_ORDERS_CSV_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, "
                      "o_totalprice double, o_orderdate string, o_orderpriority string")


@query("csv_roundtrip", "SRC-02 SNK-02 PRJ-04", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
       strftime(o_orderdate, '%m/%d/%Y') AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_roundtrip(spark, sf_dir):
    """Orders written as CSV with a header and read back with a declared
    schema (the production path; no inference scan)."""
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    (o.withColumn("o_orderdate", format_us_date("o_orderdate"))
     .write.mode("overwrite").option("header", True).csv(path))
    back = read_csv(spark, path, schema=_ORDERS_CSV_SCHEMA)
    return back.withColumn("o_totalprice", F.round(F.col("o_totalprice").try_cast("double"), 6))


@query("stack_batches", "SRC-11 SET-01", """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 6) AS qty
FROM lineitem GROUP BY 1
""")
def stack_batches_query(spark, sf_dir):
    """Lineitem is written as ``n`` batch folders in one distributed write
    (batch = key hash mod n), then the folders are read as separate inputs
    and stacked by column name."""
    n = 3
    li = read_table(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "batches")
    (li.select("l_returnflag", "l_quantity",
               (key_hash_bucket(F.concat_ws("|", "l_orderkey", "l_linenumber")) % n).alias("batch"))
     .write.mode("overwrite").partitionBy("batch").parquet(root))
    stacked = stack_batches([spark.read.parquet(f"{root}/batch={i}") for i in range(n)])
    return stacked.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                               F.round(F.sum("l_quantity"), 6).alias("qty"))


@query("csv_inferred", "SRC-01 SNK-02", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
       strftime(o_orderdate, '%m/%d/%Y') AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_inferred(spark, sf_dir):
    """Orders as CSV, read back with header + type inference (an extra scan
    of the input; the date text stays a string)."""
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv-infer")
    (o.withColumn("o_orderdate", format_us_date("o_orderdate"))
     .write.mode("overwrite").option("header", True).csv(path))
    back = read_csv(spark, path, infer=True)
    return back.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"),
                       "o_orderstatus", F.round(F.col("o_totalprice").cast("double"), 6).alias("o_totalprice"),
                       F.col("o_orderdate").cast("string"), "o_orderpriority")


@query("whole_text_newlines", "SRC-04 SCL-09", """
SELECT source, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_newlines
FROM documents GROUP BY source
""")
def whole_text_newlines(spark, sf_dir):
    """Documents land as text files (one folder per source); every file is
    read whole as one string and its newlines counted; totals per source."""
    docs = read_table(spark, sf_dir, "documents").select("source", "text")
    root = scratch_path(spark, "whole-texts")
    # a file is one string when read, so each holds a bounded number of documents
    docs.write.mode("overwrite").option("maxRecordsPerFile", 1000).partitionBy("source").text(root)
    whole = read_whole_texts(spark, root)
    nl = F.length("value") - F.length(F.replace(F.col("value"), F.lit("\n"), F.lit("")))
    return (whole.select(F.regexp_extract("path", "source=([^/]+)", 1).alias("source"), nl.alias("nl"))
            .groupBy("source").agg(F.sum("nl").cast("bigint").alias("n_newlines")))


@query("preview_ordered", "ORD-03 SNK-08 PRJ-01", """
SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 25
""")
def preview_ordered(spark, sf_dir):
    """A deterministic ``show(25)``: total order, then the limit (planned as
    TakeOrderedAndProject: each task keeps its own 25, no global sort)."""
    from ..operators.profile import preview
    return preview(read_table(spark, sf_dir, "embeddings").select("vec_id", "label"), ["vec_id"], 25)
