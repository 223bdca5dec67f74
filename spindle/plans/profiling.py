"""Queries: profiling aggregates, dedup, defaults, outliers, splits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.clean import dedup, drop_null_heavy, fill_defaults, iqr_filter
from ..operators.profile import (boxplot_stats, duplicate_keys, frequency, frequency_many,
                                 histogram, histogram_by, null_nan_counts, quartiles, row_count, summary,
                                 top_k_per_group)
from ..operators.split import split_label
from ..sources.readers import load_table, read_table
from .registry import query

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


@query("row_count", "AGG-01 AGG-05 SRC-05", "SELECT count(*) AS n_rows FROM lineitem")
def row_count_q(spark, sf_dir):
    """The table by path through the format-agnostic loader."""
    import os
    return row_count(load_table(spark, os.path.join(sf_dir, "lineitem.parquet"), fmt="parquet"))


@query("freq_topn", "AGG-02 ORD-01 ORD-02 SNK-08", """
SELECT o_orderpriority, count(*) AS "count" FROM orders
GROUP BY 1 ORDER BY "count" DESC, o_orderpriority ASC NULLS FIRST LIMIT 10
""")
def freq_topn(spark, sf_dir):
    return frequency(read_table(spark, sf_dir, "orders"), "o_orderpriority", n=10)


@query("freq_many", "AGG-03", """
SELECT 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS "count" FROM lineitem GROUP BY 2
UNION ALL
SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY 2
""")
def freq_many(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return (frequency_many(li, ["l_returnflag", "l_linestatus", "l_linenumber"])
            .withColumnRenamed("column", "column_name"))


@query("dup_keys", "AGG-13", """
SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""")
def dup_keys(spark, sf_dir):
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_LI_COLS = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, l_linestatus, l_shipdate")
_LI_ORDER = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in _LI_COLS.split(","))


@query("dedup_first", "DED-01", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount,
       round(l_tax, 6) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ORDER}) AS rn
      FROM lineitem) t
WHERE rn = 1
""")
def dedup_first(spark, sf_dir):
    # the per-key sort is the heavy part: spread an under-partitioned input
    # first (measured 3.75 -> 3.09 s at sf0.1; a no-op on large inputs)
    li = read_table(spark, sf_dir, "lineitem", spread_input=True)
    li = li.select("l_orderkey", "l_linenumber", *[c.strip() for c in _LI_COLS.split(",")])
    out = dedup(li, ["l_orderkey", "l_linenumber"], deterministic=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      *[_r6(c) for c in LI_NUM], "l_returnflag", "l_linestatus",
                      F.col("l_shipdate").cast("string").alias("l_shipdate"))


def _customer_with_gaps(spark, sf_dir):
    """Customer with missing values made from its own data: no segment for
    HOUSEHOLD, no nation for nation 0, NaN for a negative balance."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_name",
        F.when(F.col("c_nationkey") != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("c_mktsegment"))


_CUST_GAPS_SQL = """
(SELECT c_custkey, c_name, nullif(c_nationkey, 0) AS c_nationkey,
        CASE WHEN c_acctbal < 0 THEN 'NaN'::DOUBLE ELSE c_acctbal END AS c_acctbal,
        nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment FROM customer)"""


@query("null_profile", "AGG-07", f"""
WITH c AS {_CUST_GAPS_SQL}
SELECT 'c_custkey' AS column_name, CAST(0 AS BIGINT) AS n_nan, count(*) FILTER (WHERE c_custkey IS NULL) AS n_null FROM c
UNION ALL SELECT 'c_name', 0, count(*) FILTER (WHERE c_name IS NULL) FROM c
UNION ALL SELECT 'c_nationkey', 0, count(*) FILTER (WHERE c_nationkey IS NULL) FROM c
UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE isnan(c_acctbal)), count(*) FILTER (WHERE c_acctbal IS NULL) FROM c
UNION ALL SELECT 'c_mktsegment', 0, count(*) FILTER (WHERE c_mktsegment IS NULL) FROM c
""")
def null_profile(spark, sf_dir):
    return null_nan_counts(_customer_with_gaps(spark, sf_dir)).withColumnRenamed("column", "column_name")


@query("fill_defaults", "NUL-01", f"""
WITH c AS {_CUST_GAPS_SQL}
SELECT c_custkey, c_name, coalesce(c_nationkey, 99) AS c_nationkey,
       round(CASE WHEN c_acctbal IS NULL OR isnan(c_acctbal) THEN 0.0 ELSE c_acctbal END, 6) AS c_acctbal,
       coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment
FROM c
""")
def fill_defaults_q(spark, sf_dir):
    c = fill_defaults(_customer_with_gaps(spark, sf_dir),
                      {"c_nationkey": 99, "c_acctbal": 0.0, "c_mktsegment": "UNKNOWN",
                       "not_a_column": 1})
    return c.withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("drop_null_heavy", "NUL-02 PRJ-08", f"""
WITH c AS {_CUST_GAPS_SQL}
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal FROM c
""")
def drop_null_heavy_q(spark, sf_dir):
    """Columns with more than 10% nulls are dropped (here: the segment with
    one of five values blanked); the null share comes from one aggregate."""
    c = drop_null_heavy(_customer_with_gaps(spark, sf_dir), 0.10)
    return c.withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("summary", "AGG-09", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS \"min\", round(max({c}), 6) AS \"max\" "
    f"FROM lineitem" for c in LI_NUM))
def summary_q(spark, sf_dir):
    s = summary(read_table(spark, sf_dir, "lineitem"), LI_NUM)
    return s.select(F.col("column").alias("column_name"), "count",
                    *[_r6(c) for c in ["mean", "stddev", "min", "max"]])


_HIST_COLS = ["l_quantity", "l_discount", "l_extendedprice"]


@query("histogram10", "AGG-08", """
WITH long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM lineitem" for c in _HIST_COLS) + """),
v AS (SELECT * FROM long WHERE x IS NOT NULL AND NOT isnan(x)),
rng AS (SELECT column_name,
               CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
        FROM v GROUP BY 1),
cnt AS (SELECT v.column_name, CAST(least(floor((x - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin,
               count(*) AS n
        FROM v JOIN rng USING (column_name) GROUP BY 1, 2),
grid AS (SELECT column_name, lo, hi, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM rng)
SELECT g.column_name, g.bin,
       round(lo + g.bin * ((hi - lo) / 10), 6) AS bin_lo,
       round(CASE WHEN g.bin = 9 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / 10) END, 6) AS bin_hi,
       coalesce(n, 0) AS "count"
FROM grid g LEFT JOIN cnt c ON g.column_name = c.column_name AND g.bin = c.bin
""")
def histogram10(spark, sf_dir):
    h = histogram(read_table(spark, sf_dir, "lineitem"), _HIST_COLS, bins=10)
    return h.select(F.col("column").alias("column_name"), "bin", _r6("bin_lo"), _r6("bin_hi"), "count")


@query("histogram_by_group", "AGG-08", """
WITH long AS (""" + " UNION ALL ".join(
    f"SELECT l_returnflag AS category, '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM lineitem" for c in _HIST_COLS) + """),
v AS (SELECT * FROM long WHERE x IS NOT NULL AND NOT isnan(x)),
rng AS (SELECT column_name,
               CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
        FROM v GROUP BY 1),
cnt AS (SELECT category, column_name, CAST(least(floor((x - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin,
               count(*) AS n
        FROM v JOIN rng USING (column_name) GROUP BY 1, 2, 3),
grid AS (SELECT category, column_name, lo, hi, CAST(unnest(range(0, 10)) AS INTEGER) AS bin
         FROM (SELECT DISTINCT category, column_name FROM v) JOIN rng USING (column_name))
SELECT g.category, g.column_name, g.bin,
       round(lo + g.bin * ((hi - lo) / 10), 6) AS bin_lo,
       round(CASE WHEN g.bin = 9 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / 10) END, 6) AS bin_hi,
       coalesce(n, 0) AS "count"
FROM grid g LEFT JOIN cnt c ON g.category IS NOT DISTINCT FROM c.category AND g.column_name = c.column_name AND g.bin = c.bin
""")
def histogram_by_group(spark, sf_dir):
    """Histograms per return flag over common edges."""
    h = histogram_by(read_table(spark, sf_dir, "lineitem"), "l_returnflag", _HIST_COLS, bins=10)
    return h.select(F.col("group").alias("category"), F.col("column").alias("column_name"), "bin", _r6("bin_lo"), _r6("bin_hi"), "count")


_Q_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, "
    f"quantile_cont({c}, 0.75) AS q3 FROM lineitem" for c in LI_NUM)


@query("quartiles", "AGG-11", f"""
SELECT column_name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3
FROM ({_Q_SQL}) q
""")
def quartiles_q(spark, sf_dir):
    q = quartiles(read_table(spark, sf_dir, "lineitem"), LI_NUM)
    return q.select(F.col("column").alias("column_name"), _r6("q1"), _r6("median"), _r6("q3"))


_BOX_VALUES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM lineitem" for c in LI_NUM)


@query("boxplot", "AGG-12", f"""
WITH q AS ({_Q_SQL}),
f AS (SELECT column_name, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
v AS ({_BOX_VALUES})
SELECT f.column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lo, 6) AS fence_lo,
       round(hi, 6) AS fence_hi,
       round(min(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS whisker_lo,
       round(max(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS whisker_hi,
       count(*) FILTER (WHERE x < lo OR x > hi) AS n_outliers
FROM v JOIN f USING (column_name)
GROUP BY f.column_name, q1, q3, lo, hi
""")
def boxplot_q(spark, sf_dir):
    b = boxplot_stats(read_table(spark, sf_dir, "lineitem"), LI_NUM)
    return b.select(F.col("column").alias("column_name"),
                    *[_r6(c) for c in ["q1", "q3", "fence_lo", "fence_hi", "whisker_lo", "whisker_hi"]],
                    "n_outliers")


@query("iqr_filter", "FLT-05", f"""
WITH q AS ({_Q_SQL}),
f AS (SELECT column_name, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
b AS (SELECT max(CASE WHEN column_name = 'l_quantity' THEN lo END) AS lo0,
             max(CASE WHEN column_name = 'l_quantity' THEN hi END) AS hi0,
             max(CASE WHEN column_name = 'l_extendedprice' THEN lo END) AS lo1,
             max(CASE WHEN column_name = 'l_extendedprice' THEN hi END) AS hi1,
             max(CASE WHEN column_name = 'l_discount' THEN lo END) AS lo2,
             max(CASE WHEN column_name = 'l_discount' THEN hi END) AS hi2,
             max(CASE WHEN column_name = 'l_tax' THEN lo END) AS lo3,
             max(CASE WHEN column_name = 'l_tax' THEN hi END) AS hi3 FROM f)
SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity, 6) AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount,
       round(l_tax, 6) AS l_tax
FROM lineitem, b
WHERE NOT (coalesce(l_quantity < lo0 OR l_quantity > hi0, false)
        OR coalesce(l_extendedprice < lo1 OR l_extendedprice > hi1, false)
        OR coalesce(l_discount < lo2 OR l_discount > hi2, false)
        OR coalesce(l_tax < lo3 OR l_tax > hi3, false))
""")
def iqr_filter_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LI_NUM)
    return iqr_filter(li, LI_NUM).select("l_orderkey", "l_linenumber", "l_partkey",
                                         *[_r6(c) for c in LI_NUM])


@query("iqr_filter_texts", "FLT-05 AGG-11", """
WITH t AS (SELECT doc_id, n_chars, length(text) - length(replace(text, ' ', '')) AS n_blanks FROM documents),
q AS (SELECT quantile_cont(n_chars, 0.25) AS a, quantile_cont(n_chars, 0.75) AS b,
             quantile_cont(n_blanks, 0.25) AS c, quantile_cont(n_blanks, 0.75) AS d FROM t)
SELECT doc_id, n_chars, n_blanks FROM t, q
WHERE NOT (coalesce(n_chars < a - 1.5 * (b - a) OR n_chars > b + 1.5 * (b - a), false)
        OR coalesce(n_blanks < c - 1.5 * (d - c) OR n_blanks > d + 1.5 * (d - c), false))
""")
def iqr_filter_texts(spark, sf_dir):
    """Documents without those of unusual length: lengths have a long tail, so the fence takes rows away."""
    blanks = F.char_length("text") - F.char_length(F.replace("text", F.lit(" "), F.lit("")))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", blanks.cast("bigint").alias("n_blanks"))
    return iqr_filter(docs, ["n_chars", "n_blanks"])


@query("topk_per_group", "AGG-10 FLT-06", """
SELECT event_type, user_id, "count", "rank" FROM (
  SELECT event_type, user_id, count(*) AS "count",
         row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id ASC NULLS FIRST) AS "rank"
  FROM events GROUP BY 1, 2) t
WHERE "rank" <= 2
""")
def topk_per_group(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return top_k_per_group(ev, "event_type", "user_id", 2).select(
        "event_type", "user_id", "count", F.col("rank").cast("bigint").alias("rank"))


@query("hash_split", "ORD-04", """
SELECT CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
            THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM orders GROUP BY 1
""")
def hash_split_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return (o.select(split_label("o_orderkey", 80).alias("split"))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


_EXPLORE_COLS = ["Issue Date", "Violation Time", "user_id", "event_type",
                 "Time bin", "Issue Day", "Issue Month", "Issue Year"]
_EXPLORE_SQL_BASE = """
SELECT strftime(ts, '%m/%d/%Y') AS "Issue Date",
       strftime(ts, '%I%M') || left(strftime(ts, '%p'), 1) AS "Violation Time",
       CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(CASE WHEN hr IN ('00','01','02','03','12') AND p = 'A' THEN 1
            WHEN hr IN ('04','05','06','07') AND p = 'A' THEN 2
            WHEN hr IN ('08','09','10','11') AND p = 'A' THEN 3
            WHEN hr IN ('12','00','01','02','03') AND p = 'P' THEN 4
            WHEN hr IN ('04','05','06','07') AND p = 'P' THEN 5
            WHEN hr IN ('08','09','10','11') AND p = 'P' THEN 6
            ELSE 3 END AS VARCHAR) AS "Time bin",
       CAST(dayofweek(ts) + 1 AS VARCHAR) AS "Issue Day", CAST(month(ts) AS VARCHAR) AS "Issue Month",
       CAST(year(ts) AS VARCHAR) AS "Issue Year"
FROM (SELECT *, strftime(ts, '%I') AS hr, left(strftime(ts, '%p'), 1) AS p FROM events) e"""


_EXPLORE_UNION = " UNION ALL ".join(
    "SELECT '%s' AS column_name, \"%s\" AS value FROM b" % (c, c) for c in _EXPLORE_COLS)


@query("explore_profile", "AGG-02 AGG-03 AGG-10 ORD-01 ORD-02 SCL-01 SCL-02 SCL-03", f"""
WITH b AS ({_EXPLORE_SQL_BASE}),
long AS ({_EXPLORE_UNION}),
cnt AS (SELECT column_name, value, count(*) AS "count" FROM long GROUP BY 1, 2)
SELECT column_name, value, "count", "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY "count" DESC, value ASC NULLS FIRST) AS "rank"
  FROM cnt) t
WHERE "rank" <= 10
""")
def explore_profile(spark, sf_dir):
    """The exploration report: the citation-shaped events with the derived
    date parts and time bin, and the ten most frequent values of every
    retained column - one scan, one shuffle, a map-side top-10 per column
    (instead of one job and one sort per column)."""
    from ..functions import ampm_text_from_ts, ampm_time_bin, format_us_date, parse_us_date
    ev = read_table(spark, sf_dir, "events")
    base = ev.select(format_us_date("ts").alias("Issue Date"),
                     ampm_text_from_ts("ts").alias("Violation Time"), "user_id", "event_type")
    d = parse_us_date("Issue Date")
    base = base.withColumns({"Time bin": ampm_time_bin("Violation Time"), "Issue Day": F.dayofweek(d),
                             "Issue Month": F.month(d), "Issue Year": F.year(d)})
    counts = frequency_many(base, _EXPLORE_COLS)
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 10)
    return top.select(F.col("column").alias("column_name"), "value", "count",
                      F.col("rank").cast("bigint").alias("rank"))
