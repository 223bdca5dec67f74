"""Queries: catalog tables by name, bucketed by key."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.clean import dedup
from ..operators.profile import duplicate_keys
from ..session import scratch_path
from ..sources.bucketed import write_bucketed
from ..sources.readers import load_table, read_table
from .registry import query


def _by_name(spark, sf_dir) -> tuple[str, str]:
    """Orders, a tenth of them twice, and lines as tables in equal numbers of buckets by the order's key."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    buckets, run = int(spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex[:12]
    names = f"orders_{run}", f"lines_{run}"
    doubled = orders.unionByName(orders.where(F.col("o_orderkey") % 10 == 0))
    for df, name, key in ((doubled, names[0], "o_orderkey"), (lines, names[1], "l_orderkey")):
        write_bucketed(df, name, [key], buckets, path=scratch_path(spark, name))
    return names


@query("table_by_name", "SRC-05 DED-01 AGG-01", """
SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
       coalesce(n_lines, 0) AS n_lines, coalesce(quantity, 0) AS quantity
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
                       FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
""")
def table_by_name(spark, sf_dir):
    """Two tables loaded by name: one row an order, with its lines summed; nothing is shuffled after the write."""
    orders, lines = (load_table(spark, name) for name in _by_name(spark, sf_dir))
    sums = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    # a merge join: both sides already stand in the order of the key
    joined = dedup(orders, ["o_orderkey"], deterministic=True).join(sums.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 6).alias("o_totalprice"),
                         F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("quantity", F.lit(0)).alias("quantity"))


@query("duplicates_by_name", "SRC-05 AGG-13", "SELECT o_orderkey, CAST(2 AS BIGINT) AS \"count\" FROM orders WHERE o_orderkey % 10 = 0")
def duplicates_by_name(spark, sf_dir):
    """Keys that stand more than once in a table loaded by name."""
    return duplicate_keys(load_table(spark, _by_name(spark, sf_dir)[0]), ["o_orderkey"])
