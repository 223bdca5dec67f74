"""Catalog tables laid out by key, so that work on the key needs no shuffle (SRC-05, DED-01, AGG-13).

A table bucketed and sorted by its key is shuffled once, when it is written.
Deduplication, duplicate reports, aggregates and joins on that key then read
every bucket in one task of its own, in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SKEW = 4.0


def bucket_skew(df: DataFrame, keys: Sequence[str], buckets: int) -> float:
    """Rows of the largest bucket, in multiples of an even share (0 for no rows)."""
    number = F.pmod(F.hash(*keys), F.lit(buckets))
    per_bucket = df.groupBy(number.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    largest, rows = per_bucket.agg(F.max("n"), F.sum("n")).first()
    return largest * buckets / rows if rows else 0.0


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None,
                   max_skew: float = MAX_SKEW) -> bool:
    """Write ``df`` as table ``name`` in ``buckets`` by ``keys``, sorted by them within;
    True if it is bucketed.

    A bucket is read by one task, so a key that holds many of the rows would make
    one task of them.  If the largest bucket has over ``max_skew`` times an even
    share, the table keeps all its rows but is written without buckets: work on
    the key shuffles then, and Spark splits the skewed parts at run time.
    ``path`` puts the table's files there; ``name`` is replaced if it exists.
    Tables that are joined need equal numbers of buckets.  Null keys share a bucket."""
    even = bucket_skew(df, keys, buckets) <= max_skew
    rows = df.repartition(buckets, *keys) if even else df
    writer = rows.write.mode("overwrite").format("parquet")
    if even:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return even
