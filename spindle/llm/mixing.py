"""Mixing of sources to target weights, with DataFrame functions only.

Targets come from capped water-filling; each source is then read in whole
repetitions plus a last, partial pass in seeded order that stops exactly at
the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 4096


def words(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds ``weight``: the weights in turn over the sources by code point, null last.  One row per source."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to one row per source (``source, source_size, weight``).

    The budget, ``share`` of all sizes, is dealt by weight; a source stops at
    ``max_epochs`` times its size and what it leaves goes to the others by
    weight, until none is above.  A source is full exactly when its ratio of
    cap to weight is at most the final level, so with sources in order of that
    ratio the level follows from running sums, without rounds.  If the budget is
    more than all caps, every source is full.  A weight of 0 or less gets 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    rows = sources.withColumn("cap", F.when(F.col("weight") > 0, cap).otherwise(0.0)).withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    whole = W.partitionBy()
    order = W.orderBy(F.col("ratio").asc_nulls_last(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    positive = F.greatest(F.col("weight"), F.lit(0.0))
    rows = (rows.withColumn("left_size", F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("left_weight", F.sum(positive).over(whole) - F.coalesce(F.sum(positive).over(before), F.lit(0.0)))
            # the level if all before are full and this and the following are not
            .withColumn("level_here", F.when((F.col("weight") > 0) & (F.col("left_size") <= F.col("ratio") * F.col("left_weight")), F.col("left_size") / F.col("left_weight"))))
    rows = rows.withColumn("level", F.first("level_here", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    level = F.greatest(F.col("level"), F.lit(0.0))
    target = F.when(F.col("weight") <= 0, 0.0).when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7) -> DataFrame:
    """``doc_id, text_key, source, size, source_size, target, whole, part, taken`` for every row of ``docs``.

    ``docs`` has ``doc_id, text, source``; other columns are ignored.  ``whole``
    is the number of whole repetitions, ``part`` the words of the last partial
    pass: the source's documents in seeded hash order are taken whole until the
    target is reached, the one that crosses it up to there.  So a source's taken
    words are its target rounded, no document exceeds its whole repetitions plus
    one and reruns agree.  Repeated rows have equal hashes and are taken one
    after another.  A null text has size 0; null sources form a source.

    Only one row per source meets in one task.  The order of the last pass is cut
    into buckets by hash (about ``BUCKET_ROWS`` rows each); all but the bucket
    that holds the end need its total alone.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(text).alias("text_key"), words(text).alias("size"))
    # 62 bits: the hash as a place from 0 to 1 in the order of the last pass
    rows = staged(rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id", "text_key", F.lit(seed)), 2)), "mix-sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    targets = staged(water_fill(cycle_weights(per, weights), share, max_epochs).join(per.select(F.col("source").alias("s"), "n_rows"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
                     .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long"))
                     .withColumn("rest", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
                     .withColumn("buckets", F.ceil(F.col("n_rows") / BUCKET_ROWS).cast("long")), "mix-targets")
    known = targets.withColumnRenamed("source", "s")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("bucket", F.floor(F.col("place") / F.lit(2.0**62) * F.col("buckets")).cast("long"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"), F.first("rest").alias("rest"))
    ahead = F.coalesce(F.sum("bucket_size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = (sums.withColumn("ahead", ahead).filter((F.col("ahead") <= F.col("rest")) & (F.col("rest") < F.col("ahead") + F.col("bucket_size")))
           .select(F.col("source").alias("s"), F.col("bucket").alias("cut"), "ahead"))
    rows = rows.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    at_cut = F.col("bucket") == F.col("cut")
    inside = (rows.filter(at_cut).withColumn("start", F.col("ahead") + F.coalesce(F.sum("size").over(
        W.partitionBy("source").orderBy("place", "doc_id", "text_key").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))).drop("start"))
    others = (rows.filter(~F.coalesce(at_cut, F.lit(False)))
              .withColumn("part", F.when(F.col("bucket") < F.col("cut"), F.col("size")).otherwise(0).cast("long")))
    return (inside.unionByName(others).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
            .select("doc_id", "text_key", "source", "size", "source_size", "target", F.col("epochs").alias("whole"), "part", "taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated as :func:`mix` says, with the same columns.

    Every whole repetition is a row of its own; the partial pass gives a row
    too, whose text ends after its last taken word where it is not whole.  Rows
    that repeat a ``doc_id`` and text share their taken words evenly."""
    keys = (mix(docs, **options).groupBy(F.col("doc_id").alias("_mix_id"), F.col("text_key").alias("_mix_key"))
            .agg(F.max("size").alias("_mix_size"), F.floor(F.sum("taken") / F.count(F.lit(1))).cast("long").alias("_mix_taken")).filter("_mix_taken > 0"))
    size, taken = F.col("_mix_size"), F.col("_mix_taken")
    rows = docs.join(keys, docs["doc_id"].eqNullSafe(F.col("_mix_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_mix_key")))
    whole = F.floor(taken / size)
    passes = F.concat(F.array_repeat(size, whole.cast("int")), F.filter(F.array(taken - whole * size), lambda n: n > 0))
    rows = rows.withColumn("_mix_words", F.explode(passes))
    cut = F.col("_mix_words") < size
    # words with the white space before them, which so stays as it was
    short = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, F.col("_mix_words").cast("int")), "")
    rows = rows.withColumn("text", F.when(cut, short).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
