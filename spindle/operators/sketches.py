"""Profiles that merge: a sketch per arriving batch, joined later without a rescan (AGG-03, AGG-08, AGG-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2**K_ITEMS registers give a distinct count a standard error of about 1.04 / sqrt(2**K_ITEMS): 1.6 %.
K_ITEMS = 12
#: Entries of a quantile sketch; its ranks are within some 1 % of the true ones.
K_RANKS = 400


def batch_sketches(df: DataFrame, numbers: Sequence[str], values: Sequence[str], batch: Sequence[str] = ()) -> DataFrame:
    """``batch..., column, n, n_null, ranks, items``: one row per batch and column, some kilobytes each whatever its rows.

    ``numbers`` get a quantile sketch (``ranks``) of their values as doubles,
    ``values`` a distinct-count sketch (``items``) of their text; nulls are counted
    apart, NaN counts as null.  Tasks combine their own rows first.  Append the
    result to a table as batches arrive."""
    def number(c):
        return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))

    aggregates = []
    for i, c in enumerate(numbers):
        aggregates += [F.count(number(c)).alias(f"n{i}"), F.kll_sketch_agg_double(number(c), K_RANKS).alias(f"k{i}")]
    for i, c in enumerate(values):
        aggregates += [F.count(c).alias(f"m{i}"), F.hll_sketch_agg(F.col(c).cast("string"), K_ITEMS).alias(f"h{i}")]
    wide = df.groupBy(*batch).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    none = F.lit(None).cast("binary")
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), (F.col("_rows") - F.col(f"n{i}")).alias("n_null"), F.col(f"k{i}").alias("ranks"), none.alias("items")) for i, c in enumerate(numbers)]
    parts += [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n"), (F.col("_rows") - F.col(f"m{i}")).alias("n_null"), none.alias("ranks"), F.col(f"h{i}").alias("items")) for i, c in enumerate(values)]
    return wide.select(*batch, F.inline(F.array(*parts)))


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, n, n_null, n_distinct, quantiles`` of all batches of :func:`batch_sketches`, out of their sketches alone."""
    merged = sketches.groupBy("column").agg(F.sum("n").alias("n"), F.sum("n_null").alias("n_null"),
                                            F.kll_merge_agg_double("ranks").alias("ranks"), F.hll_union_agg("items").alias("items"), F.count("ranks").alias("_ranked"), F.count("items").alias("_itemed"))
    ranked = (F.col("_ranked") > 0) & (F.col("n") > 0)
    points = F.array(*[F.kll_sketch_get_quantile_double("ranks", F.lit(float(q))) for q in quantiles])
    return merged.select("column", "n", "n_null", F.when(F.col("_itemed") > 0, F.hll_sketch_estimate("items")).alias("n_distinct"), F.when(ranked, points).alias("quantiles"))
