"""Train/test splits (ORD-04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash_bucket(key) -> Column:
    """0..99 from the first 32 bits of ``md5(key as text)``: the same on any
    engine and any partitioning, and stable when rows are added."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def hash_split(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Deterministic split by key hash: ``bucket < train_pct`` is train; the
    rest (including a null key) is test, so no row is lost."""
    in_train = F.coalesce(key_hash_bucket(key) < train_pct, F.lit(False))
    return df.where(in_train), df.where(~in_train)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 7):
    """``randomSplit`` as in the original job (depends on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


def split_label(key, train_pct: int = 80, names: tuple[str, str] = ("train", "test")) -> Column:
    """The split each row falls in, as a column (one scan for both sides)."""
    return F.when(key_hash_bucket(key) < train_pct, F.lit(names[0])).otherwise(F.lit(names[1]))
