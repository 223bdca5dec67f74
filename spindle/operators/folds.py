"""Cross-validation, category encoding and importances out of fold statistics.

A row's fold is a hash of its key.  Sums per fold are taken in one scan; the
statistics of all folds but one are the total minus that fold, so every fold's
model comes from the same aggregate (MLT-05, MLT-03, FEA-01, MLT-02).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .inference import MAX_MODEL_VALUES
from .split import key_hash_bucket

DIGITS = 9  # scores are compared to so many places, which makes ties of equal models


def fold_of(key: str, folds: int) -> Column:
    """The fold of a row: its key's hash bucket; a null key is in fold 0."""
    return F.coalesce(key_hash_bucket(key), F.lit(0)) % folds


def naive_bayes_statistics(df: DataFrame, label: str, features: Sequence[str], key: str, folds: int = 3) -> DataFrame:
    """``fold, label, n, s_0, s_1, ...``: rows and feature sums, one aggregate combined in the tasks; null features count as 0."""
    sums = [F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"s_{i}") for i, c in enumerate(features)]
    return df.where(F.col(label).isNotNull()).groupBy(fold_of(key, folds).alias("fold"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), *sums)


def naive_bayes_models(statistics: DataFrame, n_features: int, folds: int, smoothing: Sequence[float]) -> list[list[list[tuple[str, float, list[float]]]]]:
    """For each fold and smoothing point the multinomial model of all other folds: ``(label, log prior, log likelihoods)``."""
    most = MAX_MODEL_VALUES // ((n_features + 1) * len(smoothing))
    rows = statistics.limit(most + 1).collect()  # folds x labels rows
    if len(rows) > most:
        raise ValueError("too many labels or features for models on the driver")
    labels = sorted({r.label for r in rows})
    total = {c: [sum(r[f"s_{j}"] for r in rows if r.label == c) for j in range(n_features)] for c in labels}
    count = {c: sum(r.n for r in rows if r.label == c) for c in labels}
    models = []
    for f in range(folds):
        own = {r.label: r for r in rows if r.fold == f}
        n = {c: count[c] - (own[c].n if c in own else 0) for c in labels}
        s = {c: [t - (own[c][f"s_{j}"] if c in own else 0.0) for j, t in enumerate(total[c])] for c in labels}
        seen = [c for c in labels if n[c] > 0]
        models.append([[(c, math.log(n[c] + a) - math.log(sum(n.values()) + a * len(seen)),
                         [math.log(x + a) - math.log(sum(s[c]) + a * n_features) for x in s[c]]) for c in seen] for a in smoothing])
    return models


def naive_bayes_cv(df: DataFrame, label: str, features: Sequence[str], key: str, folds: int = 3, smoothing: Sequence[float] = (0.5, 1.0, 10.0)) -> DataFrame:
    """MLT-03/05: ``fold, smoothing, n, n_correct, accuracy`` of multinomial naive Bayes on each held-out fold.

    Two scans whatever the number of folds and points: one for the sums, one that
    scores every row by its fold's models of all points at once.  Equal scores go to
    the smaller label; a fold whose training side is empty has no correct rows.
    Features must not be negative, smoothing must be above 0."""
    models = naive_bayes_models(naive_bayes_statistics(df, label, features, key, folds), len(features), folds, smoothing)
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    fold = fold_of(key, folds)

    def predicted(point: int) -> Column:
        by_fold = F.lit(None)
        for f in range(folds):
            scores = [F.struct(F.round(sum((xi * w for xi, w in zip(x, theta, strict=True)), F.lit(prior)), DIGITS).alias("s"), F.lit(-i).alias("i"), F.lit(c).alias("c"))
                      for i, (c, prior, theta) in enumerate(models[f][point])]
            if scores:
                by_fold = F.when(fold == f, (F.greatest(*scores) if len(scores) > 1 else scores[0])["c"]).otherwise(by_fold)
        return by_fold

    hits = [F.count_if(predicted(p) == F.col(label)).alias(f"h_{p}") for p in range(len(smoothing))]
    counted = df.where(F.col(label).isNotNull()).groupBy(fold.alias("fold")).agg(F.count(F.lit(1)).alias("n"), *hits)
    points = F.array(*[F.struct(F.lit(float(a)).alias("smoothing"), F.col(f"h_{p}").alias("n_correct")) for p, a in enumerate(smoothing)])
    return counted.select("fold", "n", F.inline(points)).select("fold", "smoothing", "n", "n_correct", (F.col("n_correct") / F.col("n")).alias("accuracy"))


def best_point(scores: DataFrame, point: str = "smoothing", metric: str = "accuracy"):
    """The grid point of best mean over the folds; of equal ones the smaller."""
    best = scores.groupBy(point).agg(F.avg(metric).alias("mean")).orderBy(F.desc("mean"), point).head()
    return best[point] if best else None


def target_encoded(df: DataFrame, columns: Sequence[str], target: str, key: str, folds: int = 5, prior: float = 20.0, suffix: str = "_enc") -> DataFrame:
    """FEA-01 / MLT-02: ``df`` with a number for each category: the mean of ``target`` over the category's rows in the other folds.

    The mean is drawn to that of all rows outside the fold as if ``prior`` more rows
    had it, so that rare and unseen categories are near it.  No row's own target
    is in its value.  A category is one row of sums per fold however many rows it
    has; trees then need no bin per category.  Null is a category, rows whose
    target is null are encoded and not counted.  The join by category is broadcast
    or split by Spark as sizes demand."""
    t, fold = F.col(target).cast("double"), fold_of(key, folds)
    base = df.where(F.col(target).isNotNull()).groupBy(fold.alias("f")).agg(F.sum(t).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    all_s, all_n = sum(r.s for r in base), sum(r.n for r in base)
    others = {r.f: ((all_s - r.s) / (all_n - r.n) if all_n > r.n else 0.0) for r in base}
    mean = F.lit(all_s / all_n if all_n else 0.0)  # of a fold without rows: that of all
    for f, m in others.items():
        mean = F.when(fold == f, m).otherwise(mean)
    out = df
    for c in columns:
        per = (df.where(F.col(target).isNotNull()).groupBy(F.col(c).alias("_category"), fold.alias("_f")).agg(F.sum(t).alias("s"), F.count(F.lit(1)).alias("n"))
               .groupBy("_category").agg(F.sum("s").alias("_s"), F.sum("n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_f", F.struct("s", "n")))).alias("_folds")))
        own = F.col("_folds")[fold]
        s = F.coalesce(F.col("_s"), F.lit(0.0)) - F.coalesce(own["s"], F.lit(0.0))
        n = F.coalesce(F.col("_n"), F.lit(0)) - F.coalesce(own["n"], F.lit(0))
        out = out.join(per, out[c].eqNullSafe(per["_category"]), "left").withColumn(c + suffix, (s + mean * prior) / (n + F.lit(prior))).drop("_category", "_s", "_n", "_folds")
    return out


def permuted(df: DataFrame, columns: Sequence[str], key: str, seed: int, buckets: int) -> list[Column]:
    """``columns`` with every row's values taken from the next row of its bucket, in the order of a seeded hash of the key (the last takes the first's)."""
    bucket = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("bucket:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(buckets))
    order = Window.partitionBy(bucket).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*columns)
    moved = F.coalesce(F.lead(values).over(order), F.first(values).over(whole))
    return [moved[c].alias(c) for c in columns]


def permutation_importance(df: DataFrame, features: dict[str, Sequence[str]], key: str, score: Callable[[DataFrame], DataFrame],
                           label: str = "label", prediction: str = "prediction", rows_per_bucket: int = 100_000) -> DataFrame:
    """MLT-06: ``feature, n, n_correct, accuracy, importance`` for any model.

    ``features`` names groups of columns.  Each group in turn is permuted within
    random buckets of rows by a seeded hash of ``key`` (group ``i`` by seed ``i``;
    unlike importances of trees this works for every model), and ``score``, which adds
    a column ``prediction``, runs once over all variants.  ``importance`` is the loss
    of accuracy against the row named ``(none)``, where nothing is permuted."""
    n = df.count()
    buckets = max(1, -(-n // rows_per_bucket))
    columns = list(dict.fromkeys(c for group in features.values() for c in group))
    shuffled = df.select("*", *[F.struct(*permuted(df, group, key, i, buckets)).alias(f"_p{i}") for i, group in enumerate(features.values())])
    names = F.array(F.lit("(none)"), *[F.lit(f) for f in features])
    variants = shuffled.withColumn("_variant", F.explode(names))
    replaced = {c: F.col(c) for c in columns}
    for i, (name, group) in enumerate(features.items()):
        replaced |= {c: F.when(F.col("_variant") == name, F.col(f"_p{i}")[c]).otherwise(replaced[c]) for c in group}
    scored = score(variants.withColumns(replaced).select(*[c for c in df.columns if c not in columns], *columns, "_variant"))
    found = scored.groupBy(F.col("_variant").alias("feature")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(prediction) == F.col(label)).alias("n_correct"))
    found = found.withColumn("accuracy", F.col("n_correct") / F.col("n"))
    plain = F.max(F.when(F.col("feature") == "(none)", F.col("accuracy"))).over(Window.partitionBy())  # one row a feature
    return found.withColumn("importance", plain - F.col("accuracy"))


def ranked_places(counts: DataFrame) -> DataFrame:
    """``category, place`` of a table ``category, n``: places from 0 by descending ``n``, ties by category.

    Rows are dealt into ranges of that order and written once; a row's place is its
    range's offset plus its rank there, so no task sees all categories."""
    spark = counts.sparkSession
    path = scratch_path(spark, "ranges")
    counts.repartitionByRange(F.desc("n"), "category").withColumn("range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    # one row a range
    ahead = F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("size")).select("range", ahead.alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(F.desc("n"), "category"))
    return ranged.withColumn("rank", rank).join(F.broadcast(offsets), "range").select("category", (F.col("ahead") + F.col("rank") - 1).cast("long").alias("place"))


def one_hot_triples(df: DataFrame, columns: Sequence[str], key: str, fitted_on: DataFrame) -> DataFrame:
    """FEA-05 / MLT-01: the non-zeros of a one-hot matrix, ``row, index, value``: one per row and column.

    Categories of ``fitted_on`` take places by their count there (most frequent
    first, ties by value), column after column; after each column's categories
    comes one place for values that were not seen, null among them.  No row is
    ever widened to the number of categories, so memory grows with the non-zeros."""
    out, first = [], 0
    for c in columns:
        counts = fitted_on.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"))
        places = ranked_places(counts)
        size = places.count()
        held = df.select(F.col(key).alias("row"), F.col(c).cast("string").alias("_value")).join(places, F.col("_value") == F.col("category"), "left")
        out.append(held.select("row", (F.coalesce("place", F.lit(size)) + first).cast("long").alias("index"), F.lit(1.0).alias("value")))
        first += size + 1
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole
