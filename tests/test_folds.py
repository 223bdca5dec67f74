"""Fold statistics against Spark ML and plain Python."""

import hashlib

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from spindle.operators.features import one_hot_stages
from spindle.operators.folds import (best_point, fold_of, naive_bayes_cv, naive_bayes_models, naive_bayes_statistics, one_hot_triples,
                                     permutation_importance, permuted, ranked_places, target_encoded)
from spindle.operators.models import logistic_regression, naive_bayes


def bucket(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % 100


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).select(F.col("id"), (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 3 * 2 + F.rand(1)).alias("a"), (F.rand(2) * 3).alias("b"),
                                   F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("cat")).cache()


def test_every_folds_model_is_that_of_the_other_folds(spark, rows):
    models = naive_bayes_models(naive_bayes_statistics(rows, "label", ["a", "b"], "id", 3), 2, 3, [0.5, 2.0])
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.withColumn("fold", fold_of("id", 3))).cache()
    scores = {(r.fold, r.smoothing): r for r in naive_bayes_cv(rows, "label", ["a", "b"], "id", 3, [0.5, 2.0]).collect()}
    for f in range(3):
        for p, a in enumerate([0.5, 2.0]):
            fitted = naive_bayes(smoothing=a).fit(data.where(F.col("fold") != f))
            for i, (c, prior, theta) in enumerate(models[f][p]):
                assert c == i and prior == pytest.approx(fitted.pi[i]) and theta == pytest.approx(list(fitted.theta.toArray()[i]))
            held = fitted.transform(data.where(F.col("fold") == f)).select("label", "prediction").collect()
            assert scores[f, a].n == len(held) and scores[f, a].n_correct == sum(r.label == r.prediction for r in held)
    assert best_point(naive_bayes_cv(rows, "label", ["a", "b"], "id", 3, [0.5, 2.0])) in (0.5, 2.0)
    odd = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (None, "x", None)], "id long, label string, a double")
    assert sum(r.n for r in naive_bayes_cv(odd, "label", ["a"], "id", 3, [1.0]).collect()) == 2
    assert naive_bayes_cv(odd.limit(0), "label", ["a"], "id", 3, [1.0]).collect() == []


def test_no_row_sees_its_own_target(spark):
    data = [(i, None if i % 11 == 0 else f"v{i * i % 17}", float(i % 5 == 0) if i % 13 else None) for i in range(300)] + [(500, "alone", 1.0)]
    df = spark.createDataFrame(data, "id long, c string, y double")
    fold = {i: bucket(i) % 5 for i, _, _ in data}
    got = {r.id: r.c_enc for r in target_encoded(df, ["c"], "y", "id", folds=5, prior=3.0).collect()}
    for i, c, _ in data:
        others = [y for j, _, y in data if fold[j] != fold[i] and y is not None]
        own = [y for j, d, y in data if d == c and fold[j] != fold[i] and y is not None]
        assert got[i] == pytest.approx((sum(own) + 3.0 * sum(others) / len(others)) / (len(own) + 3.0))
    flipped = df.withColumn("y", F.when(F.col("id") == 7, 1 - F.col("y")).otherwise(F.col("y")))
    assert {r.id: r.c_enc for r in target_encoded(flipped, ["c"], "y", "id", prior=3.0).collect()}[7] == pytest.approx(got[7])
    assert target_encoded(df.limit(0), ["c"], "y", "id").columns == ["id", "c", "y", "c_enc"]


def test_permuting_keeps_the_values_and_finds_what_a_model_uses(spark, rows):
    moved = rows.select("id", F.col("a").alias("was"), *permuted(rows, ["a", "b"], "id", 5, 4)).collect()
    pairs = {(r.a, r.b) for r in moved}
    assert pairs == {(r.a, r.b) for r in rows.collect()} and sum(r.a == r.was for r in moved) < 10
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), logistic_regression(regParam=0.01, elasticNetParam=0.0)]).fit(rows)
    job = lambda: {r.feature: r for r in permutation_importance(rows.drop("cat"), {"a": ["a"], "b": ["b"], "both": ["a", "b"]}, "id", model.transform, rows_per_bucket=200).collect()}
    got = job()
    plain = model.transform(rows).where("label = prediction").count()
    assert got["(none)"].n_correct == plain and got["(none)"].importance == 0 and all(r.n == 600 for r in got.values())
    assert got["a"].importance > 0.3 and abs(got["b"].importance) < 0.05 and got == job()


def test_one_hot_triples_are_the_non_zeros_of_the_vectors(spark, rows):
    train = rows.where("id % 7 <> 3").select("id", "cat", "label")
    odd = rows.select("id", "cat", "label").unionByName(spark.createDataFrame([(900, None, 1.0), (901, "new", 0.0)], "id long, cat string, label double"))
    odd, train = (d.withColumn("label_text", F.col("label").cast("string")) for d in (odd, train))
    vectors = Pipeline(stages=one_hot_stages(["cat", "label_text"])).fit(train).transform(odd)
    want = sorted((r.id, int(i), 1.0) for r in vectors.select("id", "features").collect() for i in r.features.indices)
    assert sorted(tuple(r) for r in one_hot_triples(odd, ["cat", "label_text"], "id", train).collect()) == want
    fitted = Pipeline(stages=[*one_hot_stages(["cat"], numeric=["a"]), logistic_regression(regParam=0.01)]).fit(rows)
    assert fitted.stages[-1].numFeatures == 7 + 1 + 1


def test_places_over_many_ranges(spark):
    counts = spark.range(5000, numPartitions=5).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("category"), (F.col("id") % 40).alias("n"))
    got = {r.category: r.place for r in ranked_places(counts).collect()}
    order = sorted((-(i % 40), f"k{i}") for i in range(5000))
    assert got == {c: p for p, (_, c) in enumerate(order)}
