"""Forests grown and scored by blocks of rows."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from spindle.operators.features import assembler, index_to_string, string_indexer
from spindle.operators.models import random_forest, score_report, train_pipelines


@pytest.fixture(scope="module")
def rows(spark):
    """Classes that hang on a numeric, a wide and a narrow text column, with some noise."""
    def below(n, salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    df = spark.range(6000).select(below(1000, 1).cast("double").alias("a"), F.concat(F.lit("k"), below(30, 2)).alias("c"),
                                  F.concat(F.lit("z"), below(3, 3)).alias("d"), F.lit(1.0).alias("same"), below(10, 4).alias("noise"))
    hit = F.when(F.col("a") > 250, 1).otherwise(0) + F.when(F.col("c").isin("k1", "k5", "k9", "k11"), 1).otherwise(0) + F.when(F.col("d") == "z1", 1).otherwise(0)
    return df.withColumn("kind", F.concat(F.lit("y"), hit + F.when(F.col("noise") < 1, 1).otherwise(0))).drop("noise").coalesce(3)


@pytest.fixture
def by_blocks(monkeypatch):
    from spindle.operators import forests
    monkeypatch.setattr(forests, "MIN_PAIRS", 1)
    monkeypatch.setattr(forests, "BLOCK", 500)

    def never(*_):
        raise AssertionError("Spark's own fit")

    monkeypatch.setattr(RandomForestClassifier, "_fit", never)


def _stages(rows):
    return [StringIndexer(inputCol="kind", outputCol="label").fit(rows), string_indexer(["c", "d"]), assembler(["a", "same", "c_idx", "d_idx"])]


def test_many_trees_are_grown_by_blocks_as_spark_grows_them(spark, rows, tmp_dir, monkeypatch, request):
    data = Pipeline(stages=_stages(rows)).fit(rows).transform(rows).cache()
    spark_grown = RandomForestClassifier(numTrees=40, maxBins=32, seed=42).fit(data)
    request.getfixturevalue("by_blocks")
    forest = random_forest(numTrees=40, maxBins=32)
    grown = forest.fit(data)
    assert isinstance(grown, RandomForestClassificationModel) and grown.uid == forest.uid
    assert grown.getNumTrees == 40 and grown.numClasses == spark_grown.numClasses == 5 and grown.getMaxBins() == 32
    again = forest.fit(data)
    assert [t.toDebugString.split("\n", 1)[1] for t in grown.trees] == [t.toDebugString.split("\n", 1)[1] for t in again.trees]
    nodes = [sum(t.numNodes for t in m.trees) for m in (grown, spark_grown)]
    assert max(t.depth for t in grown.trees) == 5 and abs(nodes[0] / nodes[1] - 1) < 0.1
    assert np.abs(grown.featureImportances.toArray() - spark_grown.featureImportances.toArray()).max() < 0.08
    right = [m.transform(data).where("label = prediction").count() / 6000 for m in (grown, spark_grown)]
    assert abs(right[0] - right[1]) < 0.03 and right[0] > 0.6
    # every tree is grown on draws from all rows
    grown.save(f"{tmp_dir}/grown")
    drawn = [r["n"] for r in spark.read.parquet(f"{tmp_dir}/grown/data").where("nodeData.id = 0").selectExpr("nodeData.rawCount as n").collect()]
    assert len(drawn) == 40 == len(spark.read.parquet(f"{tmp_dir}/grown/data").select("treeID").distinct().collect())
    assert all(abs(n - 6000) < 5 * math.sqrt(6000) for n in drawn) and len(set(drawn)) > 10
    data.unpersist()


def test_clear_borders_are_found_by_every_tree(spark, by_blocks):
    df = spark.range(3000).select((F.col("id") % 30).cast("double").alias("v"))
    df = assembler(["v"]).transform(df.withColumn("label", F.when(F.col("v") > 20, 2.0).when(F.col("v") > 10, 1.0).otherwise(0.0)))
    grown = random_forest(numTrees=8, maxBins=32).fit(df)
    assert all(sorted(line.split("<= ")[1] for line in t.toDebugString.splitlines() if "If" in line) == ["10.5)", "20.5)"] for t in grown.trees)
    assert grown.transform(df).where("prediction <> label").count() == 0


def test_rows_that_sparks_fit_refuses_are_refused(spark, by_blocks):
    good = spark.range(100).selectExpr("cast(id as double) as v", "cast(id % 2 as double) as label")
    for bad in ("cast('NaN' as double) as v, 1D as label", "1D as v, cast(null as double) as label", "1D as v, 0.5D as label"):
        df = assembler(["v"], handle_invalid="keep").transform(good.unionByName(spark.sql(f"SELECT {bad}")))
        with pytest.raises(Exception, match="NaN or infinite|none of the"):
            random_forest(numTrees=4, maxBins=32).fit(df)


def test_train_eval_steps_with_a_forest_by_blocks(spark, rows, tmp_dir, by_blocks):
    from spindle.sources.readers import load_model
    stages = _stages(rows)
    train_pipelines(stages, {"rf": random_forest(numTrees=40, maxBins=32)}, rows, [index_to_string("prediction", "text", stages[0].labels)], tmp_dir)
    loaded = load_model(f"{tmp_dir}/rf")
    want = loaded.transform(rows)
    assert want.where("kind = text").count() > 3600
    report = score_report({"rf": loaded}, {"all": rows}).first()
    assert report["n"] == 6000 and report["accuracy"] == want.where("label = prediction").count() / 6000


def test_scores_by_leaf_bits_are_the_models(spark, rows, monkeypatch):
    from spindle.operators import forests
    data = Pipeline(stages=_stages(rows)).fit(rows).transform(rows)
    model = RandomForestClassifier(numTrees=40, maxBins=32, seed=1).fit(data)
    # beside the rows: NaN, and categories that are none
    from pyspark.ml.linalg import Vectors
    odd = [(Vectors.dense(a, 1.0, c, d),) for a in (float("nan"), -1.0, 250.0, 250.5) for c in (-1.0, 0.0, 2.5, 30.0, 77.0, float("nan")) for d in (0.0, 3.0, 9.0)]
    for frame in (data, spark.createDataFrame(odd, data.select("features").schema)):
        both = forests.with_forest_prediction(model.transform(frame), "features", "own", forests.forest_tables(model, spark))
        assert both.count() > 50 and both.where("not (own <=> prediction)").count() == 0
    # one pass in Python per frame, and none of Spark's votes
    monkeypatch.setattr(RandomForestClassificationModel, "transform", lambda *_: pytest.fail("scored row by row"))
    assert score_report({"rf": model}, {"all": data}).first()["n"] == 6000


def test_forests_of_deep_trees_are_scored_by_spark(spark, rows):
    from spindle.operators import forests
    data = Pipeline(stages=_stages(rows)).fit(rows).transform(rows)
    assert forests.forest_tables(RandomForestClassifier(numTrees=40, maxDepth=8, maxBins=32, seed=1).fit(data), spark) is None
    assert forests.forest_tables(RandomForestClassifier(numTrees=3, maxBins=32, seed=1).fit(data), spark) is None


def test_bootstrap_counts_are_poisson_draws():
    from spindle.operators.forests import bootstrap_counts
    assert (bootstrap_counts([1, 2, 3, 4], 1001) == bootstrap_counts([1, 2, 3, 4], 1001)).all()
    drawn = np.concatenate([bootstrap_counts([7, 0, k, 1], 16384) for k in range(200)])
    n = len(drawn)
    for k, found in enumerate(np.bincount(drawn)[:9]):
        expected = n * math.exp(-1) / math.factorial(k)
        assert abs(found - expected) < 5 * math.sqrt(expected)
