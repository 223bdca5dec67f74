"""Feature stages and model training helpers."""

import pytest
from pyspark.ml.classification import LogisticRegression, NaiveBayes

from spindle.operators.clean import feature_columns
from spindle.operators.features import assembler, string_indexer, without_features
from spindle.operators.models import (classifier_grids, decision_tree, logistic_regression,
                                      naive_bayes, random_forest, score_report, train_pipelines)
from spindle.sources.readers import load_model


@pytest.fixture(scope="module")
def small(spark):
    rows = [("NY", "PAS", 1.0, 2, "K"), ("NJ", "COM", 0.0, 3, "Q"), ("NY", "PAS", 2.0, 5, "K"),
            ("CT", "PAS", 1.5, 1, "Q"), ("NY", "COM", 0.5, 4, "K"), ("NJ", "PAS", 3.0, 2, "Q")]
    return spark.createDataFrame(rows, "state string, plate string, x double, n int, county string")


def test_feature_columns_are_ordered(small):
    str_cols, feats = feature_columns(small, "county")
    assert str_cols == ["state", "plate"]
    assert feats == ["x", "n", "state_idx", "plate_idx"]


def test_indexer_keep_and_error(spark, small):
    model = string_indexer(["state"]).fit(small)
    assert model.labelsArray[0] == ["NY", "NJ", "CT"]  # frequency desc, ties by value
    new = spark.createDataFrame([("TX",), (None,), ("NY",)], "state string")
    assert [r[0] for r in model.transform(new).select("state_idx").collect()] == [3.0, 3.0, 0.0]
    strict = string_indexer(["state"], keep_invalid=False).fit(small)
    with pytest.raises(Exception):
        strict.transform(new).collect()


def test_without_features(small):
    assert "x" not in without_features(small, ["x"]).columns


def test_fresh_stage_list_per_model_and_save_load(spark, small, tmp_dir):
    from pyspark.ml.feature import StringIndexer
    label = StringIndexer(inputCol="county", outputCol="label").fit(small)
    stages = [label, string_indexer(["state", "plate"]), assembler(["x", "n", "state_idx", "plate_idx"])]
    before = list(stages)
    models = train_pipelines(stages, {"lr": logistic_regression(maxIter=5),
                                      "nb": naive_bayes()}, small, save_root=tmp_dir)
    assert stages == before  # the caller's list is not mutated
    for name, cls in (("lr", LogisticRegression), ("nb", NaiveBayes)):
        kinds = [type(s).__name__ for s in models[name].stages]
        assert sum(k.endswith("Model") and ("Regression" in k or "Bayes" in k) for k in kinds) == 1, kinds
        assert kinds.count(cls.__name__ + "Model") == 1
        loaded = load_model(f"{tmp_dir}/{name}")
        a = models[name].transform(small).select("prediction").collect()
        b = loaded.transform(small).select("prediction").collect()
        assert a == b
    report = score_report(models, {"all": small}).collect()
    assert len(report) == 2 and all(r["n"] == 6 for r in report)


def test_grids_have_the_expected_sizes():
    g = classifier_grids(logistic_regression(), random_forest(), naive_bayes(), decision_tree())
    assert {k: len(v[1]) for k, v in g.items()} == {"lr": 9, "rf": 18, "nb": 3, "dt": 2}


def test_index_to_string_from_column_metadata(small):
    from spindle.operators.features import index_to_string
    indexed = string_indexer(["state"]).fit(small).transform(small)
    back = index_to_string("state_idx", "state_back").transform(indexed)  # labels from metadata
    assert all(r["state"] == r["state_back"] for r in back.collect())


def test_features_are_fitted_once_and_saved_with_the_model(spark, small, tmp_dir):
    from pyspark.ml import Pipeline
    from spindle.operators.features import minmax_scaler
    from spindle.operators.models import with_features
    from spindle.sinks.writers import save_model
    data = small.selectExpr("*", "cast(x > 2 as double) as label")
    features = Pipeline(stages=[assembler(["x", "n"], "raw"), minmax_scaler("raw", "features")]).fit(data)
    scaled = features.transform(data)
    model = with_features(features, logistic_regression(maxIter=5).fit(scaled))
    save_model(model, f"{tmp_dir}/scaled")
    loaded = load_model(f"{tmp_dir}/scaled")
    assert [type(s).__name__ for s in loaded.stages] == ["VectorAssembler", "MinMaxScalerModel", "LogisticRegressionModel"]
    values = [v for r in loaded.transform(data).select("features").collect() for v in r["features"]]
    assert min(values) == 0 and max(values) == 1


def test_exploration_grid_and_batch_quarantine(spark, tmp_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    from spindle.operators.features import index_to_string
    from spindle.operators.models import EXPLORATION_GRID, grid_of
    from spindle.streaming.jobs import scoring_batch_writer
    assert len(grid_of(random_forest(), EXPLORATION_GRID)) == 18
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 9.0), ("b", 8.0)], "kind string, x double")
    label = StringIndexer(inputCol="kind", outputCol="label").fit(rows)
    model = Pipeline(stages=[label, assembler(["x"]), logistic_regression(regParam=0.0),
                             index_to_string("prediction", "predictedLabel", label.labels)]).fit(rows)
    write = scoring_batch_writer(model, f"{tmp_dir}/o", "kind", label.labels)
    for batch in (0, 0, 1):  # a replayed batch replaces its own output
        write(rows.unionByName(spark.createDataFrame([("new", 1.0), (None, 2.0)], rows.schema)), batch)
    assert spark.read.parquet(f"{tmp_dir}/o/predictions").where("kind = predictedLabel").count() == 8
    assert spark.read.parquet(f"{tmp_dir}/o/quarantine").count() == 4
    assert [r["n"] for r in spark.read.parquet(f"{tmp_dir}/o/metrics").collect()] == [4, 4]


def test_deep_grids_keep_the_rows_nodes_and_grow_the_same_trees(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from spindle.operators.features import TEXT_FEATURES
    from spindle.operators.models import deep_forest
    from spindle.plans import ml
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("Ab, 1\n"), (F.col("id") % 7).cast("int")), F.md5(F.col("id").cast("string"))).alias("text"))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    docs.select("doc_id", (F.xxhash64("doc_id") % 2 == 0).cast("long").alias("quality")).write.parquet(f"{tmp_dir}/labels.parquet")
    asked = []

    class Asked(Exception):
        pass

    def ask(estimator, grid, train):
        asked.extend(getattr(estimator, "getStages", lambda: [estimator])())
        if asked[-1].hasParam("numTrees"):
            raise Asked
        raise AssertionError(estimator)

    monkeypatch.setattr(ml, "cross_validate", ask)
    with pytest.raises(Asked):
        ml.feature_importance(spark, tmp_dir)
    assert asked[-1].getCacheNodeIds()
    monkeypatch.setattr(ml, "classifier_grids", lambda lr, rf, nb, dt: {"rf": (rf, [])})
    with pytest.raises(Asked):
        ml.cv_models(spark, tmp_dir)
    assert asked[-1].getCacheNodeIds()
    train = assembler(TEXT_FEATURES).transform(ml._text_training_frame(spark, tmp_dir)).coalesce(2).cache()
    grown = [f(numTrees=5, maxDepth=12, maxBins=32).fit(train) for f in (random_forest, deep_forest)]
    trees = [[t.toDebugString.split("\n", 1)[1] for t in m.trees] for m in grown]
    assert trees[0] == trees[1] and max(t.depth for t in grown[0].trees) > 5
    train.unpersist()
