"""Distributed training, cross-validation and evaluation (MLT-01..MLT-10).

Training runs in Spark ML (tree aggregates over the partitions); only model
parameters come back to the driver.  Train/test frames are persisted once
because each fit and each evaluation is a separate job over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       NaiveBayes)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forests import ManyTreesClassifier, predicted
from .metrics import accuracy_f1


def logistic_regression(label="label", features="features", **params):
    """MLT-01 (project defaults: regParam 0.4, elasticNetParam 0.7)."""
    p = {"regParam": 0.4, "elasticNetParam": 0.7, **params}
    return LogisticRegression(labelCol=label, featuresCol=features, **p)


def random_forest(label="label", features="features", **params):
    """MLT-02 (project defaults: 500 trees, maxBins 10000; seed fixed).  Many shallow
    trees over many rows are grown by blocks of rows (:mod:`.forests`)."""
    p = {"numTrees": 500, "maxBins": 10000, "seed": 42, **params}
    return ManyTreesClassifier(labelCol=label, featuresCol=features, **p)


def deep_forest(**params):
    """MLT-02 for grids whose trees go deep: each row's node in every tree is kept
    between passes.  Else every task of every pass gets all trees grown so far and
    walks each row down from the roots.  The trees are the same.  Flat forests of
    many trees do better without, for it holds four bytes a row and tree."""
    return random_forest(cacheNodeIds=True, **params)


def naive_bayes(label="label", features="features", **params):
    """MLT-03: multinomial, smoothing 1."""
    p = {"smoothing": 1.0, "modelType": "multinomial", **params}
    return NaiveBayes(labelCol=label, featuresCol=features, **p)


def decision_tree(label="label", features="features", **params):
    """MLT-04."""
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=42, **params)


# The grids searched, per classifier, parameter and its values.
GRIDS = {
    "lr": {"regParam": [0.01, 0.03, 0.1], "elasticNetParam": [0.5, 0.8, 1.0]},
    "rf": {"numTrees": [3, 5, 10], "maxDepth": [10, 20, 30], "impurity": ["gini", "entropy"]},
    "nb": {"smoothing": [0.5, 1.0, 10.0]},
    "dt": {"impurity": ["gini", "entropy"]},
}


# The forest grid of the feature exploration.
EXPLORATION_GRID = {"numTrees": [3, 50, 100], "maxDepth": [10, 20, 30], "impurity": ["gini", "entropy"]}


def grid_of(estimator, values: dict) -> list:
    """All combinations of the parameters' values."""
    grid = ParamGridBuilder()
    for name, options in values.items():
        grid.addGrid(estimator.getParam(name), options)
    return grid.build()


def classifier_grids(lr, rf, nb, dt) -> dict:
    """MLT-05: each classifier with its grid (9, 18, 3 and 2 points)."""
    return {name: (e, grid_of(e, GRIDS[name])) for name, e in {"lr": lr, "rf": rf, "nb": nb, "dt": dt}.items()}


def train_pipelines(feature_stages: Sequence, classifiers: dict, train: DataFrame,
                    post_stages: Sequence = (), save_root: str | None = None) -> dict:
    """MLT-10: one pipeline model per classifier, each with a *fresh* stage list
    (the shared-list mutation of the original would put both classifiers
    into the second pipeline).  The feature stages are fitted once and shared.
    Models are saved under ``save_root``."""
    from ..sinks.writers import save_model
    features = Pipeline(stages=list(feature_stages)).fit(train)
    data = features.transform(train)
    models = {}
    for name, clf in classifiers.items():
        own = Pipeline(stages=[clf, *post_stages]).fit(data)
        m = PipelineModel([*features.stages, *own.stages])
        if save_root:
            save_model(m, f"{save_root}/{name}")
        models[name] = m
    return models


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """MLT-07/08 with the ML evaluator (for parity checks)."""
    out = {}
    for metric in ("accuracy", "f1"):
        ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)
        out[metric] = ev.evaluate(pred)
    return out


def score_report(models: dict, splits: dict, label: str = "label") -> DataFrame:
    """MLT-09: (model, split, n, accuracy, f1) for every model and split, as
    one DataFrame built from distributed aggregates (no driver loop over
    rows; one small union of one-row results).  Forests of many shallow trees
    score by leaf bits, with the same predictions."""
    parts = []
    for mname, m in models.items():
        run = predicted(getattr(m, "stages", [m]), next(iter(splits.values())).sparkSession)
        for sname, df in splits.items():
            r = accuracy_f1(run(df), label, "prediction")
            parts.append(r.select(F.lit(mname).alias("model"), F.lit(sname).alias("split"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_validate(estimator, grid, train: DataFrame, label: str = "label", folds: int = 3,
                   seed: int = 7, parallelism: int = 8):
    """MLT-05: grid x k-fold CV on accuracy, refit of the best point."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                           metricName="accuracy")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev,
                        numFolds=folds, seed=seed, parallelism=parallelism)
    return cv.fit(train)


def with_features(features: PipelineModel, model) -> PipelineModel:
    """The fitted feature stages followed by a model fitted on their output."""
    return PipelineModel([*features.stages, model])


def feature_importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """MLT-06: importances named by the assembler inputs."""
    imp = model.featureImportances
    return [(n, float(imp[i])) for i, n in enumerate(names)]


def persist(*frames: DataFrame) -> list[DataFrame]:
    return [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]


def unpersist(*frames: DataFrame) -> None:
    for f in frames:
        f.unpersist()
