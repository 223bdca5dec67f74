"""Queries: several models scored in one pass, and their top predictions per class."""

from __future__ import annotations

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions import lookup
from ..operators.inference import CLASS_NAMES, centroid_matrix, fit_centroids
from ..operators.model_files import cosine_model, logistic_model, nearest_model, network_model, save_parameters, score_many
from ..operators.models import logistic_regression, persist, unpersist
from ..operators.profile import top_k_per_group
from ..session import scratch_path
from ..sources.readers import read_table
from .registry import query

TOP = (5, 2)  # as many predictions per class as the original reports, by model


def _top_predictions(scored):
    rows = scored.select(F.col("label").alias("true"), F.inline("predictions"))
    named = rows.select("model", lookup("true", CLASS_NAMES).alias("label_name"), lookup("label", CLASS_NAMES).alias("predicted"))
    top = top_k_per_group(named, ["model", "label_name"], "predicted", max(TOP))
    return top.select("model", "label_name", "predicted", "count", F.col("rank").cast("bigint").alias("rank"), (F.col("rank") <= min(TOP)).alias("in_top_2"))


_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in CLASS_NAMES) + "]"


@query("models_topk", "INF-02 UDF-05 UDF-04 INF-01 AGG-10", f"""
WITH c AS (SELECT label AS c, list(m ORDER BY i) AS m FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1),
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT vec_id, label, c, round(list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) AS d, round(list_cosine_similarity(v, m), 9) AS k FROM v, c),
p AS (SELECT 'centroid_cosine' AS model, label, c FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY k DESC, c) = 1
  UNION ALL SELECT 'centroid_l2' AS model, label, c FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1),
n AS (SELECT model, {_NAMES_SQL}[label + 1] AS label_name, {_NAMES_SQL}[c + 1] AS predicted, count(*) AS count FROM p GROUP BY 1, 2, 3)
SELECT *, row_number() OVER (PARTITION BY model, label_name ORDER BY count DESC, predicted) AS rank, row_number() OVER (PARTITION BY model, label_name ORDER BY count DESC, predicted) <= {min(TOP)} AS in_top_2
FROM n QUALIFY rank <= {max(TOP)}
""")
def models_topk(spark, sf_dir):
    """Two centroid models kept as files and scored in one pass: their five most
    frequent predictions per class, the first two marked."""
    e = read_table(spark, sf_dir, "embeddings").select("label", "embedding")
    labels, centroids = centroid_matrix(fit_centroids(e, "embedding", "label"), "label")
    folder = save_parameters({"centroid_l2": nearest_model(labels, centroids), "centroid_cosine": cosine_model(labels, centroids)}, scratch_path(spark, "model-files"))
    return _top_predictions(score_many(e, "embedding", folder))


def fit_four(e, hidden: int = 16, seed: int = 1):
    """Four kinds of models over vectors: nearest centroid, cosine, logistic regression and a two-layer network, all fitted by Spark."""
    labels, centroids = centroid_matrix(fit_centroids(e, "embedding", "label"), "label")
    index = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")).cast("double") - 1
    data, = persist(e.where("label IS NOT NULL").select(index.alias("y"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")))
    lr = logistic_regression(label="y", regParam=0.01, elasticNetParam=0.0, maxIter=50).fit(data)
    net = MultilayerPerceptronClassifier(labelCol="y", layers=[centroids.shape[1], hidden, len(labels)], seed=seed, maxIter=60).fit(data)
    unpersist(data)
    return {"centroid_cosine": cosine_model(labels, centroids), "centroid_l2": nearest_model(labels, centroids),
            "logistic": logistic_model(labels, lr), "network": network_model(labels, net)}, (lr, net)


@query("models_compared", "INF-02 UDF-05")
def models_compared(spark, sf_dir):
    """Four models in one pass, compared by their top predictions per class (rows
    only: fitted weights; tests hold the scores against Spark's own transform)."""
    e = read_table(spark, sf_dir, "embeddings").select("label", "embedding")
    models, _ = fit_four(e)
    return _top_predictions(score_many(e, "embedding", save_parameters(models, scratch_path(spark, "model-files"))))
