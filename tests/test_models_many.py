"""Models kept as files and scored in one pass, against Spark's own transform."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from spindle.operators.model_files import KINDS, load_parameters, nearest_model, save_parameters, score_many
from spindle.plans.models_many import fit_four

from conftest import SF001


def test_scores_equal_the_fitted_models(spark, tmp_dir):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "label", "embedding")
    models, (lr, net) = fit_four(e)
    assert {str(m["kind"]) for m in models.values()} == set(KINDS)
    got = score_many(e.repartition(3), "embedding", save_parameters(models, tmp_dir))
    assert got.columns == ["vec_id", "label", "embedding", "predictions"]
    rows = {r.vec_id: {p.model: (p.label, p.score) for p in r.predictions} for r in got.collect()}
    assert all(list(p) == sorted(models) for p in rows.values()) and len(rows) == e.count()
    data = e.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    labels = models["logistic"]["labels"]
    for name, model in (("logistic", lr), ("network", net)):
        for r in model.transform(data).collect():
            label, score = rows[r.vec_id][name]
            assert label == labels[int(r.prediction)] and score == pytest.approx(max(r.probability), abs=1e-9)
    held = {i: np.array(r.embedding, float) for r in e.collect() for i in [r.vec_id]}
    c = models["centroid_cosine"]["weights"]
    for i, x in held.items():
        assert rows[i]["centroid_l2"][0] == models["centroid_l2"]["labels"][np.round(((c - x) ** 2).sum(axis=1), 9).argmin()]
        assert rows[i]["centroid_cosine"][1] == pytest.approx((c @ x / np.linalg.norm(c, axis=1) / np.linalg.norm(x)).max(), abs=1e-8)


def test_odd_vectors_and_bounds(spark, tmp_dir):
    model = nearest_model([7, 3], np.array([[0.0, 0.0], [1.0, 1.0]]))
    save_parameters({"m": model}, tmp_dir)
    rows = [(1, [0.1, 0.2]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id int, v array<double>, predictions string")
    got = {r.id: r.predictions for r in score_many(df, "v", tmp_dir).collect()}
    assert got[1][0].label == 7 and got[5][0].label == 7  # a tie: the first label of the model
    assert all(got[i][0].model == "m" and got[i][0].label is None and got[i][0].score is None for i in (2, 3, 4))
    assert score_many(df.limit(0), "v", tmp_dir).collect() == []
    assert load_parameters(tmp_dir)["m"]["weights"].shape == (2, 2)
    with pytest.raises(ValueError):
        save_parameters({"big": nearest_model([0], np.zeros((1, 9_000_000)))}, tmp_dir)
    with pytest.raises(ValueError):
        save_parameters({"odd": {"kind": np.array("unheard of")}}, tmp_dir)
