"""Many models in one pass (UDF-05, INF-02).

Fitted models are files of plain arrays in a shared folder.  A Python worker loads
each once, and one Arrow pass scores every vector with all of them: the result is an
array with one struct per model.  So N models cost one scan, one transfer of the
vectors and no broadcast.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship_package
from ..sources.objects import file_system, visible_objects
from .inference import MAX_MODEL_VALUES

PREDICTIONS = "array<struct<model: string, label: long, score: double>>"
BATCH = 64  # vectors scored at a time


def nearest_model(labels, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """Nearest centroid by squared Euclidean distance; the score is its negative."""
    return {"kind": np.array("nearest"), "labels": np.asarray(labels, np.int64), "weights": np.asarray(centroids, float)}


def cosine_model(labels, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """Centroid of largest cosine; a vector or centroid of length 0 has cosine 0."""
    c = np.asarray(centroids, float)
    return {"kind": np.array("cosine"), "labels": np.asarray(labels, np.int64), "weights": c}


def logistic_model(labels, fitted) -> dict[str, np.ndarray]:
    """A Spark ``LogisticRegressionModel`` (multinomial, or binary as two classes); the score is the class's probability."""
    weights, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    if len(weights) == 1:
        weights, bias = np.concatenate([np.zeros_like(weights), weights]), np.array([0.0, bias[0]])
    return {"kind": np.array("logistic"), "labels": np.asarray(labels, np.int64), "weights": weights, "bias": bias}


def network_model(labels, fitted) -> dict[str, np.ndarray]:
    """A Spark ``MultilayerPerceptronClassificationModel``: sigmoid hidden layers, softmax at the end."""
    layers, flat = list(fitted.getLayers()), fitted.weights.toArray()
    out, at = {"kind": np.array("network"), "labels": np.asarray(labels, np.int64)}, 0
    for k, (a, b) in enumerate(zip(layers[:-1], layers[1:], strict=True)):
        out[f"weights{k}"] = flat[at:at + a * b].reshape(a, b)  # column by column of outputs x inputs
        out[f"bias{k}"] = flat[at + a * b:at + a * b + b]
        at += a * b + b
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _nearest(m, x):
    return -np.round(((x[:, None, :] - m["weights"][None]) ** 2).sum(axis=2), 9)


def _cosine(m, x):
    lengths = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(m["weights"], axis=1)[None]
    return np.round(np.divide(x @ m["weights"].T, lengths, out=np.zeros_like(lengths), where=lengths > 0), 9)


def _logistic(m, x):
    return _softmax(x @ m["weights"].T + m["bias"])


def _network(m, x):
    layers = sum(name.startswith("weights") for name in m)
    for k in range(layers):
        x = x @ m[f"weights{k}"] + m[f"bias{k}"]
        x = 1 / (1 + np.exp(-x)) if k + 1 < layers else _softmax(x)
    return x


KINDS: dict[str, Callable] = {"nearest": _nearest, "cosine": _cosine, "logistic": _logistic, "network": _network}


def save_parameters(models: Mapping[str, dict[str, np.ndarray]], folder: str) -> str:
    """Write every model as ``name.npz`` below ``folder`` (arrays alone, nothing that runs on loading)."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    for name, arrays in models.items():
        values = sum(a.size for a in arrays.values())
        if values > MAX_MODEL_VALUES:
            raise ValueError(f"model {name} has {values} values, above the bound of {MAX_MODEL_VALUES} that a worker keeps")
        if str(arrays["kind"]) not in KINDS:
            raise ValueError(f"model {name} is of unknown kind {arrays['kind']}")
        held = io.BytesIO()
        np.savez(held, **arrays)
        with system.open_output_stream(f"{root.rstrip('/')}/{name}.npz", compression=None) as f:
            f.write(held.getvalue())
    return folder


@lru_cache(maxsize=4)
def load_parameters(folder: str) -> dict[str, dict[str, np.ndarray]]:
    """All models of a folder by name; a worker reads them once."""
    system, root = file_system(folder)
    out = {}
    for path, _ in visible_objects(system, root):
        with system.open_input_file(f"{root.rstrip('/')}/{path}") as f:
            with np.load(io.BytesIO(f.read()), allow_pickle=False) as z:
                out[path.removesuffix(".npz")] = {k: z[k] for k in z.files}
    return out


def score_many(df: DataFrame, vec: str, folder: str, predictions: str = "predictions", batch_size: int = BATCH) -> DataFrame:
    """``df`` with a column ``predictions``: per model of ``folder``, in order of names, its label and score.

    Of equal scores the label that comes first in the model wins.  A vector that is
    null or holds nulls, or NaN, gets null labels and scores.  ``predictions``
    replaces a column of that name; other columns pass through."""
    ship_package(df.sparkSession)
    rest = [c for c in df.columns if c != predictions]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = load_parameters(folder)
        for batch in batches:
            vectors = batch.column(vec).to_pylist()
            good = [i for i, v in enumerate(vectors) if v is not None and all(x is not None and x == x for x in v)]
            label = np.zeros((batch.num_rows, len(models)), np.int64)
            score = np.zeros((batch.num_rows, len(models)))
            for at in range(0, len(good), batch_size):
                rows = good[at:at + batch_size]
                x = np.array([vectors[i] for i in rows], float)
                for k, m in enumerate(models.values()):
                    s = KINDS[str(m["kind"])](m, x)
                    best = s.argmax(axis=1)
                    label[rows, k], score[rows, k] = m["labels"][best], s[np.arange(len(rows)), best]
            missing = np.ones((batch.num_rows, len(models)), bool)
            missing[good] = False
            structs = pa.StructArray.from_arrays([pa.array(list(models) * batch.num_rows, pa.string()), pa.array(label.ravel(), pa.int64(), mask=missing.ravel()),
                                                  pa.array(score.ravel(), pa.float64(), mask=missing.ravel())], ["model", "label", "score"])
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * np.int32(len(models)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.ListArray.from_arrays(offsets, structs)], [*rest, predictions])

    kept = df.select(*rest)
    return kept.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in kept.dtypes), f"`{predictions}` {PREDICTIONS}"]))
