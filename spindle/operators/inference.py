"""Batch model inference through Arrow iterator UDFs (UDF-03..05, INF-*).

``make_inference_udf(loader, ...)`` is the UDF factory: ``loader()`` runs
once per task (not per row, not per batch), then every Arrow batch of the
partition is scored in chunks of ``batch_size``.  The model travels as a
broadcast variable whose size is checked before it is broadcast.

The stand-in model is a nearest-centroid classifier: the centroids are a
``groupBy(label, position)`` mean (one row per label and vector position,
so bounded by labels x dimension), fitted by Spark over the whole table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Refuse to broadcast a model above this many float64 values (~64 MB).
MAX_MODEL_VALUES = 8_000_000

# The ten image class names, in class-id order.
CLASS_NAMES = ["airplane", "automobile", "bird", "cat", "deer", "dog", "frog",
               "horse", "ship", "truck"]


def make_inference_udf(loader: Callable[[], Callable[[np.ndarray], pd.DataFrame]],
                       return_type: StructType | str, batch_size: int = 64):
    """UDF-04/05: ``loader()`` returns ``predict(matrix) -> DataFrame`` and is
    called once per task; inputs arrive as Arrow batches of array values."""
    from pyspark.sql import SparkSession

    from ..session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @F.pandas_udf(return_type)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = loader()
        for s in batches:
            outs = []
            for start in range(0, len(s), batch_size):
                chunk = s.iloc[start:start + batch_size]
                mat = np.stack([np.asarray(v, dtype=np.float64) for v in chunk.values]) \
                    if len(chunk) else np.zeros((0, 0))
                outs.append(model(mat))
            yield pd.concat(outs, ignore_index=True) if outs else model(np.zeros((0, 0)))

    return predict


def fit_centroids(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Mean vector per label as ``(label, pos, mean)`` rows (a partial/final
    aggregate; a label holding a third of the rows is pre-reduced map-side)."""
    return (df.select(label, F.posexplode(vec).alias("pos", "x"))
            .groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean")))


def centroid_matrix(centroids: DataFrame, label: str) -> tuple[list, np.ndarray]:
    """Collect the fitted centroids (size checked first) as labels, matrix."""
    # the number of values is known before any of them reaches the driver
    n = centroids.count()
    if n > MAX_MODEL_VALUES:
        raise ValueError(f"centroid model has {n} values, above the broadcast bound of {MAX_MODEL_VALUES}")
    rows = centroids.collect()
    labels = sorted({r[label] for r in rows})
    dim = max(r["pos"] for r in rows) + 1
    mat = np.full((len(labels), dim), np.nan)
    index = {v: i for i, v in enumerate(labels)}
    for r in rows:
        mat[index[r[label]], r["pos"]] = r["mean"]
    return labels, mat


def nearest_centroid_loader(spark, labels: Sequence, mat: np.ndarray, metric: str = "l2"):
    """A loader for :func:`make_inference_udf`: distance to every centroid,
    rounded to 9 places, nearest wins, ties to the lower label."""
    bc = spark.sparkContext.broadcast((list(labels), mat))

    def load():
        labs, m = bc.value
        labs = np.asarray(labs)

        def predict(x: np.ndarray) -> pd.DataFrame:
            if x.size == 0:
                return pd.DataFrame({"label": pd.Series([], dtype="int64"),
                                     "distance": pd.Series([], dtype="float64")})
            diff = x[:, None, :] - m[None, :, :]
            d = (diff * diff).sum(axis=2) if metric == "l2" else np.abs(diff).sum(axis=2)
            d = np.round(d, 9)
            best = d.argmin(axis=1)
            return pd.DataFrame({"label": labs[best].astype("int64"),
                                 "distance": d[np.arange(len(best)), best]})
        return predict

    return load


def centroid_predict(df: DataFrame, vec: str, label: str, metric: str = "l2",
                     batch_size: int = 64, model: tuple | None = None) -> DataFrame:
    """INF-01: add ``prediction`` struct ``(label, distance)``; the centroids
    are fitted on ``df`` unless a fitted ``model = (labels, matrix)`` is given."""
    labels, mat = model if model is not None else centroid_matrix(fit_centroids(df, vec, label), label)
    udf = make_inference_udf(nearest_centroid_loader(df.sparkSession, labels, mat, metric),
                             "label long, distance double", batch_size)
    return df.withColumn("prediction", udf(F.col(vec)))


# --- image size from bytes (UDF-03, INF-03) ----------------------------------

# The JPEG markers that begin a frame header (all of C0..CF but C4, C8 and CC).
JPEG_FRAMES = (0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF)
_NETPBM = re.compile(rb"P[1-6](?:\s+|\s*#[^\n]*\n)+(\d+)(?:\s+|\s*#[^\n]*\n)+(\d+)\s")


def size_from_header(b: bytes | None) -> tuple[int | None, int | None]:
    """Width and height from the header of a PNG, JPEG, GIF or PBM/PGM/PPM image; ``(None, None)`` for other bytes."""
    if not b:
        return None, None
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return int.from_bytes(b[16:20], "big"), int.from_bytes(b[20:24], "big")
    if b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
        return int.from_bytes(b[6:8], "little"), int.from_bytes(b[8:10], "little")
    if m := _NETPBM.match(b[:256]):
        return int(m[1]), int(m[2])
    if b[:2] == b"\xff\xd8":  # segments one after another up to the frame header
        at = 2
        while at + 9 <= len(b) and b[at] == 0xFF:
            kind = b[at + 1]
            if kind in JPEG_FRAMES:
                return int.from_bytes(b[at + 7:at + 9], "big"), int.from_bytes(b[at + 5:at + 7], "big")
            # fill bytes and markers without a length
            at += 1 if kind == 0xFF else 2 if kind == 0x01 or 0xD0 <= kind <= 0xD8 else 2 + int.from_bytes(b[at + 2:at + 4], "big")
    return None, None


@F.pandas_udf(StructType([StructField("width", IntegerType()), StructField("height", IntegerType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    """UDF-03: width and height from the bytes of image files (no image
    library is needed for the header); null for other bytes."""
    sizes = [size_from_header(b) for b in content]
    return pd.DataFrame(sizes, columns=["width", "height"]).astype("Int32")
