"""Metrics of a micro-batch taken while it is written (STR-05, STR-06).

The counts per class are observed by the very job that writes the batch's
predictions, so a batch is read and scored once and nothing is persisted.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MAX_CLASSES = 1000  # three counts of each are observed


def class_counts(label: str, prediction: str, classes: Sequence) -> list[Column]:
    """Aggregates of one row: ``n``, and per class (by its position) the rows that
    have it (``support_i``), that are predicted so (``predicted_i``) and both (``right_i``)."""
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{len(classes)} classes, at most {MAX_CLASSES} can be observed")
    out = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(classes):
        true, said = F.col(label) == F.lit(c), F.col(prediction) == F.lit(c)
        out += [F.count_if(true).alias(f"support_{i}"), F.count_if(said).alias(f"predicted_{i}"), F.count_if(true & said).alias(f"right_{i}")]
    return out


def scores_of(counts: dict, n_classes: int) -> tuple[int, float | None, float | None]:
    """``n_right``, accuracy and weighted F1 out of observed counts.  Rows whose label
    is null or no class are in ``n`` and count as wrong; without rows both scores are null."""
    n, right = counts["n"], sum(counts[f"right_{i}"] for i in range(n_classes))
    if not n:
        return 0, None, None
    weighted = 0.0
    for i in range(n_classes):
        support, predicted, hit = (counts[f"{k}_{i}"] for k in ("support", "predicted", "right"))
        weighted += support * 2.0 * hit / (support + predicted) if hit else 0.0
    return right, right / n, weighted / n


def observed_batch_writer(out_root: str, classes: Sequence, label: str = "label", prediction: str = "prediction",
                          also: Sequence[Column] = ()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: writes each batch below ``predictions`` and one row
    ``batch_id, n, n_right, accuracy, f1, write_ms`` below ``metrics``; ``also`` are
    further aggregates (with aliases) for that row.

    Each batch overwrites its own folders, so a replayed one replaces its rows, and
    the row of every batch is kept, however many there are (a query's progress
    keeps the last 100).  No shuffle stands between the observed rows and the write:
    a task that is tried again counts once, as only its successful end is taken over."""
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        began = time.perf_counter()
        (batch.observe(seen, *class_counts(label, prediction, classes), *also)
         .write.mode("overwrite").parquet(f"{out_root}/predictions/batch_id={batch_id}"))
        took = (time.perf_counter() - began) * 1000.0
        counts = seen.get
        right, accuracy, f1 = scores_of(counts, len(classes))
        row = {"batch_id": F.lit(batch_id).cast("long"), "n": F.lit(counts["n"]).cast("long"), "n_right": F.lit(right).cast("long"),
               "accuracy": F.lit(accuracy).cast("double"), "f1": F.lit(f1).cast("double"), "write_ms": F.lit(took)}
        known = {"n", *(f"{k}_{i}" for k in ("support", "predicted", "right") for i in range(len(classes)))}
        row |= {k: F.lit(v) for k, v in counts.items() if k not in known}
        (batch.sparkSession.range(1, numPartitions=1).select(*[v.alias(k) for k, v in row.items()])
         .write.mode("overwrite").parquet(f"{out_root}/metrics/batch_id={batch_id}"))

    return write
