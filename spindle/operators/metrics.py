"""Classification metrics as aggregates (MLT-07, MLT-08, STR-05).

One pass emits two records per prediction (one for its true class, one for
its predicted class); a per-class aggregate gives support, predicted count
and true positives, and a final one-row aggregate gives accuracy and the
support-weighted F1 (the evaluator's ``f1``).  Both stages combine
partially, so nothing depends on the number of rows per class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_class_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    lab, pred = F.col(label).cast("double"), F.col(prediction).cast("double")
    hit = (lab == pred).cast("long")
    two = F.array(F.struct(lab.alias("cls"), F.lit(1).cast("long").alias("t"),
                           F.lit(0).cast("long").alias("p"), hit.alias("tp")),
                  F.struct(pred.alias("cls"), F.lit(0).cast("long").alias("t"),
                           F.lit(1).cast("long").alias("p"), F.lit(0).cast("long").alias("tp")))
    return (df.select(F.inline(two))
            .groupBy("cls").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"),
                                F.sum("tp").alias("tp")))


def accuracy_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``n``, ``accuracy`` (fraction), ``f1`` (weighted).  An empty
    input gives ``n = 0`` and null metrics."""
    pc = per_class_counts(df, label, prediction)
    f1_c = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("support") + F.col("predicted"))) \
        .otherwise(F.lit(0.0))
    n = F.sum("support")
    return pc.agg(n.alias("n"),
                  (F.sum("tp") / n).alias("accuracy"),
                  (F.sum(F.col("support") * f1_c) / n).alias("f1")).select(
        F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("n"), "accuracy", "f1")
