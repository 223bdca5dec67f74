"""Sinks (SNK-01..SNK-09).

Writes are distributed (one file per task) and replace old output with
``mode("overwrite")`` on any file system; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.structured import row_to_json

MESSAGE_SCHEMA = ("key binary, value binary, topic string, partition int, "
                  "offset long, timestamp timestamp")


def write_text(df: DataFrame, path: str, col: str | None = None, single_file: bool = False) -> str:
    """SNK-01 / SNK-02: one text line per row.  ``single_file`` coalesces to
    one task and is meant for small, already-aggregated results only."""
    out = df.select(F.col(col).cast("string") if col else
                    F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)
    return path


def to_messages(df: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """SNK-03 (distributed ``toJSON``): each row becomes a Kafka-shaped
    message whose ``value`` is the row as UTF-8 JSON (null fields omitted)."""
    k = F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return df.select(k.alias("key"), row_to_json(*df.columns).cast("binary").alias("value"),
                     F.lit(topic).alias("topic"))


def write_messages(df: DataFrame, path: str, topic: str, key: str | None = None,
                   fmt: str = "parquet", options: dict | None = None) -> str:
    """SNK-03: publish rows as JSON messages.  With the Kafka connector on
    the classpath use ``fmt="kafka"`` and ``kafka.bootstrap.servers``;
    otherwise messages land as files that a file stream can consume."""
    msgs = to_messages(df, topic, key)
    if fmt == "kafka":
        msgs.write.format("kafka").options(**(options or {})).option("topic", topic).save()
    else:
        msgs.write.mode("append").format(fmt).options(**(options or {})).save(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> str:
    """SNK-06: one directory per label value (``by=label/...``); readers
    get partition pruning on the label for free.  Rows are rebalanced by the
    label first: few files a label, and a label with many rows is split."""
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").partitionBy(*by).format(fmt).save(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """SNK-05: a predictions/metrics table instead of console output."""
    df.write.mode(mode).format(fmt).save(path)
    return path


def save_model(model, path: str) -> str:
    """SNK-07."""
    model.write().overwrite().save(path)
    return path
