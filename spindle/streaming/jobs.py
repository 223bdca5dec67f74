"""Structured Streaming jobs (STR-01..STR-09, SRC-08/09, SNK-03/04/05).

* Messages come from Kafka when the connector is on the classpath, else from
  a folder of Kafka-shaped message files (``key, value, topic, ...``); the
  transformations after the source are identical.
* Every query has an explicit checkpoint under the shared folder, so a
  restarted or re-run query resumes from its offsets and emits nothing twice.
* ``foreachBatch`` sinks are idempotent: each batch overwrites only its own
  ``batch_id=`` folder, so a replayed batch replaces instead of duplicating.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.structured import is_malformed_json, parse_json
from ..functions.text import utf8_text
from ..operators.metrics import accuracy_f1
from ..sinks.writers import MESSAGE_SCHEMA


def message_stream(spark: SparkSession, source: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None, options: dict | None = None,
                   max_messages_per_trigger: int | None = None) -> DataFrame:
    """SRC-08: a stream of Kafka-shaped messages.  ``fmt="kafka"`` reads a
    topic (``source`` = topic, ``options`` = ``kafka.bootstrap.servers``...);
    any file format reads a folder of message files.  A batch takes at most
    ``max_files_per_trigger`` files, or ``max_messages_per_trigger`` messages of a
    topic; neither stands for the other."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").options(**(options or {})).option("subscribe", source)
        if max_messages_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_messages_per_trigger)
        return reader.load()
    reader = spark.readStream.format(fmt).schema(MESSAGE_SCHEMA if fmt == "parquet"
                                                 else "key binary, value binary, topic string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.options(**(options or {})).load(source)


def decode_messages(msgs: DataFrame, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """STR-01: bytes -> UTF-8 -> JSON -> columns.  Returns ``(rows,
    quarantine)``: messages that are not valid UTF-8 or not a JSON object go to
    the quarantine frame with their raw bytes instead of failing the query."""
    text = utf8_text("value")
    tagged = msgs.select("value", text.alias("_text"))
    bad = F.col("_text").isNull() | is_malformed_json("_text") | ~F.coalesce(F.ltrim("_text").startswith("{"), F.lit(False))
    rows = tagged.where(~bad).select(parse_json("_text", schema).alias("_data")).select("_data.*")
    quarantine = tagged.where(bad).select(F.col("value").alias("raw"),
                                          F.when(F.col("_text").isNull(), "not utf-8")
                                          .otherwise("not json").alias("reason"))
    return rows, quarantine


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """STR-02: exact dedup (state grows with the number of keys, as in the
    original job) or, with ``event_time`` + ``delay``, dedup whose state is
    dropped once the watermark passes.  Rows that come later than ``delay`` after
    the newest event are dropped with it, so ``delay`` must cover the disorder of
    the topic (:func:`event_time_span` gives a bound for a topic at hand)."""
    if event_time:
        return df.withWatermark(event_time, delay or "1 hour").dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def event_time_span(df: DataFrame, event_time: str) -> str:
    """A delay that no row of ``df`` (a batch frame) exceeds: its event-time span."""
    row = df.agg(F.min(event_time).alias("lo"), F.max(event_time).alias("hi")).first()
    seconds = (row["hi"] - row["lo"]).total_seconds() if row["lo"] is not None else 0
    return f"{int(seconds) + 1} seconds"


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append", partition_by: Sequence[str] = (),
                      state_partitions: int | None = None) -> list:
    """STR-07: process everything available, then stop; the checkpoint makes
    a re-run continue where the previous one ended (STR-08).  ``state_partitions``
    is the number of partitions that state has from a checkpoint's first run on
    (default: the session's shuffle partitions); every one costs a task a batch."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    w = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        q = w.start(sink)
        q.awaitTermination()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
    return q.recentProgress


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> list:
    """SNK-04 / UDF-07: a per-batch callback under an availableNow trigger."""
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q.recentProgress


def metrics_batch_writer(out_root: str, label: str = "label", prediction: str = "prediction",
                         keep: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """STR-05/06 + SNK-05: for each micro-batch, write its predictions and
    one metrics row ``(batch_id, n, accuracy, accuracy_pct, f1,
    compute_ms)`` as tables.  The batch is persisted once, so the metrics
    and the predictions do not recompute it; an empty batch gives ``n = 0``
    and null metrics."""
    from pyspark import StorageLevel

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            t0 = time.perf_counter()
            m = accuracy_f1(batch, label, prediction)
            row = m.first()
            compute_ms = (time.perf_counter() - t0) * 1000.0
            (batch.select(*keep, label, prediction).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{out_root}/predictions/batch_id={batch_id}"))
            spark = batch.sparkSession
            metrics = spark.createDataFrame(
                [(batch_id, row["n"], row["accuracy"],
                  None if row["accuracy"] is None else row["accuracy"] * 100.0, row["f1"], compute_ms)],
                "batch_id long, n long, accuracy double, accuracy_pct double, f1 double, compute_ms double")
            metrics.write.mode("overwrite").parquet(f"{out_root}/metrics/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def scoring_batch_writer(model, out_root: str, label_text: str, known: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """STR-04/05/06: score each micro-batch once and write its predictions (with
    the predicted label's text), its metrics, and, as quarantine, the rows whose
    label is null or not among ``known``, the labels the model was fitted on."""
    from pyspark import StorageLevel
    write_scored = metrics_batch_writer(out_root, keep=[label_text, "predictedLabel"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = F.coalesce(F.col(label_text).isin(list(known)), F.lit(False))
            batch.where(~seen).write.mode("overwrite").parquet(f"{out_root}/quarantine/batch_id={batch_id}")
            write_scored(model.transform(batch.where(seen)), batch_id)
        finally:
            batch.unpersist()

    return write


def per_file_line_counts(out_root: str) -> Callable[[DataFrame, int], None]:
    """STR-09 / SRC-09: into how many parts the line breaks split every file that
    arrived in the batch (a file is read whole within one micro-batch, so each
    count is final).  A break at the end is followed by an empty part; whether
    there is one shows in the file's size against its lines' (a byte order mark
    is 3 bytes of it).  Spark's readers leave out files of no bytes."""
    def write(batch: DataFrame, batch_id: int) -> None:
        n = F.count(F.lit(1))
        beside = F.max("file_size") - F.sum(F.octet_length("value")) - (n - 1)
        (batch.groupBy("path").agg((n + F.when(beside % 3 == 1, 1).otherwise(0)).alias("n_lines"))
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{out_root}/batch_id={batch_id}"))
    return write


def file_arrivals(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                  line_sep: str = "\n", archive_dir: str | None = None) -> DataFrame:
    """SRC-09: a stream of the lines of files landing in ``folder`` (each
    file once, tracked by the checkpoint), tagged with the file's path and size.
    For a long-running landing zone pass ``archive_dir``: processed files are
    moved there (``cleanSource=archive``), so listing the folder stays cheap
    however many files have arrived."""
    r = spark.readStream.format("text").option("lineSep", line_sep)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(folder).select(F.col("_metadata.file_path").alias("path"), "value",
                                 F.col("_metadata.file_size").alias("file_size"))


def progress_durations(progress: list) -> list[dict]:
    """STR-06: per-batch durations from ``StreamingQueryProgress``."""
    def get(p, k):
        return getattr(p, k) if hasattr(p, k) else p[k]
    return [{"batch_id": get(p, "batchId"), "rows": get(p, "numInputRows"),
             "trigger_ms": get(p, "durationMs").get("triggerExecution")} for p in progress]
