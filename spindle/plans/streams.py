"""Queries: Structured Streaming jobs and file-layout sources/sinks.

Each stream job derives its input from the given tables (messages are
written by a distributed ``to_json`` sink, files by a partitioned write),
runs with an ``availableNow`` trigger and an explicit checkpoint under the
shared folder, and returns the read-back of its sink.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ..functions import label_from_path, lookup
from ..operators.clean import clean
from ..operators.inference import CLASS_NAMES
from ..operators.features import index_to_string
from ..operators.models import logistic_regression, persist, train_pipelines, unpersist
from ..operators.split import hash_split
from ..session import scratch_path
from ..sinks.writers import to_messages, write_messages, write_partitioned
from ..sources.readers import load_model, read_binary_files, read_table
from ..streaming.jobs import (decode_messages, dedup_stream, event_time_span, file_arrivals, message_stream,
                              per_file_line_counts, progress_durations, run_available_now,
                              run_foreach_batch, scoring_batch_writer)
from .ml import EVENTS_LABEL, EVENTS_SPEC, event_feature_stages, events_as_citations
from .registry import query

_EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def _publish_events_twice(spark, ev, topic_dir):
    """Publish every event, then (a later batch) every click event again:
    the second batch holds only duplicates of keys already seen."""
    write_messages(ev, topic_dir, "events", key="event_id")
    yield
    write_messages(ev.where(F.col("event_type") == "click"), topic_dir, "events", key="event_id")
    yield


def _dedup_job(spark, sf_dir, watermark: bool, max_files_per_trigger: int | None = None):
    ev = read_table(spark, sf_dir, "events", spread_input=True)  # JSON encode/decode is CPU work
    # the topic is written in no order of time, so only its whole span loses no row
    delay = event_time_span(ev, "ts") if watermark else None
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "dedup-out", "dedup-ckpt"))
    for _ in _publish_events_twice(spark, ev, topic):
        rows, _quarantine = decode_messages(message_stream(spark, topic, max_files_per_trigger=max_files_per_trigger), _EVENT_SCHEMA)
        if watermark:
            rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
            deduped = dedup_stream(rows, ["event_id"], event_time="ts", delay=delay)
        else:
            deduped = dedup_stream(rows, ["event_id"])
        # One run per published batch; the second run resumes from the
        # checkpoint and sees only the new files.
        run_available_now(deduped, sink, ckpt)
    out = spark.read.parquet(sink)
    return out.select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"))


_EVENTS_TWIN = "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events"


@query("stream_dedup", "STR-02 STR-01 STR-07 STR-08 SNK-03 SRC-08", _EVENTS_TWIN)
def stream_dedup(spark, sf_dir):
    """Exact stream dedup (the original semantics: state keeps every key)."""
    return _dedup_job(spark, sf_dir, watermark=False)


@query("stream_dedup_watermark", "STR-02", _EVENTS_TWIN)
def stream_dedup_watermark(spark, sf_dir):
    """Bounded-state dedup: duplicates within the watermark delay are
    dropped by state, older ones as late rows."""
    return _dedup_job(spark, sf_dir, watermark=True)


@query("stream_quarantine", "STR-01 STR-07 SNK-03 SRC-08", """
SELECT event_id, 'not json' AS reason FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'not utf-8' AS reason FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, 'decoded' AS reason FROM events
""")
def stream_quarantine(spark, sf_dir):
    """Every event is published whole; every click again as a cut object or a
    JSON array, every purchase again with a byte that UTF-8 does not know.
    The decoded rows and the quarantine are two tables of one topic."""
    ev = read_table(spark, sf_dir, "events", spread_input=True)
    root = scratch_path(spark, "quarantine")
    good = to_messages(ev, "events", key="event_id")
    number = F.col("event_id").cast("string")
    cut = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("[{\"event_id\":"), number, F.lit("}]"))) \
        .otherwise(F.concat(F.lit("{\"event_id\":"), number))
    odd_byte = F.concat(number.cast("binary"), F.unhex(F.lit("FF")))
    value = F.when(F.col("event_type") == "click", cut.cast("binary")).otherwise(odd_byte)
    bad = (ev.where(F.col("event_type").isin("click", "purchase"))
           .select(number.cast("binary").alias("key"), value.alias("value"), F.lit("events").alias("topic")))
    good.unionByName(bad).write.parquet(f"{root}/topic")
    rows, quarantine = decode_messages(message_stream(spark, f"{root}/topic"), _EVENT_SCHEMA)
    run_available_now(rows.select("event_id"), f"{root}/rows", f"{root}/ckpt-rows")
    run_available_now(quarantine, f"{root}/bad", f"{root}/ckpt-bad")
    kept = spark.read.parquet(f"{root}/rows").select("event_id", F.lit("decoded").alias("reason"))
    raw = F.regexp_extract(F.regexp_replace(F.hex("raw"), "3([0-9])|..", "$1"), "([0-9]+)", 1)
    return kept.unionByName(spark.read.parquet(f"{root}/bad").select(raw.cast("bigint").alias("event_id"), "reason"))


_CITATION_SCHEMA = ("`Summons Number` bigint, `Issue Date` string, `Violation Time` string, "
                    "user_id double, value double, prop_k string, event_type string")


@query("stream_clean", "STR-03 STR-01 SCL-01 SCL-02 SCL-03 FLT-02 NUL-01 DED-01", """
SELECT user_id::DOUBLE AS user_id, round(value, 6) AS value,
       coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)::VARCHAR, '0') AS prop_k,
       event_type,
       dayofweek(ts) + 1 AS "Issue Day", month(ts) AS "Issue Month", year(ts) AS "Issue Year",
       CASE WHEN hr IN ('00','01','02','03','12') AND p = 'A' THEN 1
            WHEN hr IN ('04','05','06','07') AND p = 'A' THEN 2
            WHEN hr IN ('08','09','10','11') AND p = 'A' THEN 3
            WHEN hr IN ('12','00','01','02','03') AND p = 'P' THEN 4
            WHEN hr IN ('04','05','06','07') AND p = 'P' THEN 5
            WHEN hr IN ('08','09','10','11') AND p = 'P' THEN 6
            ELSE 3 END::BIGINT AS "Time bin"
FROM (SELECT *, strftime(ts, '%I') AS hr, left(strftime(ts, '%p'), 1) AS p FROM events) e
WHERE year(ts) > 2023 AND year(ts) < 2025
""")
def stream_clean(spark, sf_dir):
    """The shared ``clean`` on a stream of citation-shaped messages: the
    same function the batch training uses (STR-03)."""
    ev = read_table(spark, sf_dir, "events", spread_input=True)
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("cit-topic", "clean-out", "clean-ckpt"))
    write_messages(events_as_citations(ev), topic, "citations", key="Summons Number")
    rows, _ = decode_messages(message_stream(spark, topic), _CITATION_SCHEMA)
    run_available_now(clean(rows, EVENTS_SPEC), sink, ckpt)
    out = spark.read.parquet(sink)
    return out.select("user_id", F.round("value", 6).alias("value"), "prop_k", "event_type",
                      *[F.col(c).cast("bigint").alias(c)
                        for c in ["Issue Day", "Issue Month", "Issue Year", "Time bin"]])


def _score_job(spark, sf_dir) -> str:
    """Train and save a pipeline on the batch table, then score a message stream
    of several batches with the loaded model: one deduplication, one callback
    per batch.  Returns the folder of its tables: predictions, metrics,
    quarantine (labels the model never saw), durations."""
    ev = read_table(spark, sf_dir, "events")
    cit = events_as_citations(ev)
    batch = clean(cit, EVENTS_SPEC)
    train, _ = hash_split(batch, "user_id", 80)
    label_model = StringIndexer(inputCol=EVENTS_LABEL, outputCol="label").fit(train)
    root = scratch_path(spark, "stream-score")
    to_text = index_to_string("prediction", "predictedLabel", label_model.labels)
    train, = persist(train)
    train_pipelines(event_feature_stages(batch, label_model), {"lr": logistic_regression()},
                    train, post_stages=[to_text], save_root=f"{root}/models")
    unpersist(train)
    model = load_model(f"{root}/models/lr")

    topic = f"{root}/topic"
    write = scoring_batch_writer(model, f"{root}/out", EVENTS_LABEL, label_model.labels)
    progress = []
    for part in range(3):  # published in three parts; each run resumes from the checkpoint
        write_messages(cit.where(F.coalesce(F.pmod("Summons Number", F.lit(3)), F.lit(0)) == part), topic, "citations", key="Summons Number")
        rows, _ = decode_messages(message_stream(spark, topic, max_files_per_trigger=64), _CITATION_SCHEMA)
        progress += run_foreach_batch(clean(rows, EVENTS_SPEC), write, f"{root}/ckpt")
    # one row per batch
    spark.createDataFrame(progress_durations(progress), "batch_id long, rows long, trigger_ms long") \
        .write.parquet(f"{root}/out/durations")
    return f"{root}/out"


@query("stream_score", "STR-04 STR-05 STR-06 SNK-04 SNK-05 UDF-07 PRJ-07 SRC-13 SNK-07")
def stream_score(spark, sf_dir):
    """Metrics and times of every batch of the scored stream."""
    out = _score_job(spark, sf_dir)
    metrics = spark.read.parquet(f"{out}/metrics").drop("rows", "trigger_ms")
    return metrics.join(spark.read.parquet(f"{out}/durations"), "batch_id", "left")


@query("stream_score_labels", "STR-04 STR-05 SNK-04 SNK-05 UDF-07 FEA-03", """
SELECT event_type, count(*) AS n, count(*) AS n_named, CAST(sum(count(*)) OVER () AS BIGINT) AS n_in_metrics
FROM events WHERE year(ts) > 2023 AND year(ts) < 2025 GROUP BY event_type
""")
def stream_score_labels(spark, sf_dir):
    """Predictions of each true label over all batches, those whose predicted
    text is one of the labels, and the rows that the batches' metrics count."""
    out = _score_job(spark, sf_dir)
    done = spark.read.parquet(f"{out}/predictions")
    labels = done.select(F.col(EVENTS_LABEL).alias("predictedLabel")).distinct().withColumn("_named", F.lit(1))
    total = spark.read.parquet(f"{out}/metrics").agg(F.sum("n")).scalar()
    return (done.join(labels, "predictedLabel", "left").groupBy(EVENTS_LABEL)
            .agg(F.count(F.lit(1)).alias("n"), F.count("_named").alias("n_named"))
            .withColumn("n_in_metrics", total))


@query("arrival_line_counts", "SRC-09 STR-09 SRC-03 SCL-09 SNK-02", """
SELECT source, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_lines
FROM documents GROUP BY source
""")
def arrival_line_counts(spark, sf_dir):
    """Documents land as text files (one folder per source); a file stream
    counts the lines of each file as it arrives.  Each document ends in a line
    break, so the text after a file's last one is empty and is not counted in
    the totals per source."""
    docs = read_table(spark, sf_dir, "documents").select("source", "text")
    root = scratch_path(spark, "arrivals")
    docs.write.mode("overwrite").partitionBy("source").text(f"{root}/landing")
    lines = file_arrivals(spark, f"{root}/landing", max_files_per_trigger=8)
    run_foreach_batch(lines, per_file_line_counts(f"{root}/counts"), f"{root}/ckpt")
    per_file = spark.read.parquet(f"{root}/counts")
    return (per_file.select(F.regexp_extract("path", "source=([^/]+)", 1).alias("source"), "n_lines")
            .groupBy("source").agg(F.sum(F.col("n_lines") - 1).alias("n_lines")))


_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in CLASS_NAMES) + "]"


@query("partitioned_by_label", "SNK-06 SCL-17", f"""
SELECT {_NAMES_SQL}[label + 1] AS label_name, count(*) AS n FROM embeddings GROUP BY 1
""")
def partitioned_by_label(spark, sf_dir):
    """Vectors written one folder per class name; read back with partition
    discovery and counted per class (a pruned read per class is free)."""
    e = read_table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "by-label")
    write_partitioned(e.withColumn("label_name", lookup("label", CLASS_NAMES)), path, ["label_name"])
    back = spark.read.parquet(path)
    return back.groupBy("label_name").agg(F.count(F.lit(1)).alias("n"))


@query("binary_listing", "SRC-10 SCL-13", f"""
SELECT DISTINCT {_NAMES_SQL}[label + 1] AS label, true AS whole FROM embeddings
""")
def binary_listing(spark, sf_dir):
    """Files of a label-per-folder layout read with the binary-file source
    (recursive, glob-filtered): the label comes from the path; ``whole`` says that
    every content has its listed length, a time, and a Parquet file's marks at both ends."""
    e = read_table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "image-layout")
    write_partitioned(e.withColumn("label_name", lookup("label", CLASS_NAMES)), path, ["label_name"])
    files = read_binary_files(spark, path, glob="*.parquet", recursive=True, with_content=True)
    mark = F.lit("PAR1").cast("binary")
    whole = ((F.octet_length("content") == F.col("length")) & F.col("modificationTime").isNotNull()
             & (F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark))
    return (files.select(label_from_path("path", "label_name=([^/]+)/").alias("label"), whole.alias("whole"))
            .groupBy("label").agg(F.every("whole").alias("whole")))
