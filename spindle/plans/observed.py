"""Queries: streams whose batches are measured while they are written, and a stream that cleaning thins out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import row_to_json
from ..operators.clean import PARKING_SPEC, clean
from ..session import scratch_path
from ..sinks.writers import to_messages
from ..sources.citations import CITATION_SCHEMA
from ..sources.readers import read_table
from ..streaming.jobs import decode_messages, message_stream, run_available_now, run_foreach_batch
from ..streaming.observed import observed_batch_writer
from .dirty import CLEANED_SQL, dirty_rows
from .registry import query

PARTS = 104  # more than the batches that a query's progress keeps


@query("batch_metrics_observed", "STR-05 STR-06 STR-04 SNK-04 UDF-07 PRJ-07 MLT-07 MLT-08", f"""
WITH m AS (SELECT event_type AS said, round(avg(value), 6) AS mu FROM events GROUP BY 1),
p AS (SELECT event_id, event_id % {PARTS} AS part, event_type, said,
             row_number() OVER (PARTITION BY event_id ORDER BY abs(value - mu), said) AS place FROM events, m),
s AS (SELECT part, event_type AS c, count(*) AS support, count(*) FILTER (said = event_type) AS hit FROM p WHERE place = 1 GROUP BY ALL),
q AS (SELECT part, said AS c, count(*) AS predicted FROM p WHERE place = 1 GROUP BY ALL)
SELECT part, CAST(sum(support) AS BIGINT) AS n, CAST(sum(hit) AS BIGINT) AS n_right, round(sum(hit) / sum(support), 9) AS accuracy,
       round(sum(support * CASE WHEN hit > 0 THEN 2.0 * hit / (support + predicted) ELSE 0.0 END) / sum(support), 9) AS f1, true AS timed
FROM s LEFT JOIN q USING (part, c) GROUP BY part
""")
def batch_metrics_observed(spark, sf_dir):
    """Events published in parts, each scored as one batch by the class of nearest
    mean value: rows, accuracy, F1 and time of every batch."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    means = ev.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mu")).orderBy("event_type")
    model = [(r.event_type, r.mu) for r in means.collect()]
    root = scratch_path(spark, "observed")
    part = F.pmod("event_id", F.lit(PARTS)).alias("part")
    # one file a part, so that a trigger that takes one file takes one part
    (to_messages(ev, "events", key="event_id").withColumn("part", F.pmod(F.col("key").cast("string").cast("bigint"), F.lit(PARTS)))
     .repartition("part").write.partitionBy("part").parquet(f"{root}/topic"))
    rows, _ = decode_messages(message_stream(spark, f"{root}/topic", max_files_per_trigger=1), "event_id bigint, event_type string, value double")
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col("value") - F.lit(mu)).alias("far"), F.lit(said).alias("said")) for said, mu in model]))["said"]
    scored = rows.select("event_id", "event_type", nearest.alias("said"))
    write = observed_batch_writer(f"{root}/out", [said for said, _ in model], "event_type", "said", also=[F.min(part).alias("part")])
    run_foreach_batch(scored, write, f"{root}/checkpoint")
    done = spark.read.parquet(f"{root}/out/metrics")
    return done.select("part", "n", "n_right", F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1"), (F.col("write_ms") > 0).alias("timed"))


@query("stream_citations", "STR-03 STR-01 STR-02 STR-07 STR-08 DED-01 FLT-02 NUL-01", CLEANED_SQL)
def stream_citations(spark, sf_dir):
    """Dirty citations as messages, cleaned on the stream under the schema that the batch
    has: cut messages, copies (of which a tenth comes in a later run), bad dates and
    other years go, defaults come in."""
    root = scratch_path(spark, "citations")
    rows = dirty_rows(read_table(spark, sf_dir, "orders"))
    typed = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CITATION_SCHEMA], (F.col("Violation Code") == "twelve").alias("_cut"))
    value = F.when(F.col("_cut"), F.concat(F.lit('{"Summons Number":'), F.col("Summons Number").cast("string"))).otherwise(row_to_json(*CITATION_SCHEMA.names))
    messages = typed.select(F.col("Summons Number").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("citations").alias("topic"))
    for published in (messages, messages.where(F.col("key").cast("string").cast("bigint") % 10 == 0)):
        published.write.mode("append").parquet(f"{root}/topic")
        decoded, _ = decode_messages(message_stream(spark, f"{root}/topic"), CITATION_SCHEMA)
        run_available_now(clean(decoded, PARKING_SPEC), f"{root}/rows", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/rows")
    return out.select(*[F.col(c).cast("bigint").alias(c) if t in ("int", "bigint") else F.col(c) for c, t in out.dtypes])
