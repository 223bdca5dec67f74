"""Queries: objects that arrive, files of one row each, and messages that come late."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.inference import image_size
from ..session import scratch_path, ship_package
from ..sinks.writers import write_messages
from ..sources.objects import object_arrivals, write_objects
from ..sources.readers import read_binary_files, read_table
from ..streaming.jobs import decode_messages, message_stream, run_available_now
from ..streaming.stateful import dedup_with_late_rows
from .registry import query

SLICES, LAG = 6, 3
MESSAGES_A_FILE = 200_000

_ARRIVALS = f"""
t AS (SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms FROM events),
r AS (SELECT min(ms) AS lo, max(ms) - min(ms) + 1 AS span FROM t),
s AS (SELECT t.*, CAST((ms - lo) * {SLICES} // span AS INTEGER) AS slice FROM t, r),
arrived AS (SELECT *, slice + CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN {LAG} ELSE 0 END AS batch FROM s
  UNION ALL SELECT *, slice + 1 AS batch FROM s WHERE event_type = 'click'
  UNION ALL SELECT *, slice + {LAG} AS batch FROM s WHERE event_type = 'purchase')"""


@query("stream_dedup_late", "STR-02 STR-01 STR-07 SRC-08 SNK-03", f"""
WITH {_ARRIVALS},
b AS (SELECT batch, max(ms) AS top FROM arrived GROUP BY batch),
w AS (SELECT batch, greatest(coalesce(max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - (SELECT span // 4 FROM r), 0), 0) AS mark FROM b),
m AS (SELECT event_id, batch, mark, ms < mark AS late FROM arrived JOIN w USING (batch)),
f AS (SELECT *, row_number() OVER (PARTITION BY event_id, late ORDER BY batch) AS n FROM m)
SELECT event_id, CASE WHEN late THEN 'late' WHEN n = 1 THEN 'kept' ELSE 'duplicate' END AS outcome, CAST(mark AS BIGINT) AS watermark_ms FROM f
""")
def stream_dedup_late(spark, sf_dir):
    """Events published slice by slice of their time: clicks come again one slice
    later, purchases and a fifth of the errors' only copies three slices later.
    One run takes every publication as a batch of its own; each row comes out as
    kept, duplicate or late."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    lo, hi, n = ev.agg(F.min(ms), F.max(ms), F.count(F.lit(1))).first()
    span = (hi or 0) - (lo or 0) + 1
    rows = ev.withColumn("slice", F.floor((ms - F.lit(lo)) * SLICES / span).cast("int"))
    held_back = (F.col("event_type") == "error") & (F.col("event_id") % 5 == 0)
    arrived = (rows.withColumn("batch", F.col("slice") + F.when(held_back, LAG).otherwise(0))
               .unionByName(rows.where("event_type = 'click'").withColumn("batch", F.col("slice") + 1))
               .unionByName(rows.where("event_type = 'purchase'").withColumn("batch", F.col("slice") + LAG)))
    root = scratch_path(spark, "dedup-late")
    arrived.drop("slice").write.partitionBy("batch").parquet(f"{root}/arrived")
    # every publication has as many files, so that a trigger takes one publication
    files = max(1, n // MESSAGES_A_FILE)
    for b in range(SLICES + LAG):
        batch = spark.read.parquet(f"{root}/arrived").where(F.col("batch") == b).drop("batch")
        write_messages(batch.repartition(files) if files > 1 else batch.coalesce(1), f"{root}/topic", "events", key="event_id")
    messages, _ = decode_messages(message_stream(spark, f"{root}/topic", max_files_per_trigger=files), "event_id bigint, event_type string, ts timestamp_ntz")
    marked = dedup_with_late_rows(messages, ["event_id"], "ts", f"{span // 4} milliseconds", slot_ms=max(1, span // 16), buckets=8)
    run_available_now(marked, f"{root}/rows", f"{root}/checkpoint", partition_by=["outcome"], state_partitions=2 * files)
    return spark.read.parquet(f"{root}/rows").select("event_id", "outcome", "watermark_ms")


@query("object_line_counts", "SRC-09 STR-08 STR-09 SCL-09 SNK-06", """
SELECT lang AS label, doc_id, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines FROM documents
UNION ALL SELECT lang AS label, -doc_id - 1 AS doc_id, 1 AS n_lines FROM documents WHERE doc_id % 7 = 0
""")
def object_line_counts(spark, sf_dir):
    """Every text is written as an object ``lang/id.txt``, and beside every seventh
    an empty object.  They arrive in two lots; the second run goes on after the
    first.  Lines are breaks plus one, also for an object of no bytes."""
    docs = read_table(spark, sf_dir, "documents", spread_input=True).select("doc_id", "lang", "text")
    empty = docs.where(F.col("doc_id") % 7 == 0).select((-F.col("doc_id") - 1).alias("doc_id"), "lang", F.lit("").alias("text"))
    root = scratch_path(spark, "objects")
    for lot in (docs.where("lang = 'en'").unionByName(empty), docs.where("lang <> 'en' OR lang IS NULL")):
        write_objects(lot, f"{root}/landing", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")), F.col("text"))
        text = F.col("content").cast("string")
        counted = object_arrivals(spark, f"{root}/landing", f"{root}/log", bytes_per_task=4 << 20).select("path", (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
        run_available_now(counted, f"{root}/counts", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/counts").select(*_name_parts(F.col("path"), "doc_id"), "n_lines")


def _name_parts(path, number: str):
    """Label and number out of ``.../label/number.ext``."""
    return (F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("label"),
            F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1).cast("bigint").alias(number))


@query("page_files", "SNK-06 SRC-10 SCL-13 SCL-14", """
SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS label, page_id, strlen(html) AS n_bytes, sha256(html) AS sha256 FROM pages
""")
def page_files(spark, sf_dir):
    """Every page as a file ``host/id.html``, read back as binary files."""
    pages = read_table(spark, sf_dir, "pages").withColumn("host", F.regexp_extract("url", "^https?://([^/]+)", 1))
    root = scratch_path(spark, "page-files")
    write_objects(pages, root, "host", F.concat(F.col("page_id").cast("string"), F.lit(".html")), F.col("html"))
    files = read_binary_files(spark, root, glob="*.html")
    return files.select(*_name_parts(F.col("path"), "page_id"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


IMAGE_WIDTH = 64


@query("image_sizes", "UDF-03 INF-03 SNK-06 SRC-10", f"""
WITH d AS (SELECT lang, doc_id, greatest(1, (strlen(text) + {IMAGE_WIDTH - 1}) // {IMAGE_WIDTH}) AS h FROM documents)
SELECT lang AS label, doc_id, {IMAGE_WIDTH} AS width, CAST(h AS INTEGER) AS height, CAST({IMAGE_WIDTH} * h + strlen('P5' || chr(10) || '{IMAGE_WIDTH} ' || h || chr(10) || '255' || chr(10)) AS BIGINT) AS n_bytes FROM d
""")
def image_sizes(spark, sf_dir):
    """Every text's bytes as a grey image of 64 columns and as many rows as it
    needs, one file ``lang/id.pgm`` each; sizes come from the files' bytes."""
    ship_package(spark)
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    height = F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / IMAGE_WIDTH)).cast("int")
    head = F.concat(F.lit(f"P5\n{IMAGE_WIDTH} "), height.cast("string"), F.lit("\n255\n")).cast("binary")
    pixels = F.concat(head, raw, F.repeat(F.lit(" "), height * IMAGE_WIDTH - F.octet_length(raw)).cast("binary"))
    root = scratch_path(spark, "images")
    docs = read_table(spark, sf_dir, "documents", spread_input=True)
    write_objects(docs, root, "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".pgm")), pixels)
    files = read_binary_files(spark, root, glob="*.pgm").select("path", "length", image_size("content").alias("size"))
    return files.select(*_name_parts(F.col("path"), "doc_id"), "size.width", "size.height", F.col("length").alias("n_bytes"))
