"""Queries: text, JSON messages, paths, arrays, batch inference, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (argmax, chw_to_hwc, file_name, file_stem, is_malformed_json,
                         label_from_path, lookup, normalise_channels, parse_json, utf8_text,
                         weighted_position_sum)
from ..operators.inference import CLASS_NAMES, centroid_matrix, centroid_predict, fit_centroids
from ..operators.metrics import accuracy_f1
from ..operators.profile import top_k_per_group
from ..operators.text import line_counts, words_per_line
from ..sinks.writers import to_messages
from ..sources.readers import read_table
from .registry import query

WORD_RE = r"'[\p{L}\p{N}_'']+'"
_NL = "(length(text) - length(replace(text, chr(10), '')))"
_TEXT_LINES = f"(CASE WHEN length(text) = 0 THEN 0 WHEN suffix(text, chr(10)) THEN {_NL} ELSE {_NL} + 1 END)"


@query("avg_words", "SCL-07 SCL-08 AGG-06 UDF-06", f"""
SELECT lang, CAST(sum(nl) AS BIGINT) AS n_lines, CAST(sum(nw) AS BIGINT) AS n_words,
       round(sum(nw) / sum(nl), 6) AS avg_words_per_line
FROM (SELECT lang, {_TEXT_LINES} AS nl, len(regexp_extract_all(text, {WORD_RE})) AS nw
      FROM documents) t
GROUP BY lang
""")
def avg_words(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", spread_input=True)
    return words_per_line(d, "text", by=["lang"]).withColumn(
        "avg_words_per_line", F.round("avg_words_per_line", 6))


@query("line_count", "SCL-09 AGG-05", f"""
SELECT doc_id, CAST({_NL} + 1 AS BIGINT) AS lines_split, CAST({_TEXT_LINES} AS BIGINT) AS lines_text
FROM documents
""")
def line_count(spark, sf_dir):
    return line_counts(read_table(spark, sf_dir, "documents", spread_input=True), "text", keep=["doc_id"])


@query("json_parse", "SCL-11 PRJ-02 PRJ-03", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       (props IS NOT NULL AND NOT json_valid(props)) AS malformed
FROM events
""")
def json_parse(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", parse_json("props", "k bigint").alias("data"),
                     is_malformed_json("props").alias("malformed")).select(
        "event_id", F.col("data.k").alias("k"), "malformed")


_EVENT_MSG_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                     "value double, props string")


@query("json_roundtrip", "SCL-12 SCL-10 SNK-03 STR-01 SNK-09", """
SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, round(value, 6) AS value, props
FROM events
""")
def json_roundtrip(spark, sf_dir):
    """Rows -> JSON messages (binary value, as a producer would send them)
    -> UTF-8 decode -> typed struct -> columns; all distributed."""
    ev = read_table(spark, sf_dir, "events", spread_input=True)
    msgs = to_messages(ev, "events", key="event_id")
    back = (msgs.select(parse_json(utf8_text("value"), _EVENT_MSG_SCHEMA).alias("data"))
            .select("data.*"))
    return back.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
                       "user_id", "event_type", F.round("value", 6).alias("value"), "props")


_LANG_RE = "^https?://[^/]+/([^/]+)/"


@query("label_from_path", "SCL-13 SCL-14", f"""
SELECT page_id, regexp_extract(url, '{_LANG_RE}', 1) AS label,
       regexp_extract(url, '([^/]*)$', 1) AS file_name,
       split_part(regexp_extract(url, '([^/]*)$', 1), '.', 1) AS stem
FROM pages
""")
def label_from_path_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", label_from_path("url", _LANG_RE).alias("label"),
                    file_name("url").alias("file_name"), file_stem("url").alias("stem"))


_PERM = ("list_transform(range(0, 64), lambda k: "
         "embedding[(k % 4) * 16 + (k // 16) * 4 + ((k // 4) % 4) + 1])")


@query("array_permute", "SCL-15", f"""
SELECT vec_id, round(CAST(p[1] AS DOUBLE), 6) AS first_value,
       round(list_sum(list_transform(p, lambda x, i: CAST(x AS DOUBLE) * (i - 1))), 6) AS weighted_sum
FROM (SELECT vec_id, {_PERM} AS p FROM embeddings) t
""")
def array_permute(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    p = e.select("vec_id", chw_to_hwc("embedding", 4, 4, 4).alias("p"))
    return p.select("vec_id", F.round(F.col("p")[0].cast("double"), 6).alias("first_value"),
                    F.round(weighted_position_sum("p"), 6).alias("weighted_sum"))


@query("argmax", "SCL-16", """
SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax
FROM embeddings
""")
def argmax_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", argmax("embedding").cast("bigint").alias("argmax"))


@query("normalise", "SCL-19 SCL-15", f"""
WITH e AS (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
s AS (SELECT (i - 1) // 16 AS ch, avg(CAST(x AS DOUBLE)) AS m, stddev_samp(CAST(x AS DOUBLE)) AS sd
      FROM e GROUP BY 1),
st AS (SELECT list(m ORDER BY ch) AS mean, list(sd ORDER BY ch) AS std FROM s)
SELECT vec_id,
       round(list_sum(list_transform(p, lambda x, i:
             (CAST(x AS DOUBLE) - mean[((i - 1) % 4) + 1]) / std[((i - 1) % 4) + 1] * (i - 1))), 6)
         AS weighted_sum
FROM (SELECT vec_id, {_PERM} AS p FROM embeddings) t, st
""")
def normalise(spark, sf_dir):
    """Per-channel mean/std are fitted over the whole table (4 channels of
    a 4x4x4 channel-major vector), then applied to the channel-last form."""
    e = read_table(spark, sf_dir, "embeddings")
    stats = (e.select(F.posexplode("embedding").alias("pos", "x"))
             .groupBy(F.floor(F.col("pos") / 16).alias("ch"))
             .agg(F.avg(F.col("x").cast("double")).alias("m"),
                  F.stddev_samp(F.col("x").cast("double")).alias("sd"))
             .orderBy("ch").collect())
    mean, std = [r["m"] for r in stats], [r["sd"] for r in stats]
    p = e.select("vec_id", normalise_channels(chw_to_hwc("embedding", 4, 4, 4), mean, std).alias("z"))
    return p.select("vec_id", F.round(weighted_position_sum("z"), 6).alias("weighted_sum"))


def _centroid_sql(dist: str) -> str:
    return f"""
e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS c_label, i, avg(CAST(x AS DOUBLE)) AS m FROM e GROUP BY 1, 2),
d AS (SELECT e.vec_id, e.label, c.c_label, sum({dist}) AS dist
      FROM e JOIN c ON e.i = c.i GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 9), c_label) AS rn FROM d),
pred AS (SELECT vec_id, label, c_label AS prediction, round(dist, 9) AS dist FROM r WHERE rn = 1)"""


@query("centroid_infer", "INF-01 UDF-04 UDF-05", f"""
WITH {_centroid_sql("(CAST(e.x AS DOUBLE) - c.m) * (CAST(e.x AS DOUBLE) - c.m)")}
SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(prediction AS BIGINT) AS prediction,
       round(dist, 6) AS distance FROM pred
""")
def centroid_infer(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    p = centroid_predict(e, "embedding", "label")
    return p.select("vec_id", F.col("label").cast("bigint").alias("label"),
                    F.col("prediction.label").alias("prediction"),
                    F.round("prediction.distance", 6).alias("distance"))


@query("accuracy_f1", "MLT-07 MLT-08 SCL-18", f"""
WITH {_centroid_sql("(CAST(e.x AS DOUBLE) - c.m) * (CAST(e.x AS DOUBLE) - c.m)")},
cls AS (SELECT label AS k FROM pred UNION SELECT prediction FROM pred),
pc AS (SELECT k, (SELECT count(*) FROM pred WHERE label = k) AS support,
              (SELECT count(*) FROM pred WHERE prediction = k) AS predicted,
              (SELECT count(*) FROM pred WHERE label = k AND prediction = k) AS tp FROM cls)
SELECT CAST(sum(support) AS BIGINT) AS n,
       round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(tp) * 100.0 / sum(support), 6) AS accuracy_pct,
       round(sum(support * CASE WHEN tp > 0 THEN 2.0 * tp / (support + predicted) ELSE 0 END)
             / sum(support), 6) AS f1
FROM pc
""")
def accuracy_f1_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    p = centroid_predict(e, "embedding", "label").select("label", F.col("prediction.label").alias("prediction"))
    m = accuracy_f1(p, "label", "prediction")
    return m.select("n", F.round("accuracy", 6).alias("accuracy"),
                    F.round(F.col("accuracy") * 100, 6).alias("accuracy_pct"), F.round("f1", 6).alias("f1"))


_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in CLASS_NAMES) + "]"


@query("model_topk", "INF-02 AGG-10 SCL-17 FLT-06", f"""
WITH {_centroid_sql("(CAST(e.x AS DOUBLE) - c.m) * (CAST(e.x AS DOUBLE) - c.m)")},
e1 AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c1 AS (SELECT label AS c_label, i, avg(CAST(x AS DOUBLE)) AS m FROM e1 GROUP BY 1, 2),
d1 AS (SELECT e1.vec_id, e1.label, c1.c_label, sum(abs(CAST(e1.x AS DOUBLE) - c1.m)) AS dist
       FROM e1 JOIN c1 ON e1.i = c1.i GROUP BY 1, 2, 3),
r1 AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 9), c_label) AS rn FROM d1),
both_models AS (
  SELECT 'centroid_l2' AS model, label, prediction FROM pred
  UNION ALL SELECT 'centroid_l1', label, c_label FROM r1 WHERE rn = 1),
named AS (SELECT model, {_NAMES_SQL}[label + 1] AS label_name, {_NAMES_SQL}[prediction + 1] AS predicted
          FROM both_models),
cnt AS (SELECT model, label_name, predicted, count(*) AS "count" FROM named GROUP BY 1, 2, 3)
SELECT model, label_name, predicted, "count", "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY model, label_name
                               ORDER BY "count" DESC, predicted ASC NULLS FIRST) AS "rank" FROM cnt) t
WHERE "rank" <= 2
""")
def model_topk(spark, sf_dir):
    """Two models (nearest centroid under L2 and L1) scored by the same
    UDF factory; their top-2 predicted class names per true class, in one
    distributed plan instead of a driver loop per class."""
    e = read_table(spark, sf_dir, "embeddings")
    model = centroid_matrix(fit_centroids(e, "embedding", "label"), "label")  # fitted once
    preds = None
    for name, metric in [("centroid_l2", "l2"), ("centroid_l1", "l1")]:
        p = centroid_predict(e, "embedding", "label", metric=metric, model=model).select(
            F.lit(name).alias("model"), lookup("label", CLASS_NAMES).alias("label_name"),
            lookup("prediction.label", CLASS_NAMES).alias("predicted"))
        preds = p if preds is None else preds.unionByName(p)
    top = top_k_per_group(preds, ["model", "label_name"], "predicted", 2)
    return top.select("model", "label_name", "predicted", "count", F.col("rank").cast("bigint").alias("rank"))
