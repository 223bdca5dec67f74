"""Queries: cross-validation, encodings and importances out of fold statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.folds import naive_bayes_cv, one_hot_triples, permutation_importance, target_encoded
from ..operators.inference import centroid_matrix, centroid_predict, fit_centroids
from ..operators.split import hash_split
from ..sources.readers import read_table
from .registry import query

_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_POINTS = (0.5, 1.0, 10.0)


def _bucket_sql(key: str) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 100)"


@query("nb_cv_scores", "MLT-05 MLT-03 MLT-07", f"""
WITH d AS (SELECT {_bucket_sql('l_orderkey')} % 3 AS fold, l_returnflag AS c, {', '.join(f'CAST({f} AS DOUBLE) AS x{j}' for j, f in enumerate(_FEATURES))} FROM lineitem),
f AS (SELECT fold, c, count(*) AS n, {', '.join(f'sum(x{j}) AS s{j}' for j in range(3))} FROM d GROUP BY 1, 2),
t AS (SELECT g.fold, f.c, sum(f.n) AS n, {', '.join(f'sum(f.s{j}) AS s{j}' for j in range(3))} FROM (SELECT DISTINCT fold FROM f) g JOIN f ON f.fold <> g.fold GROUP BY 1, 2),
a AS (SELECT unnest([{', '.join(map(str, _POINTS))}])::DOUBLE AS smoothing),
m AS (SELECT fold, smoothing, c, ln(n + smoothing) - ln(sum(n) OVER (PARTITION BY fold, smoothing) + smoothing * count(*) OVER (PARTITION BY fold, smoothing)) AS prior,
  {', '.join(f'ln(s{j} + smoothing) - ln(s0 + s1 + s2 + 3 * smoothing) AS w{j}' for j in range(3))} FROM t, a),
p AS (SELECT d.fold, smoothing, d.c = arg_max(m.c, (round(prior + x0 * w0 + x1 * w1 + x2 * w2, 9), -ascii(m.c))) AS hit FROM (SELECT row_number() OVER () AS id, * FROM d) d JOIN m USING (fold) GROUP BY id, d.fold, smoothing, d.c)
SELECT fold, smoothing, count(*) AS n, count(*) FILTER (hit) AS n_correct, round(count(*) FILTER (hit) / count(*), 6) AS accuracy FROM p GROUP BY 1, 2
""")
def nb_cv_scores(spark, sf_dir):
    """Naive Bayes on three key-hash folds and three smoothing points, all from one aggregate."""
    scores = naive_bayes_cv(read_table(spark, sf_dir, "lineitem"), "l_returnflag", _FEATURES, "l_orderkey", 3, _POINTS)
    return scores.select(F.col("fold").cast("bigint").alias("fold"), "smoothing", "n", "n_correct", F.round("accuracy", 6).alias("accuracy"))


@query("target_encoding", "FEA-01 MLT-02 FEA-02", f"""
WITH d AS (SELECT event_id, user_id, json_extract_string(props, '$.k') AS k, CAST(event_type = 'purchase' AS DOUBLE) AS y, {_bucket_sql('event_id')} % 5 AS fold FROM events),
m AS (SELECT g.fold, avg(d.y) AS mean FROM (SELECT DISTINCT fold FROM d) g JOIN d ON d.fold <> g.fold GROUP BY 1),
u AS (SELECT user_id AS v, fold, sum(y) AS s, count(*) AS n FROM d GROUP BY 1, 2), ut AS (SELECT v, sum(s) AS s, sum(n) AS n FROM u GROUP BY 1),
k AS (SELECT k AS v, fold, sum(y) AS s, count(*) AS n FROM d GROUP BY 1, 2), kt AS (SELECT v, sum(s) AS s, sum(n) AS n FROM k GROUP BY 1)
SELECT event_id, round((ut.s - u.s + 20 * mean) / (ut.n - u.n + 20), 6) AS user_enc, round((kt.s - k.s + 20 * mean) / (kt.n - k.n + 20), 6) AS k_enc
FROM d JOIN m USING (fold) JOIN ut ON d.user_id IS NOT DISTINCT FROM ut.v JOIN u ON d.user_id IS NOT DISTINCT FROM u.v AND d.fold = u.fold
  JOIN kt ON d.k IS NOT DISTINCT FROM kt.v JOIN k ON d.k IS NOT DISTINCT FROM k.v AND d.fold = k.fold
""")
def target_encoding(spark, sf_dir):
    """Users and property values as out-of-fold shares of purchases."""
    ev = read_table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("user"), F.get_json_object("props", "$.k").alias("k"), (F.col("event_type") == "purchase").cast("double").alias("bought"))
    out = target_encoded(ev, ["user", "k"], "bought", "event_id")
    return out.select("event_id", F.round("user_enc", 6).alias("user_enc"), F.round("k_enc", 6).alias("k_enc"))


@query("one_hot", "FEA-05 FEA-01 FEA-02 MLT-01", f"""
WITH t AS (SELECT * FROM orders WHERE {_bucket_sql('o_orderkey')} < 80 AND o_orderpriority <> '1-URGENT'),
p AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM t WHERE o_orderpriority IS NOT NULL GROUP BY 1),
s AS (SELECT CAST(o_custkey AS VARCHAR) AS v, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS i FROM t WHERE o_custkey IS NOT NULL GROUP BY 1)
SELECT o_orderkey AS row, CAST(coalesce(p.i, (SELECT count(*) FROM p)) AS BIGINT) AS index, 1.0::DOUBLE AS value FROM orders LEFT JOIN p ON o_orderpriority = p.v
UNION ALL SELECT o_orderkey, CAST((SELECT count(*) FROM p) + 1 + coalesce(s.i, (SELECT count(*) FROM s)) AS BIGINT), 1.0 FROM orders LEFT JOIN s ON CAST(o_custkey AS VARCHAR) = s.v
""")
def one_hot(spark, sf_dir):
    """Priority and customer of every order as one-hot triples, fitted on the train
    side without one priority, which so is unseen."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    train = hash_split(o, "o_orderkey", 80)[0].where("o_orderpriority <> '1-URGENT'")
    return one_hot_triples(o, ["o_orderpriority", "o_custkey"], "o_orderkey", train)


_BLOCKS = 8
_BLOCK_SQL = ", ".join(f"CASE WHEN f.feature = 'block_{i}' THEN coalesce(lead(v[{8 * i + 1}:{8 * i + 8}]) OVER w{i}, first_value(v[{8 * i + 1}:{8 * i + 8}]) OVER w{i}) ELSE v[{8 * i + 1}:{8 * i + 8}] END" for i in range(_BLOCKS))
_WINDOW_SQL = ", ".join(f"w{i} AS (PARTITION BY f.feature ORDER BY md5('{i}:' || vec_id), vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)" for i in range(_BLOCKS))


@query("permutation_scores", "MLT-06 MLT-07 INF-01", f"""
WITH c AS (SELECT label AS c, list(m ORDER BY i) AS m FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) WHERE {_bucket_sql('vec_id')} < 80 GROUP BY 1, 2) GROUP BY 1),
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE {_bucket_sql('vec_id')} >= 80),
f AS (SELECT unnest(['(none)', {', '.join(f"'block_{i}'" for i in range(_BLOCKS))}]) AS feature),
x AS (SELECT f.feature, vec_id, label, flatten([{_BLOCK_SQL}]) AS v FROM e, f WINDOW {_WINDOW_SQL}),
p AS (SELECT feature, vec_id, label, arg_min(c, (round(list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9), c)) AS c FROM x, c GROUP BY 1, 2, 3),
n AS (SELECT feature, count(*) AS n, count(*) FILTER (label = c) AS n_correct FROM p GROUP BY 1)
SELECT feature, n, n_correct, round(n_correct / n, 6) AS accuracy, round((SELECT n_correct / n FROM n WHERE feature = '(none)') - n_correct / n, 6) AS importance FROM n
""")
def permutation_scores(spark, sf_dir):
    """Importance of each eighth of the vectors for the centroid model, on the test side."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    train, test = hash_split(e, "vec_id", 80)
    model = centroid_matrix(fit_centroids(train, "embedding", "label"), "label")
    parts = [f"block_{i}" for i in range(_BLOCKS)]
    cut = test.select("vec_id", "label", *[F.slice("embedding", 8 * i + 1, 8).alias(b) for i, b in enumerate(parts)])

    def score(rows):
        whole = rows.withColumn("whole", F.concat(*parts)).drop(*parts)
        return centroid_predict(whole, "whole", "label", model=model).withColumn("prediction", F.col("prediction.label"))

    found = permutation_importance(cut, {b: [b] for b in parts}, "vec_id", score)
    return found.select("feature", "n", "n_correct", F.round("accuracy", 6).alias("accuracy"), F.round("importance", 6).alias("importance"))
