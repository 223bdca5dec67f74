"""DuckDB SQL for the clustering and vector-code queries: their rounds, one after another."""

from __future__ import annotations

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_SQUARED = "list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT)))"
_FLOOR_DIV = "CAST((sum({x}) - ((sum({x}) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def clustering_sql(k: int = 16, rounds: int = 3, size: int = 64, factor: int = 64) -> str:
    parts = [f"""k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE} AND len(embedding) = {size}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS c, v AS m FROM k QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v, min({{'d': {_SQUARED.format(a='v', b='m')}, 'c': c}}) AS b FROM k, c{r} GROUP BY vec_id, v)""")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT b.c AS c, i, {_FLOOR_DIV.format(x='v[i]')} AS x FROM a{r}, range(1, {size + 1}) t(i) GROUP BY b.c, i),
n{r} AS (SELECT c, list(x ORDER BY i) AS m FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN n{r} USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.b.c AS cluster, a.b.d AS distance, CAST(sum(a.b.d) OVER (PARTITION BY a.b.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.b.c = c.c"""


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, factor: int = 4096) -> str:
    steps = [f"""k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE}),
p AS MATERIALIZED (SELECT vec_id, label, CAST(p AS INTEGER) AS p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM k, range({parts}) t(p)),
c0 AS MATERIALIZED (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS INTEGER) AS c, v AS m FROM p QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p, v, min({{'d': {_SQUARED.format(a='v', b='m')}, 'c': c}}) AS b FROM p JOIN c{r} USING (p) GROUP BY vec_id, label, p, v)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT p, b.c AS c, i, {_FLOOR_DIV.format(x='v[i]')} AS x FROM a{r}, range(1, (SELECT max(len(v)) FROM p) + 1) t(i) GROUP BY p, b.c, i),
n{r} AS (SELECT p, c, list(x ORDER BY i) AS m FROM s{r} GROUP BY p, c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.p, c{r}.c, coalesce(n{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN n{r} USING (p, c))""")
    return "WITH " + ",\n".join(steps) + f""",
e AS (SELECT vec_id, label, string_agg(format('{{:02x}}', b.c), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY p, c)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e, h"""
