"""Approximate nearest neighbours by inner product: one robust-pruned graph per shard.

Shards hold random parts of the vectors.  In a shard the largest inner product
becomes the smallest distance by one more component, ``sqrt(M**2 - |x|**2)``.
Vectors are inserted in growing batches: greedy searches in the graph so far
propose neighbours, pruning with a relaxed distance keeps diverse ones, and
edges back are pruned alike.  A query runs a beam search in every shard; exact
double-precision products of what it finds make the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

SHARD_ROWS = 8192
QUERY_BLOCK = 512
MOST_PARTS = 20_000
DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 28, 48, 128, 1.2


class Graph:
    """Out-neighbours (``-1``: none) of points, searched from the point nearest the mean."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, start: int = 0):
        self.points = np.ascontiguousarray(points, np.float32)
        self.norms = np.einsum("ij,ij->i", self.points, self.points)
        self.edges = np.full((len(points), DEGREE), -1, np.int32) if edges is None else edges
        self.start = start

    def search(self, queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beam search of all queries at once: ``(ids, distances, expanded)``, nearest first, ``-1`` where there is none.

        Every step expands the ``width`` nearest points of each beam that are not expanded yet."""
        n, rows = len(queries), np.arange(len(queries))[:, None]
        queries = np.ascontiguousarray(queries, np.float32)
        ids = np.full((n, beam), -1, np.int32)
        dist = np.full((n, beam), np.inf, np.float32)
        done = np.ones((n, beam), bool)
        seen = np.zeros((n, len(self.points) + 1), bool)  # the last column is that of id -1
        seen[:, -1] = True
        ids[:, 0], done[:, 0] = self.start, False
        dist[:, 0] = self.norms[self.start] - 2 * queries @ self.points[self.start]
        seen[:, self.start] = True
        active = np.arange(n)
        while len(active):
            a_done, a_ids = done[active], ids[active]
            place = np.argsort(a_done, axis=1, kind="stable")[:, :width]  # nearest first among those not expanded
            opened = ~np.take_along_axis(a_done, place, 1)
            nodes = np.where(opened, np.take_along_axis(a_ids, place, 1), -1)
            np.put_along_axis(a_done, place, True, 1)
            near = np.where(nodes[:, :, None] >= 0, self.edges[nodes], -1).reshape(len(active), -1)
            fresh = ~seen[active[:, None], near]
            near = np.where(fresh, near, -1)
            seen[active[:, None], near] = True
            gathered = self.points[near]
            d = self.norms[near] - 2 * np.matmul(gathered, queries[active][:, :, None])[:, :, 0]
            d[near < 0] = np.inf
            near_sorted = np.sort(near, axis=1)  # a point that two expanded ones share comes once
            if (near_sorted[:, 1:] == near_sorted[:, :-1])[near_sorted[:, 1:] >= 0].any():
                order = np.argsort(near, axis=1, kind="stable")
                again = np.zeros(near.shape, bool)
                s = np.take_along_axis(near, order, 1)
                np.put_along_axis(again, order[:, 1:], (s[:, 1:] == s[:, :-1]), 1)
                d[again] = np.inf
            all_d = np.concatenate([dist[active], d], axis=1)
            best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_d, best, 1), axis=1, kind="stable"), 1)
            all_ids = np.concatenate([a_ids, near], axis=1)
            all_done = np.concatenate([a_done, np.zeros(near.shape, bool)], axis=1)
            dist[active] = np.take_along_axis(all_d, best, 1)
            ids[active] = np.where(np.isfinite(dist[active]), np.take_along_axis(all_ids, best, 1), -1)
            done[active] = np.take_along_axis(all_done, best, 1) | (ids[active] < 0)
            active = active[~done[active].all(axis=1)]
        return ids, dist, seen

    def prune(self, owners: np.ndarray, candidates: np.ndarray, relax: float) -> np.ndarray:
        """Out-neighbours of ``owners`` among ``candidates`` (``-1``: none).

        The nearest candidate is taken and drops every other that is nearer to it,
        by a factor of ``relax``, than to the owner; and so on."""
        candidates = np.where(candidates == owners[:, None], -1, candidates)
        order = np.argsort(candidates, axis=1, kind="stable")
        s = np.take_along_axis(candidates, order, 1)
        again = np.zeros(s.shape, bool)
        again[:, 1:] = s[:, 1:] == s[:, :-1]
        candidates = np.where(again, -1, s)
        points, own = self.points[candidates], self.points[owners]
        to_owner = np.maximum(self.norms[candidates] + self.norms[owners][:, None] - 2 * np.matmul(points, own[:, :, None])[:, :, 0], 0)
        to_owner[candidates < 0] = np.inf
        between = np.maximum(self.norms[candidates][:, :, None] + self.norms[candidates][:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1)), 0)
        alive, rows = candidates >= 0, np.arange(len(owners))
        out = np.full((len(owners), DEGREE), -1, np.int32)
        factor = np.float32(relax * relax)  # distances are squared
        for k in range(DEGREE):
            d = np.where(alive, to_owner, np.inf)
            best = d.argmin(axis=1)
            some = np.isfinite(d[rows, best])
            if not some.any():
                break
            out[some, k] = candidates[rows, best][some]
            alive &= ~((factor * between[rows, best] <= to_owner) & some[:, None])
            alive[rows, best] = False
        return out

    def insert(self, batch: np.ndarray, relax: float) -> None:
        ids, _, _ = self.search(self.points[batch], BUILD_BEAM)
        self.edges[batch] = self.prune(batch, np.concatenate([ids, self.edges[batch]], axis=1), relax)
        source, slot = np.nonzero(self.edges[batch] >= 0)
        target, source = self.edges[batch][source, slot], batch[source]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        owners, first, counts = np.unique(target, return_index=True, return_counts=True)
        used = (self.edges[owners] >= 0).sum(axis=1)
        fits = used + counts <= DEGREE
        place = np.arange(len(target)) - np.repeat(first, counts)
        easy = np.repeat(fits, counts)
        self.edges[target[easy], (np.repeat(used, counts) + place)[easy]] = source[easy]
        full, step = np.flatnonzero(~fits), 64
        for i in range(0, len(full), 256):  # of many edges back to one point, some at a time
            part = full[i:i + 256]
            for low in range(0, int(counts[part].max()), step):
                these = part[counts[part] > low]
                new = np.full((len(these), step), -1, np.int32)
                for r, f in enumerate(these):
                    got = source[first[f] + low:first[f] + min(low + step, counts[f])]
                    new[r, :len(got)] = got
                self.edges[owners[these]] = self.prune(owners[these], np.concatenate([self.edges[owners[these]], new], axis=1), relax)

    @classmethod
    def build(cls, points: np.ndarray, relax: float = RELAX, seed: int = 2) -> Graph:
        graph = cls(points)
        n = len(points)
        graph.start = int(np.argmin(graph.norms - 2 * graph.points @ graph.points.mean(axis=0)))
        order = np.random.default_rng(seed).permutation(n)
        order = order[order != graph.start].astype(np.int32)
        at, size = 0, 8
        while at < len(order):
            graph.insert(order[at:at + size], relax)
            at, size = at + size, min(2 * size, 512)
        return graph


def augmented(vectors: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", vectors, vectors)
    return np.concatenate([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]], axis=1)


def vectors_of(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector, dim`` of the rows that take part, equal rows once."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).dropDuplicates(["vec_id", "vector"]).withColumn("dim", F.size("vector"))


INDEX = "dim int, shard int, distinct_vectors binary, edges binary, start int, ids array<array<long>>"


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: its distinct vectors, their graph and for each the smallest ``k + 1`` ids.

    Of equal vectors only the ``k + 1`` of smallest id can be among any query's
    nearest ``k`` others, so a vector that many rows share takes no more room."""
    copies = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    rows = vectors.withColumn("copy", copies).filter(F.col("copy") <= k + 1)
    shards = vectors.groupBy("dim").agg(F.ceil(F.count_distinct(F.xxhash64("vector")) / shard_rows).cast("int").alias("shards"))
    rows = rows.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards").cast("long")).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        ids, vectors = group.column("vec_id").to_numpy(), vectors_of(group.column("vector"))
        order = np.lexsort([ids, *vectors.T[::-1]])  # equal vectors side by side, smaller ids first
        ids, vectors = ids[order], vectors[order]
        fresh = np.concatenate([[True], (vectors[1:] != vectors[:-1]).any(axis=1)])
        distinct = vectors[fresh]
        graph = Graph.build(augmented(distinct))
        return pa.table({"dim": pa.array([group.column("dim")[0].as_py()], pa.int32()), "shard": pa.array([group.column("shard")[0].as_py()], pa.int32()),
                         "distinct_vectors": pa.array([distinct.tobytes()], pa.binary()), "edges": pa.array([graph.edges.tobytes()], pa.binary()),
                         "start": pa.array([graph.start], pa.int32()), "ids": pa.array([[x.tolist() for x in np.split(ids, np.flatnonzero(fresh)[1:])]], pa.list_(pa.list_(pa.int64())))})

    return rows.select("dim", "shard", "vec_id", "vector").groupBy("dim", "shard").applyInArrow(build, INDEX)


def opened(shard: dict) -> tuple[np.ndarray, Graph, list[list[int]]]:
    """A shard's vectors, their graph and the ids of each."""
    vectors = np.frombuffer(shard["distinct_vectors"], np.float64).reshape(-1, shard["dim"])
    graph = Graph(augmented(vectors), np.frombuffer(shard["edges"], np.int32).reshape(len(vectors), -1), shard["start"])
    return vectors, graph, shard["ids"]


def search_shard(queries: pa.Table, shard: tuple[np.ndarray, Graph, list[list[int]]], k: int, beam: int) -> pa.RecordBatch:
    """The nearest ``k`` of an opened shard for each query, with exact scores; ties go to smaller ids."""
    vectors, graph, copies = shard
    out = []
    own, asked = queries.column("query_id").to_numpy(), vectors_of(queries.column("vector"))
    names = queries.column("query").to_numpy()
    for i in range(0, len(own), QUERY_BLOCK):
        q = asked[i:i + QUERY_BLOCK]
        found, _, _ = graph.search(np.concatenate([q, np.zeros((len(q), 1))], axis=1), min(beam, len(vectors)))
        products = np.einsum("ijk,ik->ij", vectors[found], q)
        for r in range(len(q)):
            there = np.flatnonzero(found[r] >= 0)
            hits = [(-products[r, c], v) for c in there for v in copies[found[r, c]] if v != own[i + r]]
            hits.sort()
            out += [(names[i + r], own[i + r], v, -p) for p, v in hits[:k]]
    columns = list(zip(*out, strict=True)) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query", "query_id", "vec_id", "score"])


def search_stream(batches: Iterator[pa.RecordBatch], k: int, beam: int) -> Iterator[pa.RecordBatch]:
    """Answers of a stream where each shard's index row stands before that shard's queries.

    Holds one opened shard and one batch of queries, however many queries there are.
    A shard that got no vectors has no index row, and its queries find nothing there."""
    shard, place = None, None
    for batch in batches:
        indexed = batch.column("edges").is_valid().to_numpy(zero_copy_only=False)
        cuts = np.unique([0, *np.flatnonzero(indexed), *(np.flatnonzero(indexed) + 1), batch.num_rows])
        for a, b in zip(cuts, cuts[1:], strict=False):
            if indexed[a]:
                shard, place = opened(batch.slice(a, 1).to_pylist()[0]), batch.column("place")[a].as_py()
                continue
            asked = pa.Table.from_batches([batch.slice(a, b - a)])
            asked = asked.filter(pa.array(asked.column("place").to_numpy() == place))
            if asked.num_rows:
                yield search_shard(asked, shard, k, beam)


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20, beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose ``vec_id`` is divisible by ``every``, its ``k`` nearest others.

    Nearness is the inner product in double precision; ties go to the smaller
    ``vec_id``.  Vectors that are null, zero or hold null or non-finite components,
    and rows without ``vec_id``, take no part; rows equal in both columns count
    once, and a query compares with vectors of its own length.  A query never
    finds rows of its own ``vec_id``.  Other columns are ignored.

    Each shard's index is read by one task, which streams all queries of its
    length through it: an index moves once, a query once per shard.
    """
    vectors = staged(usable(embeddings), "vectors")
    index = staged(build_index(vectors, k, shard_rows), "ann-index")
    dims = index.groupBy("dim").agg(F.max("shard").alias("last"))  # one row per length of vectors
    before = F.sum(F.col("last") + 1).over(W.orderBy("dim")) - F.col("last") - 1
    dims = staged(dims.select("dim", "last", before.cast("long").alias("before")), "ann-shards")
    queries = (vectors.filter(F.col("vec_id") % every == 0).join(dims, "dim")
               .select("dim", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("shard"), "before", F.xxhash64("vec_id", "vector").alias("query"), F.col("vec_id").alias("query_id"), "vector"))
    rows = index.join(dims.select("dim", "before"), "dim").unionByName(queries, allowMissingColumns=True)
    rows = rows.withColumn("place", (F.col("before") + F.col("shard")).cast("int")).drop("before")
    total = dims.agg(F.sum(F.col("last") + 1).alias("n")).first().n or 1
    # a partition per shard, which is not coalesced; a shard's index row comes before its queries
    parts = rows.repartitionById(min(total, MOST_PARTS), F.col("place")).sortWithinPartitions("place", F.col("query").isNotNull())
    found = parts.mapInArrow(lambda batches: search_stream(batches, k, beam), "query long, query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
