"""Centroid clustering of integer vectors by scalar lookup tables.

Quantised components take few values.  Once, the values that occur in each
dimension are listed; a vector is then kept as places in that list.  Each round
tabulates the squared difference of every occurring value to every centroid's
component, and a vector's distances are the sums of its table rows.  A round
brings back sums and counts a cluster alone, one partial row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .vectors import first_vectors, floored, packed, summed, unpacked, whole_vectors

#: Occurring values of all dimensions that one shared table holds (rows of 8 bytes a centroid); beyond, every batch lists its own.
MOST_VALUES = 1 << 18
PIECE = 2048  # vectors whose distances are summed at a time


def integer_vectors(vectors: DataFrame, size: int, factor: int) -> DataFrame:
    """``vec_id, parts``: the kept vectors as packed ``floor(factor * x)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed(floored(batch.column("vec"), factor))], ["vec_id", "parts"])

    kept = vectors.filter(whole_vectors("embedding", size))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")).mapInArrow(run, "vec_id long, parts binary")


def occurring(ints: DataFrame, size: int, most: int = MOST_VALUES) -> list[np.ndarray] | None:
    """The sorted values that occur in each dimension; None where they are more than ``most`` together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0, np.int64)] * size
        for batch in batches:
            values = unpacked(batch.column("parts"), size)
            seen = [np.union1d(s, values[:, d]) for d, s in enumerate(seen)]
            if sum(map(len, seen)) > most:  # what one task has seen is passed on, so that it stays bounded
                yield _value_rows(seen)
                seen = [np.zeros(0, np.int64)] * size
        yield _value_rows(seen)

    rows = ints.select("parts").mapInArrow(run, "dim int, value long").distinct().limit(most + 1).toArrow()
    if rows.num_rows > most:
        return None
    dims, values = rows.column("dim").to_numpy(), rows.column("value").to_numpy()
    return [np.sort(values[dims == d]) for d in range(size)]


def _value_rows(seen: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(seen), dtype=np.int32), [len(s) for s in seen])), pa.array(np.concatenate(seen))], ["dim", "value"])


def table_of(values: list[np.ndarray], centroids: np.ndarray) -> np.ndarray:
    """Squared differences, a row per dimension and value, a column per centroid."""
    return np.concatenate([(v[:, None] - centroids[None, :, d]) ** 2 for d, v in enumerate(values)])


def places_of(ints: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """The table row of every component."""
    first = np.cumsum([0] + [len(v) for v in values[:-1]])
    return np.stack([np.searchsorted(v, ints[:, d]) + first[d] for d, v in enumerate(values)], axis=1)


def nearest_centroids(ints: np.ndarray, centroids: np.ndarray, values: list[np.ndarray] | None, table: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``(number, squared distance)`` of each vector's nearest centroid, of equal ones the smaller number."""
    if values is None:
        values = [np.unique(ints[:, d]) for d in range(ints.shape[1])]
        table = table_of(values, centroids)
    places = places_of(ints, values)
    number, distance = np.zeros(len(ints), np.int64), np.zeros(len(ints), np.int64)
    for i in range(0, len(ints), PIECE):
        total = np.zeros((len(places[i:i + PIECE]), table.shape[1]), np.int64)
        for d in range(places.shape[1]):
            total += table[places[i:i + PIECE, d]]
        number[i:i + PIECE] = total.argmin(axis=1)
        distance[i:i + PIECE] = total.min(axis=1)
    return number, distance


def assigned(ints: DataFrame, centroids: np.ndarray, values: list[np.ndarray] | None) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if values is None else table_of(values, centroids)
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest_centroids(unpacked(batch.column("parts"), centroids.shape[1]), centroids, values, table)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return ints.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_sums(ints: DataFrame, centroids: np.ndarray, values: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Exact ``(count, componentwise sums)`` of every cluster, as Python integers in object arrays."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if values is None else table_of(values, centroids)
        sums = np.zeros((k, 1 + size), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = unpacked(batch.column("parts"), size)
                number, _ = nearest_centroids(rows, centroids, values, table)
                sums[:, 0] += np.bincount(number, minlength=k)
                order = np.argsort(number, kind="stable")
                held, first = np.unique(number[order], return_index=True)
                sums[held, 1:] += np.add.reduceat(rows[order], first, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))], ["sums"])

    total = summed(ints.select("parts").mapInArrow(run, "sums array<long>"), "sums")
    whole = np.array([total.get(i, 0) for i in range(k * (1 + size))], object).reshape(k, 1 + size)
    return whole[:, 0], whole[:, 1:]


def first_centroids(vectors: DataFrame, k: int, size: int, factor: int, salt: str) -> np.ndarray:
    """The ``k`` kept vectors of smallest hash of ``salt`` and id; of equal ids the smaller vector, null ids last."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("long").cast("string")).cast("binary"), 256)
    return first_vectors(vectors.filter(whole_vectors("embedding", size)), key, k, size, factor)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, factor: int = 64, salt: str = "1:", most_values: int = MOST_VALUES) -> DataFrame:
    """Per kept vector ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Kept are vectors of exactly ``size`` components, none null, NaN or infinite;
    a component ``x`` becomes ``floor(factor * x)``.  The first centroids are the
    ``k`` vectors whose ``sha256(salt + vec_id)`` is smallest.  Each round assigns
    every vector to the nearest one (ties: the smaller number) and moves each
    centroid that has vectors to the floor of their mean; an empty one stays.
    All arithmetic is in integers, so the order of rows has no effect.

    Rows that repeat an id or a vector count each; those of equal id are taken as
    first centroids in the order of their vectors, those of null id last.
    With fewer than ``k`` kept vectors there are as many centroids.  A table
    without any gives no rows.  Components beyond 2**26 / ``factor`` raise, since
    distances would leave 64 bits.  Other columns are ignored."""
    ints = staged(integer_vectors(vectors, size, factor), "integer-vectors")
    centroids = first_centroids(vectors, k, size, factor, salt)
    values = occurring(ints, size, most_values)
    for _ in range(rounds if len(centroids) else 0):
        counts, sums = cluster_sums(ints, centroids, values)
        moved = counts > 0
        centroids = centroids.copy()
        centroids[moved] = (sums[moved] // counts[moved, None]).astype(np.int64)
    found = staged(assigned(ints, centroids, values), "clusters")
    names = ints.sparkSession.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())], "cluster int, centroid_sha256 string")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    every = found.agg(F.sum("distance").alias("inertia"))
    per_cluster = inertia.join(F.broadcast(names), "cluster").withColumn("inertia", every.scalar())  # at most k rows
    return found.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
