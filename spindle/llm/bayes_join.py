"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents whose signatures share a band are candidates.  Their MinHash values
are compared a few at a time; with m of n equal the similarity has a Beta
posterior, and a pair is dropped as soon as its chance of reaching the
threshold falls below a tolerance.  What is left is verified exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_batches, text_or_empty
from .graph import components
from .shingles import MinHash, band_keys, distinct_sets, lists_of, shingle_hashes

PERMUTATIONS, BANDS, ROWS, SEED = 128, 25, 5, 3
STEP = 16
BLOCK = 2048


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, permutations: int, step: int) -> tuple[tuple[int, int], ...]:
    """``(n, m)``: after ``n`` values a pair with fewer than ``m`` equal ones is dropped.

    Under a uniform prior the similarity is Beta(m+1, n-m+1) after m of n equal
    values, and its chance to be at least ``t`` is that of at most m successes in
    n+1 trials of chance t."""
    found = []
    for n in range(step, permutations + 1, step):
        chance, m = 0.0, 0
        while m <= n:
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
            m += 1
        found.append((n, m))
    return tuple(found)


def surviving(signatures: np.ndarray, i: int, others: np.ndarray, bounds: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Those of ``others`` that the values of row ``i`` do not rule out, compared step by step."""
    equal, done = np.zeros(len(others), np.int32), 0
    for n, m in bounds:
        equal += (signatures[others, done:n] == signatures[i, done:n]).sum(axis=1, dtype=np.int32)
        left = equal >= m
        others, equal, done = others[left], equal[left], n
        if not len(others):
            break
    return others


def linked_groups(signatures: np.ndarray, bounds: tuple[tuple[int, int], ...]) -> list[tuple[int, int]]:
    """Edges that connect all rows which a chain of surviving pairs connects.

    Each row taken up is compared with the rows not connected yet, so a group of
    near copies costs about one comparison per row, not one per pair."""
    edges, rest = [], np.arange(len(signatures))
    while len(rest):
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            i = waiting.pop()
            found = surviving(signatures, i, rest, bounds)
            edges += [(int(i), int(j)) for j in found]
            waiting += found.tolist()
            rest = np.setdiff1d(rest, found, assume_unique=True)
    return edges


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` out of a sorted stream, whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if i:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(rows: DataFrame, key: str, size: str, node: str, block: int) -> DataFrame:
    """Adds ``part, left, right``: rows of a group of up to ``block`` are in one part (0, 0); a larger
    group is dealt into blocks by hash of the node, and each pair of blocks is a part."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(node), blocks.cast("long")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, own).alias("left"), F.greatest(o, own).alias("right"), own.alias("own")))
    return rows.withColumn("_p", F.explode(pairs)).select(*rows.columns, F.col("_p.left").alias("left"), F.col("_p.right").alias("right"), F.col("_p.own").alias("own"))


def by_group(rows: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run ``work`` on each whole group of rows; a task streams through its sorted groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in grouped(batches, keys):
            if (got := work(group)) is not None and got.num_rows:
                held.append(got)
                size += got.num_rows
                if size >= 4096:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(run, schema)


def signature_rows(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_key, node, n_shingles, signature, keys`` per row; ``node`` is the digest of the shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(PERMUTATIONS, SEED)
        for batch in batches:
            for first, held in text_batches(batch.column("text").to_pylist()):
                hashes, counts = shingle_hashes(held, width)
                sets, values = distinct_sets(hashes, counts), minhash.signatures(hashes, counts)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(held)), batch.column("text_key").slice(first, len(held)),
                    pa.array([digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([v.tobytes() for v in values.astype("<u2")], pa.binary()), lists_of(band_keys(values, BANDS, ROWS)),
                ], ["doc_id", "text_key", "node", "n_shingles", "signature", "keys"])

    return docs.mapInArrow(run, "doc_id long, text_key binary, node binary, n_shingles int, signature binary, keys array<long>")


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """``node, shingles`` (sorted 64-bit values) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, held in text_batches(batch.column("text").to_pylist()):
                sets = distinct_sets(*shingle_hashes(held, width))
                yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node binary, shingles binary")


def candidate_edges(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``a, b``: edges that connect every pair which shares a band and is not ruled out."""
    bounds = least_matches(threshold, tolerance, PERMUTATIONS, STEP)
    banded = nodes.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    rows = banded.join(shared, "key").join(nodes.select("node", "signature"), "node")

    def work(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        values = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u2").reshape(group.num_rows, -1)
        edges = linked_groups(values, bounds)
        names = group.column("node").to_pylist()
        return pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in edges], pa.binary()), pa.array([names[j] for _, j in edges], pa.binary())], ["a", "b"])

    parts = in_blocks(rows, "key", "members", "node", 2 * BLOCK).select("key", "left", "right", "node", "signature")
    return by_group(parts, ["key", "left", "right"], work, "a binary, b binary").distinct()


def verified_blocks(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, piece: int = 512, width: int = 8192):
    """``(rows, columns, linked)``: which pairs of sets have a similarity of ``threshold`` or more, exactly, by pieces.

    Intersections are products of incidence matrices.  Shingles that all sets
    hold are added as a number and those of one set meet none, so the matrices
    hold only what differs between near copies.  With ``left`` being ``right``
    each pair comes once."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, inverse, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    everywhere = int((held == len(sets)).sum())
    kept = (held > 1) & (held < len(sets))
    column = np.cumsum(kept) - 1
    some = kept[inverse]
    owner, column = np.repeat(np.arange(len(sets)), sizes)[some], column[inverse[some]]
    starts, total = np.searchsorted(owner, np.arange(len(sets) + 1)), int(kept.sum())

    def dense(rows: np.ndarray, low: int) -> np.ndarray:
        out = np.zeros((len(rows), min(width, total - low)), np.float32)
        for r, i in enumerate(rows):
            at = column[starts[i]:starts[i + 1]] - low
            out[r, at[(at >= 0) & (at < out.shape[1])]] = 1
        return out

    same = left is right
    for a in range(0, len(left), piece):
        for b in range(a if same else 0, len(right), piece):
            rows, cols = left[a:a + piece], right[b:b + piece]
            shared = np.full((len(rows), len(cols)), everywhere, np.int64)
            for low in range(0, total, width):
                x = dense(rows, low)
                y = x if same and a == b else dense(cols, low)
                shared += (x @ y.T).astype(np.int64)
            union = sizes[rows][:, None] + sizes[cols][None, :] - shared
            linked = shared >= threshold * union
            yield rows, cols, np.triu(linked, 1) if same and a == b else linked


def star_edges(rows: np.ndarray, cols: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """As few edges as connect what ``linked`` connects."""
    mine = np.flatnonzero(linked.any(axis=1))
    theirs = np.flatnonzero(linked.any(axis=0))
    if not len(mine):
        return []
    linked = linked[np.ix_(mine, theirs)]
    top = len(mine)
    label = np.arange(top)
    while True:
        other = np.where(linked, label[:, None], top).min(axis=0)
        new = np.minimum(label, np.where(linked, other[None, :], top).min(axis=1))
        if (new == label).all():
            break
        label = new
    edges = [(int(rows[mine[k]]), int(rows[mine[label[k]]])) for k in range(top) if label[k] != k]
    return edges + [(int(cols[theirs[k]]), int(rows[mine[other[k]]])) for k in range(len(theirs))]


def verify(rows: DataFrame, threshold: float) -> DataFrame:
    """``node, links, other``: link counts of the nodes (``other`` null) and edges of verified pairs.

    ``rows`` has ``root, left, right, own, node, copies, shingles``; a part holds
    two blocks of one component or all of it."""
    def work(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        nodes, copies = group.column("node").to_pylist(), group.column("copies").to_numpy()
        sets = [np.frombuffer(s, "<u8") for s in group.column("shingles").to_pylist()]
        low, high, own = group.column("left")[0].as_py(), group.column("right")[0].as_py(), group.column("own").to_numpy()
        left = np.flatnonzero(own == low)
        links, edges = np.zeros(len(sets), np.int64), []
        for i, j, linked in verified_blocks(sets, left, left if low == high else np.flatnonzero(own == high), threshold):
            np.add.at(links, i, linked @ copies[j])
            np.add.at(links, j, copies[i] @ linked)
            edges += star_edges(i, j, linked)
        there = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([
            pa.array([nodes[i] for i in there] + [nodes[i] for i, _ in edges], pa.binary()), pa.array([*links[there].tolist(), *[0] * len(edges)], pa.int64()),
            pa.array([None] * len(there) + [nodes[j] for _, j in edges], pa.binary())], ["node", "links", "other"])

    return by_group(rows, ["root", "left", "right"], work, "node binary, links long, other binary")


def similarity_join(docs: DataFrame, threshold: float = 0.8, width: int = 5, tolerance: float = 1e-5) -> DataFrame:
    """Join documents whose sets of ``width``-word shingles have a Jaccard similarity of ``threshold`` or more.

    One row per row of ``docs`` (``doc_id, text``; other columns are ignored):
    ``doc_id, text_key, class_id, n_links, first``.  ``n_links`` counts the other
    rows linked to it, equal texts included; ``class_id`` is the smallest
    ``doc_id`` that links lead to, directly or in steps; ``first`` marks the row
    of smallest ``doc_id`` (then ``text_key``, the text's md5) of each class.

    Rows with equal shingle sets are one node with a number of copies, so copies
    are never paired.  A null text is empty; texts without words have equal
    (empty) sets and so form one class.  Null ids sort last and a class without
    any has a null ``class_id``; rows that repeat id and text are copies and all
    marked alike.  An empty table gives no rows.

    A pair of similarity 0.8 shares no band with chance 5e-5; ``tolerance`` is
    the posterior chance below which a pair is dropped.
    """
    key = F.unhex(F.md5(F.encode("text", "UTF-8")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("text_key", key)
    found = staged(signature_rows(texts, width), "signatures")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    nodes = staged(found.groupBy("node").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
                                             F.first("signature").alias("signature"), F.first("keys").alias("keys")), "signature-nodes")
    candidates = components(candidate_edges(nodes, threshold, tolerance))
    members = staged(nodes.join(candidates, "node").select("node", "root", "least", "copies", "n_shingles"), "members")
    sizes = members.groupBy("root").agg(F.sum("n_shingles").alias("root_size"))
    # one row per candidate: it grows with the corpus, so it is never broadcast
    wanted = members.select(F.col("least.doc_id").alias("w"), F.col("least.text_key").alias("k")).hint("merge")
    sets = set_rows(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("w")) & (F.col("text_key") == F.col("k")), "left_semi"), width).dropDuplicates(["node"])
    parts = in_blocks(members.join(sizes, "root").join(sets, "node"), "root", "root_size", "node", 1_500_000)
    pairs = staged(verify(parts.select("root", "left", "right", "own", "node", "copies", "shingles"), threshold), "verified")
    links = pairs.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(pairs.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    classed = (nodes.select("node", "least", "copies").join(roots, "node", "left").join(links, "node", "left")
               .select("node", F.coalesce("root", "node").alias("root"), "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = classed.groupBy("root").agg(F.min("least").alias("first_row"))
    classed = classed.join(least, "root").select("node", "n_links", "first_row")
    mine = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    return (found.select("doc_id", "text_key", "node").join(classed, "node")
            .select("doc_id", "text_key", F.col("first_row.doc_id").alias("class_id"), "n_links", mine.eqNullSafe(F.col("first_row")).alias("first")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are the first of their class, one per class, with the columns of ``docs``."""
    firsts = (similarity_join(docs, **options).filter("first")
              .select(F.col("doc_id").alias("_first_id"), F.col("text_key").alias("_first_key")).distinct())
    key = F.unhex(F.md5(F.encode(F.coalesce(docs["text"].cast("string"), F.lit("")), "UTF-8")))
    rows = docs.join(firsts, docs["doc_id"].cast("long").eqNullSafe(F.col("_first_id")) & (key == F.col("_first_key")))
    return rows.dropDuplicates(["_first_id", "_first_key"]).select(*docs.columns)
