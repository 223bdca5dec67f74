"""MinHash fingerprints of documents, and near copies found by them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bayes_join import in_blocks, verify
from .common import staged, text_batches, text_or_empty
from .graph import components
from .shingles import MinHash, band_keys, distinct_sets, lists_of, shingle_hashes

PERMUTATIONS, WIDTH, SEED = 128, 5, 1
BANDS, ROWS = 25, 5


def fingerprint_rows(texts: list[str], permutations: int = PERMUTATIONS, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """``n x permutations`` values: the low 16 bits of each minimum.

    Equal texts have equal rows; a text without words has 65535 throughout."""
    minhash = MinHash(permutations, seed)
    rows = [minhash.signatures(*shingle_hashes(held, width)) for _, held in text_batches(texts)]
    return (np.concatenate(rows) if rows else np.zeros((0, permutations), np.uint32)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values of two rows: an estimate of the Jaccard similarity of their shingle sets."""
    return (a == b).mean(axis=-1)


def to_hex(rows: np.ndarray) -> list[str]:
    data, step = rows.astype(">u2").tobytes().hex(), rows.shape[1] * 4
    return [data[i:i + step] for i in range(0, len(data), step)]


def edited(text: str, following: str) -> str:
    """The last third of the text's code points replaced by the first as many of the following text."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


FOUND = [("kind", pa.string()), ("part", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
FOUND_DDL = ("kind string, part long, doc_id long, text string, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


def _compare(kind: str, part: int, ids: list, texts: list[str], prints: np.ndarray, following: list[str], following_prints: np.ndarray, compute) -> pa.RecordBatch:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    changed_prints = compute(changed)
    n = len(texts)
    columns = [[kind] * n, [part] * n, ids, [None] * n, [len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
               to_hex(prints), to_hex(changed_prints), likeness(prints, changed_prints), likeness(prints, following_prints)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FOUND, strict=True)], [n for n, _ in FOUND])


def _single(kind: str, part: int, doc_id: int | None, text: str, row: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, "part": part, "doc_id": doc_id, "text": text, "fingerprint": to_hex(row[None, :])[0]}], pa.schema(FOUND))


def fingerprints(docs: DataFrame, permutations: int = PERMUTATIONS, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """Fingerprints of every whole text, of its edited text and their likeness.

    One row per row of ``docs`` (columns ``doc_id, text``; others are ignored):
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  The edited text has its last third from the next document, in
    descending ``doc_id`` (null ids last, repeated ids in order of their texts'
    hashes; after the last the first).  A null text is empty; texts without words
    share one fingerprint.

    Rows are range-partitioned in that order; each task compares neighbours as
    they stream by and hands over its first and last row, which meet in a second,
    small step (two rows per task)."""
    compute = lambda texts: fingerprint_rows(texts, permutations, width, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                ids, texts = (batch.slice(i, 512).column(c).to_pylist() for c in ("doc_id", "text"))
                prints = compute(texts)
                if last is None:
                    yield _single("head", part, ids[0], texts[0], prints[0])
                else:
                    ids, texts, prints = [last[0], *ids], [last[1], *texts], np.concatenate([last[2], prints])
                if len(ids) > 1:
                    yield _compare("row", part, ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], compute)
                last = ids[-1], texts[-1], prints[-1:]
        if last is not None:
            yield _single("tail", part, last[0], last[1], last[2][0])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, following = (batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))
            if ids:
                yield _compare("row", 0, ids, texts, compute(texts), following, compute(following), compute)

    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    found = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, FOUND_DDL), "fingerprints")
    before = F.coalesce(F.lag("part").over(W.orderBy("part")), F.max("part").over(W.partitionBy()))  # one row per task
    heads = found.filter("kind = 'head'").select(before.alias("part"), F.col("text").alias("following"))
    ends = found.filter("kind = 'tail'").select("part", "doc_id", "text").join(heads, "part").mapInArrow(finish, FOUND_DDL)
    return found.filter("kind = 'row'").unionByName(ends).drop("kind", "part", "text")


def shingle_rows(docs: DataFrame, width: int = WIDTH, permutations: int = PERMUTATIONS, bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """``doc_id, node, shingles, keys`` per row: set digest, sorted distinct shingles, band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(permutations, seed)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, held in text_batches(batch.column("text").to_pylist()):
                hashes, counts = shingle_hashes(held, width)
                sets = distinct_sets(hashes, counts)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(held)), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), lists_of(band_keys(minhash.signatures(hashes, counts), bands, rows)),
                ], ["doc_id", "node", "shingles", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, node binary, shingles array<long>, keys array<long>")


def verify_sets(parts: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: edges that connect all verified pairs of each part, from sets held as lists."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([np.array(s, np.int64).tobytes() for s in batch.column("shingles").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), sets], [*kept, "shingles"])

    kept = ["root", "left", "right", "own", "node", "copies"]
    rows = parts.select(*kept, "shingles").mapInArrow(packed, "root long, left int, right int, own int, node binary, copies long, shingles binary")
    return verify(rows, threshold).filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()


def near_copies(docs: DataFrame, threshold: float = 0.8, **options) -> DataFrame:
    """``doc_id, class_id`` per row of ``docs``: documents joined by verified near copies.

    Texts with equal shingle sets are one node.  For all pairs of nodes that share
    a signature band the Jaccard similarity of their shingle sets is computed, in
    pairs of blocks where a band is large, and links of ``threshold`` or more make
    the classes; ``class_id`` is a class's smallest ``doc_id``.  A pair of
    similarity 0.8 shares no band with chance 5e-5.  Null texts are empty; texts without words are one class; a class
    whose ids are all null has a null ``class_id``."""
    found = staged(shingle_rows(docs, **options), "shingles")
    nodes = found.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("shingles").alias("shingles"), F.first("keys").alias("keys"))
    nodes = staged(nodes, "shingle-nodes")
    banded = nodes.select("node", F.explode("keys").alias("root"), F.lit(1).cast("long").alias("copies"), F.size("shingles").alias("n_shingles")).distinct()
    bands_of = banded.groupBy("root").agg(F.sum("n_shingles").alias("band_size"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    parts = in_blocks(banded.join(bands_of, "root").withColumn("band_size", F.greatest("band_size", F.lit(1))), "root", "band_size", "node", 1_500_000)
    sets = nodes.select("node", "shingles")
    links = staged(verify_sets(parts.join(sets, "node"), threshold), "near-links")
    roots = components(links)
    classed = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classed.groupBy("root").agg(F.min("least").alias("class_id"))
    return found.select("doc_id", "node").join(classed.select("node", "root"), "node").join(least, "root").select("doc_id", "class_id")
