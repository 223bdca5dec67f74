"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; where it is the smallest of some
window of bytes a chunk ends, at the next word.  The hash sees the last 16 bytes
alone, so after an insertion the same chunks come again, and as no window goes
without a boundary every passage of about 225 bytes holds a whole chunk.  Chunks
are compared by digest over the whole corpus; a run of chunks that stand
elsewhere before is extended by the equal bytes beside it and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Staged, staged, text_batches, text_or_empty
from .shingles import SPACE

WINDOW = 16
AVERAGE_BYTES = 48
MAX_CHUNK = 2048
MIN_RUN = 100
CONTEXT = 256  # bytes compared beside a run; a common boundary lies within 175 of a passage's ends (16 of the hash, 95 of a window, 64 to a word)
PLACE = 4096  # more than a chunk is long: a start and a length in one integer
COMMON = 4096  # a digest of more than one chunk in so many, and of LEAST at least, is common
LEAST = 1000
BLOCK = 1 << 20  # chunks that are counted at a time
PLACES = ["doc_id", "text_key", "place", "first_id", "first_key", "first_place"]


def gear_table(seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 16, 256, np.uint16)


GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The hash after each byte: the sum of ``gear[byte] << distance`` over the last 16 bytes, modulo 2**16."""
    h, done = GEAR[data], 1
    while done < WINDOW:  # each step doubles the bytes that a value sees
        h[done:] = h[done:] + (h[:-done] << np.uint16(done))
        done *= 2
    return h


def smallest(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the smallest of a window (the last of equal ones); of equal ones in a row, one a window."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    low, done = (hashes.astype(np.int64) << 40) | np.arange(n, 0, -1), 1
    while done < window:  # each step doubles the places that a value sees, at most to the window
        step = min(done, window - done)
        low, done = np.minimum(low[:-step], low[step:]), done + step
    found = n - np.unique(low & ((1 << 40) - 1))[::-1]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (hashes[found[1:]] != hashes[found[:-1]]) | (np.diff(found) >= window)
    since = found - np.maximum.accumulate(np.where(fresh, found, 0))
    kept = fresh.copy()
    kept[1:] |= since[1:] // window != since[:-1] // window
    return found[kept]


def boundaries(texts: list[bytes], average: int = AVERAGE_BYTES, most: int = MAX_CHUNK) -> list[np.ndarray]:
    """For each text the places where chunks begin, and its length.

    Of every ``2 * average - 1`` hashes in a row one at least ends a chunk, by what
    stands there alone, and one of ``average`` does on average.  A boundary is moved on to the next start of a word, or, where there is none
    within 64 bytes, of a character.  Chunks over ``most`` bytes are cut evenly."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    found, end = [], 0
    for text in texts:  # the bytes before a text's first have no part in its hashes
        own, end = data[end:end + len(text)], end + len(text)
        if not len(own):
            found.append(np.zeros(1, np.int64))
            continue
        cut = smallest(gear_hashes(own), 2 * average - 1) + 1
        space = SPACE[own]
        word = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        if len(word):
            near = word[np.minimum(np.searchsorted(word, cut), len(word) - 1)]
            moved = np.where((near >= cut) & (near < cut + 64), near, -1)
        else:
            moved = np.full(len(cut), -1)
        odd = np.flatnonzero(moved < 0)
        if len(odd):
            character = np.flatnonzero((own & 0xC0) != 0x80)
            at = np.searchsorted(character, cut[odd])
            moved[odd] = np.where(at < len(character), character[np.minimum(at, len(character) - 1)], len(own))
        places = np.unique(np.concatenate([[0], moved, [len(own)]]))
        wide = np.flatnonzero(np.diff(places) > most)
        if len(wide):
            character = np.flatnonzero((own & 0xC0) != 0x80)
            more = np.concatenate([np.arange(places[w] + most, places[w + 1], most) for w in wide])
            places = np.unique(np.concatenate([places, character[np.minimum(np.searchsorted(character, more), len(character) - 1)]]))
        found.append(places)
    return found


def chunks(texts: DataFrame, average: int = AVERAGE_BYTES, digest_bytes: int = 8) -> DataFrame:
    """``digest, doc_id, text_key, place`` per chunk; ``place`` is ``start * PLACE + length`` in bytes of the text in UTF-8."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = bytes(8 - digest_bytes)
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_key"))
            for first, held in text_batches(batch.column("text").to_pylist()):
                places = boundaries(held, average)
                counts = np.array([len(p) - 1 for p in places])
                if not counts.sum():
                    continue
                starts, stops = np.concatenate([p[:-1] for p in places]), np.concatenate([p[1:] for p in places])
                digests = b"".join([hashlib.blake2b(t[a:b], digest_size=digest_bytes).digest() + rest for t, p in zip(held, places, strict=True) for a, b in zip(p[:-1].tolist(), p[1:].tolist(), strict=True)])
                rows = slice(first, first + len(held))
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(digests, "<i8")), pa.array(np.repeat(ids[rows], counts)), pa.array(np.repeat(keys[rows], counts)),
                                                  pa.array(starts * PLACE + stops - starts)], ["digest", "doc_id", "text_key", "place"])

    return texts.mapInArrow(run, "digest long, doc_id long, text_key long, place long")


def common_digests(found: DataFrame) -> list[int]:
    """Digests that are one in ``COMMON`` of all chunks: at most ``COMMON`` of them.

    Every block of chunks counts those that are one in ``COMMON`` of it; what a block
    leaves out is less than that, so every digest twice as common is found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column("digest").to_numpy())
            size += len(held[-1])
            if size >= BLOCK:
                yield heavy(np.concatenate(held))
                held, size = [], 0
        if size:
            yield heavy(np.concatenate(held))

    def heavy(digests: np.ndarray) -> pa.RecordBatch:
        values, counts = np.unique(digests, return_counts=True)
        kept = (counts > 1) & (counts * COMMON >= len(digests))
        return pa.RecordBatch.from_arrays([pa.array(values[kept]), pa.array(counts[kept].astype(np.int64))], ["digest", "n"])

    seen = found.select("digest").mapInArrow(run, "digest long, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    often = seen.filter((F.col("n") >= LEAST) & (F.col("n") * COMMON >= found.agg(F.count(F.lit(1))).scalar()))
    return [r.digest for r in often.select("digest").collect()]


def later_places(found: DataFrame) -> DataFrame:
    """``doc_id, text_key, place, first_id, first_key, first_place`` of chunks that are not the first of their digest.

    Chunks are sorted by digest, each shipped once, and passed in a row behind their
    first.  Common digests are kept out of that: their firsts come from an aggregate
    that every task combines beforehand (``COMMON`` rows at most) and are looked up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, first = None, np.zeros((1, 3), np.int64)
        last = first
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("digest").to_numpy()
            place = np.stack([batch.column(c).to_numpy() for c in ("doc_id", "text_key", "place")], axis=1)
            fresh = np.concatenate([[digest is None or values[0] != digest], values[1:] != values[:-1]])
            firsts = np.concatenate([first, place[fresh]])
            of = firsts[np.cumsum(fresh)]
            # rows that repeat a document repeat its places too
            again = np.concatenate([[not fresh[0] and (place[0] == last[0]).all()], (place[1:] == place[:-1]).all(axis=1) & ~fresh[1:]])
            kept = ~fresh & ~again & (place != of).any(axis=1)
            digest, first, last = values[-1], of[-1:], place[-1:]
            yield pa.RecordBatch.from_arrays([pa.array(x[kept, i]) for x in (place, of) for i in range(3)], PLACES)

    common = common_digests(found)
    often = F.col("digest").isin(common)
    rare = (found.filter(~often) if common else found).repartition("digest").sortWithinPartitions("digest", "doc_id", "text_key", "place")
    later = rare.select("digest", "doc_id", "text_key", "place").mapInArrow(run, ", ".join(f"{c} long" for c in PLACES))
    if not common:
        return later
    rows = found.filter(often).groupBy("digest").agg(F.min(F.struct("doc_id", "text_key", "place")).alias("first")).select("digest", "first.*").orderBy("digest").toArrow()
    known, firsts = (np.stack([rows.column(c).to_numpy() for c in names], axis=1) for names in (["digest"], ["doc_id", "text_key", "place"]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("doc_id", "text_key", "place")], axis=1)
            of = firsts[np.searchsorted(known[:, 0], batch.column("digest").to_numpy())]
            kept = (place != of).any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x[kept, i]) for x in (place, of) for i in range(3)], PLACES)

    return later.unionByName(found.filter(often).select("digest", "doc_id", "text_key", "place").mapInArrow(look_up, ", ".join(f"{c} long" for c in PLACES)))


def reach_left(own: bytes, other: bytes) -> int:
    """How many bytes before two equal chunks are equal, from the start of a word (or, where none is within 64 bytes, of a character)."""
    n = most = min(len(own), len(other))
    if own[len(own) - most:] != other[len(other) - most:]:
        n = next(k for k in range(most) if own[-1 - k] != other[-1 - k])

    def starts_word(k: int) -> bool:
        return not SPACE[own[-k]] and all(SPACE[t[-k - 1]] if k < len(t) else k < CONTEXT for t in (own, other))

    word = next((k for k in range(n, 0, -1) if starts_word(k)), 0)
    return word if n - word < 64 else next((k for k in range(n, word, -1) if own[-k] & 0xC0 != 0x80), word)


def reach_right(own: bytes, other: bytes) -> int:
    """How many bytes after two equal chunks are equal, up to an edge of a word (or, where none is within 64 bytes, of a character)."""
    n = most = min(len(own), len(other))
    if own[:most] != other[:most]:
        n = next(k for k in range(most) if own[k] != other[k])

    def ends_word(k: int) -> bool:
        if k < len(own) and not SPACE[own[k]]:
            return bool(SPACE[own[k - 1]])
        return all(SPACE[t[k]] if k < len(t) else k < CONTEXT for t in (own, other))

    word = next((k for k in range(n, 0, -1) if ends_word(k)), 0)
    return word if n - word < 64 else next((k for k in range(n, word, -1) if k < len(own) and own[k] & 0xC0 != 0x80), word)


def extended(pairs: DataFrame) -> DataFrame:
    """``doc_id, text_key, start, stop, kept_in``: the stretches of ``pairs``, with the equal bytes beside them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, after, first_before, first_after = (batch.column(c).to_pylist() for c in ("before", "after", "first_before", "first_after"))
            left = np.array([reach_left(a, b) for a, b in zip(before, first_before, strict=True)], np.int32)
            right = np.array([reach_right(a, b) for a, b in zip(after, first_after, strict=True)], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(batch.column("start").to_numpy() - left, pa.int32()),
                                              pa.array(batch.column("stop").to_numpy() + right, pa.int32()), batch.column("first_id")],
                                             ["doc_id", "text_key", "start", "stop", "kept_in"])

    return pairs.mapInArrow(run, "doc_id long, text_key long, start int, stop int, kept_in long")


def repeated_spans(docs: DataFrame, average: int = AVERAGE_BYTES, min_run: int = MIN_RUN, digest_bytes: int = 8) -> DataFrame:
    """``doc_id, text_key, spans`` of the documents from which something is cut; see :func:`remove_repeats`."""
    found = Staged(chunks(docs.select("doc_id", "text_key", "text"), average, digest_bytes), "chunks")
    start, first_start = (F.floor(F.col(c) / PLACE).cast("int") for c in ("place", "first_place"))
    later = later_places(found.rows).select("doc_id", "text_key", start.alias("start"), (start + F.pmod("place", F.lit(PLACE)).cast("int")).alias("stop"), "first_id", "first_key", first_start.alias("first_start"))
    # chunks that follow one another make a run; a run's number is that of the gaps before it
    order = W.partitionBy("doc_id", "text_key").orderBy("start")
    fresh = F.when(F.col("start") == F.lag("stop").over(order), 0).otherwise(1)
    runs = later.dropDuplicates(["doc_id", "text_key", "start"]).withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    # a run's chunks whose first places lie in one text at one distance make a stretch
    stretches = staged(runs.groupBy("doc_id", "text_key", "run", "first_id", "first_key", (F.col("first_start") - F.col("start")).alias("shift"))
                       .agg(F.min("start").alias("start"), F.max("stop").alias("stop")), "stretches")
    found.discard()  # nothing reads the chunks any more
    raw = docs.select("doc_id", "text_key", F.encode("text", "UTF-8").alias("raw")).dropDuplicates(["doc_id", "text_key"])
    before = lambda p: F.substring("raw", F.greatest(p.start - CONTEXT, F.lit(0)) + 1, F.least(p.start, F.lit(CONTEXT)))
    after = lambda p: F.substring("raw", p.stop + 1, F.lit(CONTEXT))
    whole = lambda p: F.xxhash64(F.substring("raw", p.start + 1, p.stop - p.start))
    own = stretches.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "stop", "first_id", "first_key", "shift")).alias("places"))
    own = raw.join(own, ["doc_id", "text_key"]).select("doc_id", "text_key", F.inline(F.transform("places", lambda p: F.struct(
        p.start.alias("start"), p.stop.alias("stop"), p.first_id.alias("first_id"), p.first_key.alias("first_key"), (p.start + p.shift).alias("first_start"), (p.stop + p.shift).alias("first_stop"),
        before(p).alias("before"), after(p).alias("after"), whole(p).alias("whole")))))
    theirs = (stretches.select(F.col("first_id").alias("doc_id"), F.col("first_key").alias("text_key"), (F.col("start") + F.col("shift")).alias("start"), (F.col("stop") + F.col("shift")).alias("stop")).distinct()
              .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "stop")).alias("places")))
    theirs = raw.join(theirs, ["doc_id", "text_key"]).select(F.col("doc_id").alias("first_id"), F.col("text_key").alias("first_key"), F.inline(F.transform("places", lambda p: F.struct(
        p.start.alias("first_start"), p.stop.alias("first_stop"), before(p).alias("first_before"), after(p).alias("first_after"), whole(p).alias("first_whole")))))
    # chunks of equal digest by chance don't stand in both texts
    pairs = own.join(theirs, ["first_id", "first_key", "first_start", "first_stop"]).filter("whole = first_whole").select("doc_id", "text_key", "start", "stop", "first_id", "before", "after", "first_before", "first_after")
    # stretches that meet make a span
    so_far = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    spans = extended(pairs).withColumn("fresh", F.when(F.col("start") <= so_far, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "text_key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("kept_in").alias("kept_in"))
    spans = spans.filter(F.col("stop") - F.col("start") >= min_run)
    return spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "kept_in"))).alias("spans"))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as ``doc_id, text_key, text``; a null id counts as the smallest, kept apart by its text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text"))


def remove_repeats(docs: DataFrame, average: int = AVERAGE_BYTES, min_run: int = MIN_RUN, digest_bytes: int = 8) -> DataFrame:
    """The rows of ``docs`` with their columns, and ``kept_text, removed_bytes, spans``.

    A chunk stands first in the document of smallest ``doc_id`` (null is smaller
    than any) and there at its first place; elsewhere it is repeated.  Repeated
    chunks that follow one another make a run, with the bytes beside them that equal
    those beside the first places, in whole words; runs of ``min_run`` bytes or more
    are cut out.  ``spans`` lists them as ``(start, stop, kept_in)`` in bytes, with the
    smallest ``doc_id`` that keeps one of their chunks.  Shorter runs stay, so
    common phrases do.  Digests have ``8 * digest_bytes`` bits; what they match is
    compared once more by another hash of both texts before it is cut.  Columns of
    ``docs`` with these names are replaced.

    A null text is empty, and what is cut whole leaves an empty text.  Rows that
    repeat ``doc_id`` and text are one document and stay alike.  Very long texts
    are cut by the same rule; nothing bounds how often a chunk may repeat.
    """
    docs = docs.drop("kept_text", "removed_bytes", "spans")
    spans = repeated_spans(keyed(docs), average, min_run, digest_bytes).select(F.col("doc_id").alias("_cut_id"), F.col("text_key").alias("_cut_key"), F.col("spans").alias("_cut_spans"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    own_id = F.coalesce(docs["doc_id"].cast("long"), F.lit(-(2**63)))
    rows = docs.join(spans, (own_id == F.col("_cut_id")) & (F.xxhash64(text) == F.col("_cut_key")), "left").drop("_cut_id", "_cut_key")
    # the bytes between the spans, joined; spans are at starts of characters
    raw = F.encode(text, "UTF-8")
    stops = F.concat(F.array(F.lit(0)), F.transform("_cut_spans", lambda s: s.stop))
    starts = F.concat(F.transform("_cut_spans", lambda s: s.start), F.array(F.octet_length(raw)))
    pieces = F.zip_with(stops, starts, lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8"))
    removed = F.coalesce(F.aggregate("_cut_spans", F.lit(0).cast("long"), lambda a, s: a + s.stop - s.start), F.lit(0).cast("long"))
    return rows.select(*docs.columns, F.when(F.col("_cut_spans").isNull(), text).otherwise(F.array_join(pieces, "")).alias("kept_text"), removed.alias("removed_bytes"),
                       F.transform("_cut_spans", lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"), F.nullif(s.kept_in, F.lit(-(2**63))).alias("kept_in"))).alias("spans"))
