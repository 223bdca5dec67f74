"""Vector codes by product quantisation, with adaptive distance bounds.

Vectors of integers are cut into parts; each part position has a codebook.  For
every part the ``b`` entries next closest to its own are persisted with ordered
lower bounds on their distances, one outer bound holds for all other entries, and
an upper bound for its own.  When entries move, bounds move by as much.  Where
the lower bounds stay above the upper one nothing is computed; else the exact
integer distances of the entries in doubt decide, and of all entries where the
outer bound is in doubt.  ``b`` shrinks to what a round needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged, staged
from .vectors import first_vectors, floored, packed, summed, unpacked, whole_vectors

STATE = "vec_id long, label {label}, vec binary, state binary, sums array<long>"


def up(x: np.ndarray) -> np.ndarray:
    """A 32-bit float not below ``x``."""
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def bounds_type(parts: int, b: int) -> np.dtype:
    """What is kept of a vector: per part its entry, the ``b`` next closest, and the bounds."""
    return np.dtype([("code", "u1", (parts,)), ("near", "u1", (parts, b)), ("upper", "<f4", (parts,)), ("low", "<f4", (parts, b)), ("outer", "<f4", (parts,))])


def exact(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``n x w`` to entries ``n x m x w`` (or ``m x w``, the same for all)."""
    diff = x[:, None, :] - (entries if entries.ndim == 3 else entries[None])
    return np.einsum("nmw,nmw->nm", diff, diff)


def from_scratch(x: np.ndarray, book: np.ndarray, state: np.ndarray, rows, p: int) -> None:
    """Entry, next closest ones and bounds of part ``p`` out of all distances."""
    d = exact(x, book)
    b = state.dtype["near"].shape[1]
    order = np.argsort(d, axis=1, kind="stable")  # of equal distances the lower index first
    ranked = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
    state["code"][rows, p] = order[:, 0]
    state["upper"][rows, p] = up(ranked[:, 0])
    state["near"][rows, p] = order[:, 1:1 + b]
    state["low"][rows, p] = down(ranked[:, 1:1 + b])
    state["outer"][rows, p] = down(ranked[:, 1 + b]) if book.shape[0] > 1 + b else np.float32(np.inf)


def refine(x: np.ndarray, book: np.ndarray, moved: np.ndarray, state: np.ndarray, p: int) -> np.ndarray:
    """Bring part ``p`` of all rows up to date after the entries moved by ``moved``; how many near entries each row had to look at.

    ``b + 1`` stands for all entries, -1 for not even its own."""
    code, b = state["code"][:, p].astype(np.intp), state.dtype["near"].shape[1]
    upper = up(state["upper"][:, p] + moved[code])
    outer = down(state["outer"][:, p] - moved.max())
    near = state["near"][:, p].astype(np.intp)
    low = down(state["low"][:, p] - moved[near])
    # in order again: a bound holds for its entry and all that follow
    low = np.minimum.accumulate(np.concatenate([low, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    outer = low[:, b]
    looked = np.full(len(x), -1, np.int8)
    doubt = np.flatnonzero(low[:, 0] <= upper)
    if len(doubt):
        own = exact(x[doubt], book[code[doubt]][:, None, :])[:, 0]
        upper[doubt] = up(np.sqrt(own.astype(np.float64)))
        needed = (low[doubt] <= upper[doubt, None]).sum(axis=1)  # low is ascending
        looked[doubt] = needed
        for m in range(1, b + 1):
            at = needed == m
            if not at.any():
                continue
            rows = doubt[at]
            tried = np.concatenate([code[rows, None], near[rows, :m]], axis=1)
            d = np.concatenate([own[at][:, None], exact(x[rows], book[tried[:, 1:]])], axis=1)
            order = np.lexsort((tried, d), axis=1)
            tried, d = np.take_along_axis(tried, order, 1), np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
            code[rows], upper[rows] = tried[:, 0], up(d[:, 0])
            near[rows, :m], low[rows, :m] = tried[:, 1:], down(d[:, 1:])
    state["code"][:, p], state["near"][:, p] = code, near
    state["upper"][:, p], state["low"][:, p], state["outer"][:, p] = upper, low[:, :b], outer
    every = np.flatnonzero(looked == b + 1)
    if len(every):
        from_scratch(x[every], book, state, every, p)
    return looked


def shrunk(state: np.ndarray, parts: int, b: int) -> np.ndarray:
    """The state with ``b`` near entries a part: the outer bound takes in those left out."""
    old = state.dtype["near"].shape[1]
    if b == old:
        return state.copy()
    new = np.zeros(len(state), bounds_type(parts, b))
    for name in ("code", "upper"):
        new[name] = state[name]
    new["near"], new["low"] = state["near"][:, :, :b], state["low"][:, :, :b]
    new["outer"] = np.minimum(state["outer"], state["low"][:, :, b:].min(axis=2))
    return new


def entry_sums(x: np.ndarray, code: np.ndarray, k: int, sign: int, into: np.ndarray) -> None:
    """Add (or take away) counts and sums of each entry's parts."""
    into[:, 0] += sign * np.bincount(code, minlength=k)
    order = np.argsort(code, kind="stable")
    held, first = np.unique(code[order], return_index=True)
    if len(held):
        into[held, 1:] += sign * np.add.reduceat(x[order], first, axis=0)


def assign_pass(rows: DataFrame, label: str, books: np.ndarray, moved: np.ndarray | None, old_b: int, b: int) -> DataFrame:
    """One round over all vectors: their new state, and a row per task of what changed.

    ``sums`` holds, per part and entry, the change of the count and of the sums of
    its parts, and after that how many parts looked at none, 1, ... near entries."""
    parts, k, w = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change, needs = np.zeros((parts, k, 1 + w), np.int64), np.zeros(old_b + 3, np.int64)
        label_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            n, label_type = batch.num_rows, batch.column("label").type
            x = unpacked(batch.column("vec"), parts * w).reshape(n, parts, w)
            if moved is None:
                state = np.zeros(n, bounds_type(parts, b))
                for p in range(parts):
                    from_scratch(x[:, p], books[p], state, np.arange(n), p)
                    entry_sums(x[:, p], state["code"][:, p], k, 1, change[p])
            else:
                state = np.frombuffer(b"".join(batch.column("state").to_pylist()), bounds_type(parts, old_b)).copy()
                before = state["code"].copy()
                for p in range(parts):
                    needs += np.bincount(refine(x[:, p], books[p], moved[p], state, p) + 1, minlength=old_b + 3)
                    at = np.flatnonzero(before[:, p] != state["code"][:, p])
                    entry_sums(x[at, p], before[at, p], k, -1, change[p])
                    entry_sums(x[at, p], state["code"][at, p], k, 1, change[p])
                state = shrunk(state, parts, b)
            held = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(state.itemsize)), pa.py_buffer(state.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("vec"), held, pa.nulls(n, pa.list_(pa.int64()))], ["vec_id", "label", "vec", "state", "sums"])
        if label_type is not None:
            total = pa.array([np.concatenate([change.ravel(), needs]).tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, label_type), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), total], ["vec_id", "label", "vec", "state", "sums"])

    return rows.mapInArrow(run, STATE.format(label=label))


def coded(rows: DataFrame, label: str, books: np.ndarray, b: int) -> DataFrame:
    """``vec_id, label, code, error`` out of the last state: the error is the exact squared distance to the own entries."""
    parts, k, w = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpacked(batch.column("vec"), parts * w).reshape(batch.num_rows, parts, w)
            state = np.frombuffer(b"".join(batch.column("state").to_pylist()), bounds_type(parts, b))
            diff = x - books[np.arange(parts)[None, :], state["code"]]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([bytes(c).hex() for c in state["code"]], pa.string()), pa.array(np.einsum("npw,npw->n", diff, diff))],
                                             ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def next_b(needs: np.ndarray, b: int, least: int, spare: float = 0.01) -> int:
    """The fewest near entries, ``least`` at least, that would have served all but a share ``spare`` of the parts that ``b`` served."""
    served = needs[:b + 2].cumsum()  # place 0: not even its own entry looked at; place i: i - 1 near entries
    enough = np.flatnonzero(served >= (1 - spare) * served[-1])
    return min(b, max(least, int(enough[0]) - 1))


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def train_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, factor: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every kept vector, and the final codebooks (``parts x entries x width``).

    See :func:`compress` for the rules."""
    if entries > 256:
        raise ValueError("a code has one byte a part")
    label = dict(vectors.dtypes)["label"]
    kept = vectors.filter(whole_vectors("embedding"))
    head = kept.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("n")).head()
    if head is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {label}, code string, error long"), np.zeros((parts, 0, 0), np.int64)
    size = head.n
    if size % parts:
        raise ValueError(f"vectors of {size} components don't make {parts} equal parts")
    kept = kept.filter(F.size("embedding") == size)
    books = first_vectors(kept, F.col("vec_id").cast("long"), entries, size, factor)
    k, w = len(books), size // parts
    books = np.ascontiguousarray(books.reshape(k, parts, w).transpose(1, 0, 2))

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), packed(floored(batch.column("vec"), factor)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64()))],
                                                 ["vec_id", "label", "vec", "state", "sums"])

    rows = kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vec")).mapInArrow(integers, STATE.format(label=label))
    least = min(max(1, entries // 8), k - 1)
    b = old_b = min(max(1, entries // 4), k - 1)
    totals, moved, state = [0] * (parts * k * (1 + w)), None, None
    for turn in range(rounds + 1):
        last = state
        state = Staged(assign_pass(rows, label, books, moved, old_b, b), "codes-round")
        rows, old_b = state.rows.filter("sums IS NULL"), b
        if last is not None:
            last.discard()  # the new state is on disk; nothing reads the old one
        if turn == rounds:
            break
        got = summed(state.rows.filter("sums IS NOT NULL"), "sums")
        totals = [t + got[i] for i, t in enumerate(totals)]
        whole = np.array(totals, object).reshape(parts, k, 1 + w)
        used, before = whole[:, :, 0] > 0, books
        books = books.copy()
        books[used] = (whole[:, :, 1:][used] // whole[:, :, :1][used]).astype(np.int64)
        moved = np.sqrt(((books - before) ** 2).sum(axis=2).astype(np.float64)) * (1 + 1e-9)
        if not moved.any():
            break  # no entry moves, so no later round changes anything
        if turn:
            b = next_b(np.array([got[len(totals) + i] for i in range(old_b + 3)]), old_b, least)
    return coded(rows, label, books, old_b), books


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, factor: int = 4096) -> DataFrame:
    """Per kept vector ``vec_id, code, error, label_error, codebooks_sha256``.

    Dropped are vectors that are null or empty, or hold null, NaN or infinite
    components, and those of another length than the vector of smallest ``vec_id``
    has.  A component ``x`` becomes ``floor(factor * x)``.  A part position's
    codebook starts as that part of the ``entries`` smallest ids; each round every
    part goes to its nearest entry (ties: the lower index) and each used entry moves
    to the floor of its parts' mean.  ``label_error`` sums errors over equal labels,
    nulls together.

    Rows that repeat an id or a vector count each; those of equal id become
    entries in the order of their vectors, null ids last.  With fewer vectors than
    entries the codebooks are smaller.  A table without kept vectors gives no rows.
    A length that ``parts`` does not divide raises, as do components beyond 2**26 /
    ``factor`` (squared distances would leave 64 bits).  Other columns are ignored."""
    found, books = train_codes(vectors, parts, entries, rounds, factor)
    found = staged(found, "vector-codes")
    errors = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_of")
    return found.join(errors, found["label"].eqNullSafe(errors["_of"])).select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
