"""Integer vectors out of floating-point ones, in Arrow batches, and exact sums over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Integers beyond this could let squared distances over 512 components leave 64 bits.
LARGEST = 1 << 26


def whole_vectors(column: str, size: int | None = None):
    """Condition: a list that is not null or empty, holds finite numbers alone and, if given, ``size`` of them."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    held = x.isNotNull() & (F.size(x) == size if size is not None else F.size(x) > 0)
    return held & F.when(held, finite).otherwise(False)


def floored(column: pa.Array, factor: int) -> np.ndarray:
    """``floor(factor * x)`` of lists of equal length, as ``n x size`` 64-bit integers.

    The product is taken in double precision, where a power of two as ``factor`` is exact."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(flat * factor)
    if len(values) and np.abs(values).max() > LARGEST:
        raise OverflowError(f"a component beyond {LARGEST}/{factor} has no squared distance in 64 bits")
    return values.astype(np.int64).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def packed(values: np.ndarray) -> pa.Array:
    """Rows of integers as binary, in the fewest bytes an integer that hold the whole batch."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    wide = np.ascontiguousarray(values, kind)
    step = wide.shape[1] * wide.itemsize
    offsets = pa.py_buffer(np.arange(len(wide) + 1, dtype=np.int32) * np.int32(step))
    return pa.Array.from_buffers(pa.binary(), len(wide), [None, offsets, pa.py_buffer(wide.tobytes())])


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    """What :func:`packed` took, row by row of any width."""
    rows = column.to_pylist()
    widths = np.array([len(r) // size for r in rows], np.int64)
    out = np.zeros((len(rows), size), np.int64)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[at] = np.frombuffer(b"".join([rows[i] for i in at]), f"<i{w}").reshape(len(at), size)
    return out


def first_vectors(kept: DataFrame, key, k: int, size: int, factor: int) -> np.ndarray:
    """``floor(factor * x)`` of the ``k`` vectors of smallest ``key``, null keys last; of equal keys the smaller vector."""
    rows = kept.select(key.alias("key"), "embedding").orderBy(F.asc_nulls_last("key"), "embedding").limit(k).select(F.col("embedding").cast("array<double>").alias("vec")).toArrow()
    return floored(rows.column("vec").combine_chunks(), factor) if rows.num_rows else np.zeros((0, size), np.int64)


def summed(parts: DataFrame, column: str) -> dict[int, int]:
    """Position to exact sum over the lists of ``column``: as many numbers as one list has.

    Tasks combine their own lists first; sums are decimals, which don't overflow."""
    rows = parts.select(F.posexplode(column).alias("place", "value")).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    return {r.place: int(r.total) for r in rows}
