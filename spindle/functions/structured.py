"""JSON, path and array functions (SCL-11..SCL-19).

All are JVM-side expressions (higher-order functions for arrays), so they
run inside whole-stage codegen with no Python round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT_COLUMN = "_corrupt_record"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- JSON -------------------------------------------------------------------

# Timestamps travel with microseconds (Spark's JSON default keeps only
# milliseconds, which would not survive a round trip).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def parse_json(x, schema: StructType | str) -> Column:
    """SCL-11: JSON text -> struct.  Malformed text gives a struct of nulls,
    null text a null struct, a field of the wrong type a null field."""
    return F.from_json(_col(x), schema, JSON_OPTIONS)


def is_malformed_json(x) -> Column:
    """True for non-null text that is not a JSON document (quarantine test)."""
    x = _col(x)
    return x.isNotNull() & F.try_parse_json(x).isNull()


def row_to_json(*cols) -> Column:
    """SCL-12: the columns (default all) as one JSON object text; null fields
    are omitted like ``DataFrame.toJSON``."""
    cols = cols or ("*",)
    return F.to_json(F.struct(*[_col(c) for c in cols]), JSON_OPTIONS)


# --- paths ------------------------------------------------------------------

def label_from_path(path, pattern: str) -> Column:
    """SCL-13: first capture group of ``pattern`` in the path, ``''`` when
    there is no match."""
    return F.regexp_extract(_col(path), pattern, 1)


def file_name(path) -> Column:
    return F.substring_index(_col(path), "/", -1)


def file_stem(path) -> Column:
    """SCL-14: file name up to the first dot (``a.b.txt`` -> ``a``)."""
    return F.split_part(file_name(path), F.lit("."), F.lit(1))


# --- arrays -----------------------------------------------------------------

def chw_to_hwc(a, channels: int, height: int, width: int) -> Column:
    """SCL-15: flat channel-major (C,H,W) array -> flat (H,W,C) array, the
    numpy ``reshape(C,H,W).transpose(1,2,0)``."""
    a = _col(a)
    n = channels * height * width

    def src(k):
        h = F.floor(k / (width * channels))
        w = F.floor(k / channels) % width
        c = k % channels
        return c * (height * width) + h * width + w + 1

    out = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                      lambda k: F.element_at(a, src(k).cast("int")))
    return F.when(a.isNotNull(), out)


def argmax(a) -> Column:
    """SCL-16: 0-based position of the largest element, first one on ties."""
    a = _col(a)
    return F.array_position(a, F.array_max(a)) - F.lit(1)


def lookup(idx, names: Sequence[str]) -> Column:
    """SCL-17: 0-based class id -> name; null when out of range."""
    arr = F.array(*[F.lit(n) for n in names])
    return F.try_element_at(arr, _col(idx).cast("int") + F.lit(1))


def normalise_channels(a, mean: Sequence[float], std: Sequence[float]) -> Column:
    """SCL-19: ``(x - mean[c]) / std[c]`` where ``c = i mod len(mean)`` on a
    flat channel-last (H,W,C) array."""
    a = _col(a)
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in std])
    c = len(mean)
    return F.transform(a, lambda x, i: (x.cast("double") - F.element_at(m, (i % c) + 1))
                       / F.element_at(s, (i % c) + 1))


def weighted_position_sum(a) -> Column:
    """``sum(i * a[i])`` in double precision: one number that pins down an
    array's order and values (used to compare array outputs)."""
    a = _col(a)
    return F.aggregate(F.transform(a, lambda x, i: x.cast("double") * i),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
