"""Word shingles and MinHash values of many texts at once, in numpy.

Words are runs of bytes that are not ASCII white space.  A text with fewer
words than a shingle has one shingle of all its words; a text without words
has none.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 4096), _BASE, np.uint64)
        more[0] = 1
        _powers = np.cumprod(more)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[bytes], values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of every word in order, number of words of each text)``.

    ``values`` maps bytes to what is hashed (default: the byte itself)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    held = ~SPACE[data]
    edge = np.diff(held.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = data[held]
    value = letters.astype(np.uint64) + np.uint64(1) if values is None else values[letters]
    return mix(np.add.reduceat(value * powers(int(lengths.max()))[place], first)), counts


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of every shingle in order, number of shingles of each text)``."""
    words, counts = word_hashes(texts)
    made = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    ends = np.cumsum(counts)
    first = np.repeat(ends - counts, made) + np.arange(int(made.sum())) - np.repeat(np.cumsum(made) - made, made)
    last = np.repeat(ends, made)
    total = np.zeros(len(first), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k, factor in enumerate(mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)):
        at = first + k
        total += np.where(at < last, padded[at] * factor, np.uint64(0))
    return mix(total), made


def distinct_sets(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    return [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])] if len(counts) else []


class MinHash:
    """``n`` universal hash permutations ``(a * x + b) >> 32`` of 64-bit shingles, seeded."""

    def __init__(self, n: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, n, np.uint64)

    def signatures(self, hashes: np.ndarray, counts: np.ndarray, piece: int = 1 << 14) -> np.ndarray:
        """``len(counts) x n`` minima; a text without shingles has the largest value throughout."""
        out = np.full((len(counts), len(self.a)), 0xFFFFFFFF, np.uint32)
        ends = np.cumsum(counts)
        full = np.flatnonzero(counts)
        i = 0
        while i < len(full):  # pieces of shingles that stay in the processor's cache
            begin = ends[full[i]] - counts[full[i]]
            j = max(i + 1, int(np.searchsorted(ends[full], begin + piece, side="right")))
            texts = full[i:j]
            if j == i + 1 and counts[full[i]] > piece:
                for s in range(int(begin), int(ends[full[i]]), piece):
                    x = hashes[s:min(s + piece, int(ends[full[i]]))]
                    for k in range(len(self.a)):
                        out[full[i], k] = min(out[full[i], k], ((x * self.a[k] + self.b[k]) >> np.uint64(32)).min())
            else:
                x = hashes[begin:ends[texts[-1]]]
                starts = (ends[texts] - counts[texts] - begin).astype(np.intp)
                for k in range(len(self.a)):
                    out[texts, k] = np.minimum.reduceat((x * self.a[k] + self.b[k]) >> np.uint64(32), starts)
            i = j
        return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``n x bands`` 64-bit keys; equal keys of a band mean equal values there.  The band's number is part of the key."""
    keys = np.repeat(mix(np.arange(1, bands + 1, dtype=np.uint64))[None, :], len(signatures), 0)
    for r in range(rows):
        keys = mix(keys ^ signatures[:, r:bands * rows:rows].astype(np.uint64)) + np.uint64(r)
    return keys.view(np.int64)


def lists_of(values: np.ndarray):
    """An Arrow list column out of an ``n x k`` array."""
    import pyarrow as pa

    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(values.reshape(-1)))
