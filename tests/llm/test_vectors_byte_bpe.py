"""Centroid clustering, vector codes and byte-level BPE against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import types as T

from spindle.llm import byte_bpe, centroids, codes
from spindle.llm.queries import vocabulary

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        # names that the operators use themselves
                        T.StructField("cluster", T.StringType()), T.StructField("vec", T.StringType()), T.StructField("error", T.StringType()), T.StructField("sums", T.StringType())])


def vector_rows(size, n=300, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.4, (5, size))
    rows = [(i, (middles[i % 5] + rng.normal(0, 0.1, size)).astype(np.float32).tolist(), i % 4 if i % 7 else None) for i in range(n)]
    bad = [None, [], [1.0] * (size - 1) + [math.nan], [math.inf] + [0.0] * (size - 1), [None] + [0.0] * (size - 1)]
    rows += [(n + i, v, 1) for i, v in enumerate(bad)]
    rows += [(n + 20 + i, [0.25] * size, 2) for i in range(40)]  # equal vectors, more than there are centroids
    rows += [(3, rows[3][1], 1), (3, rows[4][1], 1), (None, rows[5][1], None)]  # an id repeated, a null id
    return rows


def with_names(rows):
    return [(*r, "a", "b", "c", "d") for r in rows]


def whole(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def mean(vs):
    return [sum(c) // len(vs) for c in zip(*vs, strict=True)]


def brute_clusters(rows, k, rounds, size, factor):
    kept = [(i, tuple(v), [math.floor(factor * x) for x in v]) for i, v, _ in rows if v and len(v) == size and whole(v)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    middles = [r[2] for r in ranked[:k]]
    for turn in range(rounds + 1):
        near = [min((squared(v, m), c) for c, m in enumerate(middles)) for _, _, v in kept]
        if turn < rounds:
            middles = [mean(own) if (own := [v for (_, _, v), (_, c) in zip(kept, near, strict=True) if c == j]) else m for j, m in enumerate(middles)]
    total = sum(d for d, _ in near)
    return sorted(((i, c, d, sum(e for e, o in near if o == c), total, hashlib.sha256(",".join(map(str, middles[c])).encode()).hexdigest()) for (i, _, _), (d, c) in zip(kept, near, strict=True)), key=str)


def brute_codes(rows, parts, entries, rounds, factor):
    kept = [(i, tuple(v), lab, [math.floor(factor * x) for x in v]) for i, v, lab in rows if whole(v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[3]) == len(first[0][3])]
    first = [r for r in first if len(r[3]) == len(first[0][3])][:entries]
    w = len(first[0][3]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(r[3], p) for r in first] for p in range(parts)]
    for turn in range(rounds + 1):
        near = [[min((squared(cut(r[3], p), m), c) for c, m in enumerate(books[p])) for p in range(parts)] for r in kept]
        if turn < rounds:
            books = [[mean(own) if (own := [cut(r[3], p) for r, a in zip(kept, near, strict=True) if a[p][1] == c]) else m for c, m in enumerate(books[p])] for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for m in b for x in m).encode()).hexdigest()
    errors = [sum(d for d, _ in a) for a in near]
    return sorted(((r[0], "".join(f"{c:02x}" for _, c in a), e, sum(f for q, f in zip(kept, errors, strict=True) if q[2] == r[2]), digest) for r, a, e in zip(kept, near, errors, strict=True)), key=str)


@pytest.mark.parametrize("most_values", [1 << 18, 3])  # one table for all, and one for each batch
def test_clusters_equal_brute_force(spark, most_values):
    rows = vector_rows(12) + [(900, [0.5] * 11, 1), (901, [0.5] * 13, 1)]
    df = spark.createDataFrame(with_names(rows), VECTORS).repartition(5)
    got = centroids.cluster(df, k=16, rounds=3, size=12, factor=64, most_values=most_values)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, 16, 3, 12, 64)


def test_clusters_of_few_and_no_vectors(spark):
    rows = [(2, [0.5, -0.5], 1), (1, [0.5, -0.5], 1), (7, [-3.0, 2.0], None)]
    got = centroids.cluster(spark.createDataFrame(with_names(rows), VECTORS), size=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, 16, 3, 2, 64)
    assert centroids.cluster(spark.createDataFrame([], VECTORS)).count() == 0
    assert centroids.cluster(spark.createDataFrame(with_names([(1, None, 1), (2, [1.0], 1)]), VECTORS)).count() == 0


def test_table_distances():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-9, 9, (500, 6)), rng.integers(-9, 9, (7, 6))
    values = [np.unique(x[:, d]) for d in range(6)]
    number, distance = centroids.nearest_centroids(x, c, values, centroids.table_of(values, c))
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_codes_equal_brute_force(spark):
    rows = vector_rows(8) + [(950, [0.5] * 4, 1)]
    df = spark.createDataFrame(with_names(rows), VECTORS).repartition(5)
    got = codes.compress(df, parts=4, entries=16, rounds=6, factor=4096)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, 4, 16, 6, 4096)


def test_codes_of_few_and_no_vectors(spark):
    for rows in ([(2, [0.5, -0.5], 1)], [(2, [0.5, -0.5], 1), (1, [0.5, 0.5], None), (7, [-3.0, 2.0], None), (7, [-3.0, 2.0], None)]):
        got = codes.compress(spark.createDataFrame(with_names(rows), VECTORS), parts=2)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, 2, 16, 6, 4096)
    assert codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame(with_names([(1, [1.0] * 7, 1)]), VECTORS))


def test_bounds_decide_as_all_distances_do():
    """Many rounds of moving entries: bounds hold, most parts are settled by them, and b shrinks without loss."""
    rng = np.random.default_rng(5)
    x = rng.integers(-2000, 2000, (4000, 1, 8))
    x[:200] = x[0]  # equal parts
    book = x[100:1700:100, 0].copy()
    book[3] = book[5]  # a tie between entries
    state = np.zeros(len(x), codes.bounds_type(1, 4))
    codes.from_scratch(x[:, 0], book, state, np.arange(len(x)), 0)
    settled, b = 0, 4
    for turn in range(8):
        step = rng.integers(-60 // (turn + 1), 60 // (turn + 1) + 1, book.shape)
        step[turn % 16] = 0
        book = book + step
        moved = np.sqrt((step ** 2).sum(axis=1)) * (1 + 1e-9)
        looked = codes.refine(x[:, 0], book, moved, state, 0)
        d = ((x[:, 0, None] - book[None]) ** 2).sum(axis=2)
        assert (state["code"][:, 0] == d.argmin(axis=1)).all()
        assert (state["upper"][:, 0].astype(float) ** 2 >= d.min(axis=1)).all()
        for j in range(b):
            assert (state["low"][:, 0, j].astype(float) <= np.sqrt(d[np.arange(len(x)), state["near"][:, 0, j]])).all()
        settled += int((looked <= 0).sum())
        if turn == 3:
            state, b = codes.shrunk(state, 1, 2), 2
    assert settled > len(x)


def library(path):
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})


TEXTS = [None, "", " ", "   \n\n  x", "one", "it's we'LL I'm 'd", "naïve café — 漢字かな 😀😀", "<|endoftext|> as text", "a\u0085b\u001cc d", "0123456789 " * 5,
         "ab" * 30000, "x" * 100000, " " * 70000, "é" * 40000, "Qzxj" * 20000, "repeated", "repeated"]


def test_byte_bpe_equals_the_library(spark):
    import public_tokenizers

    path = vocabulary("byte_bpe_50k.tiktoken")
    e = library(path)
    rows = [(i, t, "n", "i") for i, t in enumerate(TEXTS)] + [(None, "null id", "n", "i"), (15, "repeated", "n", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids string")

    def expected(t):
        ids = e.encode_ordinary(t or "")
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(e.decode_bytes(ids)).hexdigest()

    got = byte_bpe.round_trip(df, path, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(((i, *expected(t)) for i, t, _, _ in rows), key=str)
    encoded = byte_bpe.encode_documents(df, path, public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded) for r in byte_bpe.decode_documents(encoded, path, public_tokenizers.PATTERN).collect()) == sorted((t or "").encode() for _, t, _, _ in rows)
    assert byte_bpe.round_trip(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_of_random_pieces():
    """Strings of whole vocabulary entries, which longest matches often cut wrongly at first."""
    import public_tokenizers

    path = vocabulary("byte_bpe_50k.tiktoken")
    e, t, rng = library(path), byte_bpe.tokenizer(path, public_tokenizers.PATTERN), random.Random(2)
    tokens = sorted(t.bytes_of.values())
    for _ in range(4000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6)))
        assert t.encode_piece(piece.decode("latin-1")) == e._encode_single_piece(piece)
    for _ in range(2000):
        s = "".join(rng.choice(rng.choice(["ab", "aeiou st\n", "éà漢字 ", "'sLl t"])) for _ in range(rng.randint(0, 60)))
        assert t.encode(s) == e.encode_ordinary(s)


def test_byte_bpe_of_a_small_vocabulary():
    """A vocabulary whose merges overlap in every way, against merging by rank; remembered pairs are few and cleared."""
    ranks = {bytes([b]): b for b in range(256)}
    for token in (b"ab", b"ba", b"aa", b"aab", b"abab", b"bb", b"baa", b"aaaa", b"bab"):
        ranks[token] = len(ranks)
    t, rng = byte_bpe.ByteBpe(ranks, r"[\s\S]+", remember=3), random.Random(4)
    known = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for _ in range(3000):
        piece = "".join(rng.choice("ab") for _ in range(rng.randint(1, 24)))
        assert t.encode(piece) == known.encode_ordinary(piece)
