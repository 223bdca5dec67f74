"""Operators on documents against brute force, and their defined edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm import bayes_join, bpe, cdc, minhash, mixing, ordinal, rans
from spindle.llm.queries import vocabulary
from spindle.llm.shingles import shingle_hashes

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                     # names that the operators use themselves
                     T.StructField("size", T.StringType()), T.StructField("node", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("selected", T.StringType())])


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(n))


BASE = prose(300, 1)
EDGE = [None, "", "   \n ", "one", "two words", BASE, BASE, BASE.replace(" ", "\n", 3), BASE + " tail of some words", prose(40, 2), prose(5000, 3),
        "<|endoftext|> it's  ΑΣ ΑΣΒ İ x²  wide　 é é <|startoftext|>", "日本語 " * 50, "a\t b\r\n\r\nc ", "😀" * 5]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, "x", "y", "z", "w") for i, t in enumerate(EDGE)]
    rows += [(None, "null id", "s1", None, None, None, None), (7, EDGE[7], "s1", None, None, None, None), (7, EDGE[7], "s1", None, None, None, None), (5, "same id, other text", "s2", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def words_of(t):
    return t.encode().split()


def shingles(t):
    w = words_of(t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_bpe_equals_the_library(docs, nothing):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = []
    for i, x in texts(docs):
        ids = t.encode(x, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(docs, path).collect()), key=str) == sorted(want, key=str)
    assert bpe.round_trip(nothing, path).collect() == []


def test_bpe_merges_like_a_plain_loop():
    t = bpe.BpeTokenizer(vocabulary("word_bpe_49k.json"), remember=3)

    def plain(symbols):
        while True:
            ranked = [(r, i) for i, p in enumerate(itertools.pairwise(symbols)) if (r := t.ranks.get(p)) is not None]
            if not ranked:
                return symbols
            _, i = min(ranked)
            symbols = symbols[:i] + [symbols[i] + symbols[i + 1]] + symbols[i + 2:]

    for w in ["aaaaaaaaaaa", "thththethe", "mississippi", "internationalization", "x", "banana" * 30]:
        assert t.merge([*w[:-1], w[-1] + "</w>"]) == plain([*w[:-1], w[-1] + "</w>"])


def test_token_files_equal_the_library(docs, nothing):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = rans.token_files(docs, path, 2).collect()
    want = sorted(((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, x in texts(docs) for ids in [[*t.encode(x, add_special_tokens=False).ids, 2]]), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == [0, *itertools.accumulate(r.n_tokens for r in in_order)][:-1]
    known = [r.doc_id for r in in_order if r.doc_id is not None]
    assert known == sorted(known)
    assert rans.token_files(nothing, path, 2).collect() == []


def test_pre_tokens_are_the_librarys_and_the_frequent_stay():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    rng = random.Random(7)
    chars = [chr(c) for c in range(0x300)] + list(" \u2003\u3000中ПŒ\U0001f600") + [" "] * 99 + ["'s", "'LL", "\n ", "<|endoftext|>"] * 5
    texts = ["", " ", *(f"a{c} {c}{c}'{c}1{c}" for c in chars), *("".join(rng.choices(chars[:128] if i % 2 else chars, k=60)) for i in range(400))]
    want = [np.array(e.ids, "<u2").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    encoder = rans.PieceEncoder(path, remember=8)
    assert [encoder.encode([t])[0] for t in texts] == want
    asked, encoder = [], rans.PieceEncoder(path, remember=8)
    learn, encoder.learn = encoder.learn, lambda new: (asked.extend(new), learn(new))
    encoder.encode(["one two"])
    for i in range(20):  # the pre-tokens met first outlive those that come once
        assert encoder.encode([f"one two {i} " + " ".join(f"w{i}x{k}" for k in range(6))])
    assert asked.count("one") == asked.count(" two") == 1


def test_latin_texts_go_through_arrays_and_many_pre_tokens_through_one_call():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), random.Random(3)
    chars = list("aestmdvrl'''  \n\t\r\v\xa0\x85_1²9é\xad×ɏ!\x00\x00\x1b\x7f") + ["'s", "'ll", "'re", "'Ve", " '", "  ", "<|endoftext|>"]
    texts = ["", "", " ", "\xa0", "'", "'l", "x's's'll'L", *("".join(rng.choices(chars, k=k % 40)) for k in range(2000)),
             *(" " + c * k + " " + c * k for c in ("x", "é", "!", " ", "\xa0", "\x00") for k in (*range(1, 41), 300))]
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    for remember, rows in ((500_000, 64), (8, 1), (300, 50)):
        encoder = rans.PieceEncoder(path, remember)
        for _ in range(2):
            assert [x for i in range(0, len(texts), rows) for x in encoder.encode(texts[i:i + rows])] == want
        assert encoder.table.count <= remember + 20 * rows and (encoder.table.size[:encoder.table.count] <= rans.PieceTable.LONGEST).all()
    encoder, calls = rans.PieceEncoder(path), []
    encoder.split = None  # Latin texts need no matches one by one

    class Counted:
        def encode_batch_fast(self, words, **kwargs):
            calls.append(len(words))
            return bare.encode_batch_fast(words, **kwargs)

    bare, encoder.bare = encoder.bare, Counted()
    words = [f"a{'bcdefghij'[i % 9]}{'klmnopqrst'[i // 9 % 10]}{'uvwxyz'[i // 90 % 6]}é" for i in range(500)]
    encoder.encode([" ".join(words[:250]), " ".join(words[250:])])
    assert calls == [8]  # 501 new ones, 64 a word


def test_rans_blocks_round_trip_and_detect_damage():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 4095, 4097, 50_000):
        tokens = np.minimum(rng.zipf(1.3, n), 999).astype(np.uint32)
        table = rans.SharedTable(np.bincount(tokens, minlength=1000))
        assert table.freq.sum() == 1 << rans.SCALE_BITS
        data = rans.encode_block(tokens, rans.SharedTable.from_bytes(table.to_bytes()))
        assert (rans.decode_block(data, table) == tokens).all()
        with pytest.raises(ValueError):
            rans.decode_block(data[:-1] + bytes([data[-1] ^ 1]), table)


def mixing_targets(sizes, weights, share, most):
    """Water-filling in rounds."""
    target, full = dict.fromkeys(sizes, 0.0), set()
    total = share * sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        if not free:
            break
        target |= {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            break
        full |= over
        target |= {s: most * sizes[s] for s in over}
    return target


def test_mixing(spark, docs, nothing):
    rng = np.random.default_rng(4)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 60))), f"s{int(rng.zipf(1.5)) % 11:02d}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame).collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    want = mixing_targets(sizes, weights, 1.5, 2)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].source_size == sizes[s] and mine[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in mine) - want[s]) <= 1
    assert all(r.taken <= 2 * r.size for r in got)
    assert sorted(got) == sorted(mixing.mix(frame.repartition(7)).collect())
    mixed = mixing.mixture(frame.withColumn("whole", F.lit("clash")))
    assert mixed.columns == ["doc_id", "text", "source", "whole"]
    assert mixed.select(F.sum(mixing.words(F.col("text")))).first()[0] == sum(r.taken for r in got)
    edge = mixing.mix(docs).collect()
    assert len(edge) == docs.count() and all(r.size == len(words_of(t)) for r, t in zip(sorted(edge, key=lambda r: r.size), sorted([t for _, t in texts(docs)], key=lambda t: len(words_of(t))), strict=True))
    assert sum(r.taken for r in edge) == pytest.approx(1.5 * sum(r.size for r in edge), abs=3)
    assert mixing.mixture(docs).columns == docs.columns
    assert mixing.mix(nothing).collect() == [] and mixing.mixture(nothing).collect() == []


def test_fingerprints(docs, nothing):
    got = minhash.fingerprints(docs).collect()
    rows = sorted(texts(docs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    # with one row an id, the order is fixed
    once = docs.filter("doc_id not in (5, 7) and doc_id is not null")
    order = sorted(texts(once), reverse=True)
    found = {r.doc_id: r for r in minhash.fingerprints(once.repartition(5)).collect()}
    for (i, x), (j, y) in zip(order, order[1:] + order[:1], strict=True):
        k = len(x) // 3
        edited = x[:len(x) - k] + y[:k]
        r = found[i]
        assert r.n_chars == len(x) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(x), shingles(edited), shingles(y)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1, abs=0.2)
        assert r.near_next == pytest.approx(len(a & c) / len(a | c) if a | c else 1, abs=0.2)
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None and r.doc_id not in (5,)}
    assert prints[0] == prints[1] == prints[2] and prints[6] == prints[7] != prints[9]
    assert minhash.fingerprints(nothing).collect() == []
    single = minhash.fingerprints(docs.filter("doc_id = 9")).collect()[0]
    assert single.near_next == 1


def classes(rows, threshold=0.8):
    """Brute force over all pairs: class and number of links of each row."""
    sets = [shingles(t) for _, t in rows]
    near = [[i != j and (len(a & b) >= threshold * len(a | b) if a | b else True) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *(root[j] for j in range(len(rows)) if near[i][j])]) for i in range(len(rows))]
    ids = [min((r for k, (r, _) in enumerate(rows) if root[k] == root[i] and r is not None), default=None) for i in range(len(rows))]
    return [(r[0], c, sum(n)) for r, c, n in zip(rows, ids, near, strict=True)]


def near_rows():
    rng = np.random.default_rng(9)
    rows = []
    for g in range(6):
        base = prose(120, 100 + g).split()
        for _ in range(8):
            w = list(base)
            for _ in range(int(rng.integers(0, 7))):
                w[int(rng.integers(0, len(w)))] = "changed"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_similarity_join_is_exact(spark, docs, nothing):
    rows = near_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r)[:1] + (r.class_id, r.n_links) for r in bayes_join.similarity_join(frame).collect()) == sorted(classes(rows))
    got = bayes_join.similarity_join(docs).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=str) == sorted(classes(texts(docs)), key=str)
    kept = bayes_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == bayes_join.similarity_join(docs).filter("first").select("doc_id", "text_key").distinct().count()
    assert bayes_join.similarity_join(nothing).collect() == [] and bayes_join.one_of_each(nothing).collect() == []


def test_similarity_join_in_blocks(spark, monkeypatch):
    """Groups dealt into many pairs of blocks give the same links."""
    rows = near_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = bayes_join.in_blocks
    monkeypatch.setattr(bayes_join, "in_blocks", lambda r, key, size, node, block: whole(r, key, size, node, 3 if size == "members" else 300))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in bayes_join.similarity_join(frame).collect()) == sorted(classes(rows))


def test_bounds_of_the_posterior():
    for n, m in bayes_join.least_matches(0.8, 1e-5, 128, 16):
        x = np.linspace(0, 1, 200_001)
        for matches in {m, max(m - 1, 0)}:
            with np.errstate(divide="ignore"):
                density = np.exp(matches * np.log(np.maximum(x, 1e-300)) + (n - matches) * np.log(np.maximum(1 - x, 1e-300)) - (matches * np.log(max(matches / n, 1e-300)) + (n - matches) * np.log(max(1 - matches / n, 1e-300))))
            chance = density[x >= 0.8].sum() / density.sum()
            assert (chance >= 1e-5 * 0.99) == (matches >= m) or matches == m


def test_near_copies(spark):
    rows = near_rows()
    got = {r.doc_id: r.class_id for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: c for i, c, _ in classes(rows)}
    assert all(want[i] == want[c] for i, c in got.items())  # no wrong link
    assert sum(got[i] == c for i, c in want.items()) >= 0.9 * len(rows)


def test_near_copies_of_a_template_equal_brute_force(spark, monkeypatch):
    """Sub-groups of near copies in a family whose other pairs share bands, but are not near; in one block and in many."""
    rng, family, rows = np.random.default_rng(21), prose(400, 500).split(), []
    for _ in range(60):
        w = list(family)
        for changes in (6, 5):
            w = list(w)
            for at in rng.choice(400, changes, replace=False):
                w[at] = prose(1, int(rng.integers(1 << 30)))
            rows.append((len(rows), " ".join(w)))
    want = sorted((i, c) for i, c, _ in classes(rows))
    assert len({c for _, c in want}) > 30
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_copies(frame).collect())) == want
    whole = bayes_join.in_blocks
    monkeypatch.setattr(minhash, "in_blocks", lambda r, key, size, node, block: whole(r, key, size, node, 2000), raising=False)
    assert sorted(map(tuple, minhash.near_copies(frame).collect())) == want


def test_near_copies_of_edge_cases_equal_brute_force(docs, nothing):
    assert sorted(map(tuple, minhash.near_copies(docs).collect()), key=str) == sorted([(i, c) for i, c, _ in classes(texts(docs))], key=str)
    assert minhash.near_copies(nothing).collect() == []


def test_chunks_resist_insertions_and_cover_texts():
    rng = np.random.default_rng(3)
    for t in [*(x.encode() for x in EDGE if x), b"x" * 10_000, ("é" * 5000).encode(), rng.integers(32, 127, 5000, np.uint8).tobytes()]:
        p = cdc.boundaries([t])[0]
        assert p[0] == 0 and p[-1] == len(t) and (np.diff(p) > 0).all() and np.diff(p).max() <= cdc.MAX_CHUNK + 70
        for a, b in itertools.pairwise(p.tolist()):
            t[a:b].decode()
    a, b = BASE.encode(), b"some words put before " + BASE.encode()
    cut = lambda t: {t[x:y] for x, y in itertools.pairwise(cdc.boundaries([t])[0].tolist())}
    assert len(cut(a) & cut(b)) >= 0.9 * len(cut(a))
    # the doubling steps equal the rolling sum
    data = np.frombuffer(a, np.uint8)
    h = 0
    for i, c in enumerate(data[:300]):
        h = ((h << 1) + int(cdc.GEAR[c])) & 0xFFFF
        assert h == cdc.gear_hashes(data)[i]


def test_remove_repeats(spark, docs, nothing):
    passage = prose(80, 50)
    rows = [(i, f"{prose(60, 60 + i)} {passage} {prose(60, 80 + i)}") for i in range(5)] + [(9, prose(90, 99)), (10, None), (11, "")]
    got = {r.doc_id: r for r in cdc.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].removed_bytes == got[9].removed_bytes == 0 and got[9].kept_text == rows[5][1] and got[10].kept_text == got[11].kept_text == ""
    for i in range(1, 5):
        assert got[i].removed_bytes >= 0.6 * len(passage) and passage not in got[i].kept_text and {s.kept_in for s in got[i].spans} == {0}
        assert got[i].kept_text.startswith(prose(60, 60 + i)[:300]) and got[i].kept_text.endswith(prose(60, 80 + i)[-300:])
    for r in cdc.remove_repeats(docs).collect():
        data = (r.text or "").encode()
        for s in reversed(r.spans or []):
            data = data[:s.start] + data[s.stop:]
        assert data.decode() == r.kept_text
    by_id = {r.doc_id: r for r in cdc.remove_repeats(docs).collect()}
    assert by_id[5].removed_bytes == 0 or by_id[5].text != BASE
    assert by_id[6].kept_text == ""
    assert cdc.remove_repeats(nothing).collect() == []


def test_chunks_equal_by_chance_are_not_cut(spark):
    """With digests of one byte nearly every chunk has one of an earlier other one; only true repeats go."""
    rows = [(i, prose(120, 100 + i)) for i in range(40)] + [(50, prose(30, 900) + " " + prose(60, 101)), (51, prose(120, 103))]
    got = {r.doc_id: r for r in cdc.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), digest_bytes=1).collect()}
    source = dict(rows)
    assert all(got[i].removed_bytes == 0 for i in range(40))
    for i in (50, 51):
        for s in got[i].spans or []:
            assert source[i].encode()[s.start:s.stop] in source[s.kept_in].encode()


def test_a_very_common_chunk_takes_the_combined_way(spark):
    """A line that 3,000 documents share is common; the first keeps it, and each its own words (but for a few equal characters beside the line)."""
    line = prose(60, 77)
    docs = spark.range(3000, numPartitions=7).select("id", F.concat(F.md5(F.col("id").cast("string")), F.lit(" "), F.lit(line), F.lit(" "), F.md5((-F.col("id") - 1).cast("string"))).alias("text")).withColumnRenamed("id", "doc_id")
    found = cdc.chunks(cdc.keyed(docs).select("doc_id", "text_key", "text"))
    assert len(cdc.common_digests(found))
    place = {(r.doc_id, r.place): r.digest for r in found.collect()}
    firsts = {}
    for (i, p), d in sorted(place.items()):
        firsts.setdefault(d, (i, p))
    later = {(r.doc_id, r.place): (r.first_id, r.first_place) for r in cdc.later_places(found).collect()}
    assert later == {k: firsts[d] for k, d in place.items() if firsts[d] != k}
    got = {r.doc_id: r.kept_text for r in cdc.remove_repeats(docs).collect()}
    assert line in got[0] and not any(line in t for i, t in got.items() if i)
    assert all(t.startswith(hashlib.md5(str(i).encode()).hexdigest()) and t.endswith(hashlib.md5(str(-i - 1).encode()).hexdigest()[6:]) for i, t in got.items())


def test_every_passage_over_50_words_is_found(spark):
    """Passages of 51 to 100 words, repeated across otherwise different texts, are cut whole and nothing else is."""
    rows, want = [], {}
    for n in range(51, 101):
        passage = prose(n, 10_000 + n)
        for copy in range(2):
            before, after = prose(40, 20_000 + 2 * n + copy), prose(40, 30_000 + 2 * n + copy)
            rows.append((2 * n + copy, f"{before} {passage} {after}"))
            want[2 * n + copy] = f"{before} {after}" if copy else rows[-1][1]
    got = {r.doc_id: r.kept_text for r in cdc.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in want if got[i] != want[i]] == []


def test_ordinal_regression_holds_out(spark, docs, nothing):
    rng = np.random.default_rng(8)
    rows, grades = [], []
    for i in range(900):
        g = int(rng.integers(0, 3))
        w = prose(60, 1000 + i).split()
        if g == 1:
            w[int(rng.integers(0, 60))] = "vile,"
        if g == 0:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        grades.append((i, g))
    frame, rated = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*grades, (None, 1), (3, None)], "doc_id long, grade int")
    model = ordinal.train(frame, rated.filter("doc_id is null or doc_id % 3 > 0 or grade is null"))
    assert model[2] == sorted(model[2]) and max(model[1]) <= 0
    assert model == ordinal.train(frame.repartition(9), rated.filter("doc_id is null or doc_id % 3 > 0 or grade is null"))
    got = {r.doc_id: r for r in ordinal.score_documents(frame, model).collect()}
    held = [(i, g) for i, g in grades if i % 3 == 0]
    assert np.mean([got[i].selected == (g == 2) for i, g in held]) >= 0.97
    means = [np.mean([got[i].expected_grade for i, g in held if g == k]) for k in range(3)]
    assert means == sorted(means)
    edge = ordinal.score_documents(docs, model)
    assert edge.columns == ["doc_id", "text", "source", "size", "node", "ids", "expected_grade", "tail_probability", "selected"] and edge.count() == docs.count()
    scores = {r.text: r.tail_probability for r in edge.collect()}
    assert scores[None] == scores[""]
    assert ordinal.score_documents(nothing, model).collect() == []
    empty = ordinal.train(nothing, rated.limit(0))
    assert ordinal.score_documents(docs, empty).count() == docs.count()


def test_word_beginnings_equal_plain_slices():
    texts = [t.encode() for t in EDGE if t is not None] + [b"", b"Vilest, vile-ness  x1vileness", "größenwahn Größe".encode()]
    hashed, owners = ordinal.beginnings(texts)
    got = [sorted(hashed[owners == i].tolist()) for i in range(len(texts))]
    hash_of = {}
    for t, g in zip(texts, got, strict=True):
        words = re.findall(rb"[a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), t))
        plain = [w[:k] for w in words for k in ordinal.BEGINNINGS if len(w) > k]
        assert len(plain) == len(g)
        for w in set(plain):
            one, _ = ordinal.beginnings([w + b"z"])
            hash_of[w] = int(one[list(ordinal.BEGINNINGS).index(len(w))])
        assert sorted(hash_of[w] for w in plain) == g
    assert len(set(hash_of.values())) == len(hash_of)


def test_likelihood_slopes_equal_differences():
    """One pass of one batch moves weights and thresholds against the numerical gradient of the likelihood."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 12, 5)) for _ in range(60)]
    ids, counts, grades = np.concatenate(sets), np.array([len(x) for x in sets]), rng.integers(0, 3, 60)
    balance = (60 / np.bincount(grades, minlength=3) / 3)[grades]

    def loss(w, cut):
        thresholds = np.cumsum([cut[0], np.exp(cut[1])])
        total = 0.0
        for x, y, b in zip(sets, grades, balance, strict=True):
            least = [1.0, *(1 / (1 + np.exp(t - w[x].sum())) for t in thresholds), 0.0]
            total -= b * np.log(least[y] - least[y + 1]) / 60
        return total

    w, th = ordinal.fit(ids, counts, grades, 3, passes=6000, rate=0.05, sparse=0.0, decay=0.0, batch=60)
    w, cut = w[:12], np.array([th[0], np.log(th[1] - th[0])])
    step = 1e-5
    for k in range(12):  # at the optimum a weight has no slope, or it is held at 0 against one that would raise it
        d = np.eye(12)[k] * step
        slope = (loss(w + d, cut) - loss(w - d, cut)) / (2 * step)
        assert abs(slope) < 2e-3 if w[k] < -1e-3 else slope < 2e-3
    for k in range(2):
        d = np.eye(2)[k] * step
        assert abs(loss(w, cut + d) - loss(w, cut - d)) / (2 * step) < 2e-3


def test_forms_unseen_in_the_sample_are_found_by_their_stem(spark):
    """Grade 1 has a word of one stem, in a form of its own each; repeated rows and ids count once."""
    rows = [(i, prose(60, 7000 + i) + (f" grumbel{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}" if i % 4 == 0 else "")) for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rated = frame.selectExpr("doc_id", "IF(doc_id % 4 = 0, 1, 2) AS grade").filter("doc_id % 3 > 0")
    model = ordinal.train(frame, rated)
    assert model == ordinal.train(frame.unionByName(frame.filter("doc_id < 50")), rated.unionByName(rated)) == ordinal.train(frame, rated, max_rows=ordinal.MAX_SENT + 1)
    got = {r.doc_id: r.selected for r in ordinal.score_documents(frame, model).filter("doc_id % 3 = 0").collect()}
    assert not any(s for i, s in got.items() if i % 4 == 0) and np.mean([s for i, s in got.items() if i % 4]) >= 0.98


def test_selection_is_as_strict_as_the_best_grade_allows(spark):
    """The least probability is the best documents' own quantile, also above 0.5; alike documents are kept alike."""
    rows = [(i, prose(60, 5000 + i) + (" vile" if i % 4 == 0 else "")) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = ordinal.train(frame, frame.selectExpr("doc_id", "IF(doc_id % 4 = 0, 1, IF(doc_id % 4 = 1, 0, 2)) AS grade").filter("doc_id % 4 <> 1"))
    got = {r.doc_id: r for r in ordinal.score_documents(frame, model).collect()}
    best = [got[i].tail_probability for i in got if i % 4 > 1]
    assert model[3] == pytest.approx(np.quantile(best, 1 - ordinal.KEEP_BEST, method="lower"), abs=1e-6) and model[3] > 0.5
    assert np.mean([got[i].selected for i in got if i % 4 > 1]) >= ordinal.KEEP_BEST and not any(got[i].selected for i in got if i % 4 == 0)


def test_shingles_equal_plain_sets():
    held = [t.encode() for t in EDGE if t is not None]
    hashes, counts = shingle_hashes(held, 5)
    parts = np.split(hashes, np.cumsum(counts)[:-1])
    for t, p in zip(held, parts, strict=True):
        assert len(set(p.tolist())) == len(shingles(t.decode()))
