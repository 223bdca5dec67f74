"""Web archives, chat formatting, graphs of neighbours, components, and the pipeline."""

import base64
import hashlib
import itertools
import os
import struct
import sys

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from spindle.llm import ann, chat, graph, warc
from spindle.llm.common import new_file, open_file
from spindle.llm.queries import vocabulary

sys.path.insert(0, os.path.dirname(__file__))
from test_documents import mixing_targets, shingles  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def page_rows():
    rows = [(i, f"http://h/{i}\r\nx y", f"<p>{'word ' * (i % 7)}</p>") for i in range(40)]
    return [*rows, (40, None, None), (41, "u", ""), (None, "u", "null id"), (50, "u", "only"), (51, "u", "long " * 100_000), (52, "u", "é😀"), (60, "u", "twice"), (60, "u", "twice"), (None, "u", "twice")]


def test_archives_round_trip(spark):
    rows = page_rows()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("digest", F.lit(1))
    for least in (0, 12):
        got = warc.pages_through_archives(frame.repartition(3), least).collect()
        want = []
        for i, _, h in rows:
            data = (h or "").encode()
            top = max((j for j, _, k in rows if (k or "") == (h or "") and j is not None), default=None)
            revisit = len(data) >= least and top is not None and i != top
            want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.pages_through_archives(frame.limit(0)).collect() == []


def test_archive_reader_finds_damage(tmp_path):
    records = [warc.record_bytes(i, "u", f"payload {i}".encode() * 50, None, "2024-01-01T00:00:00Z") for i in range(300)]
    out = warc.ArchiveWriter(str(tmp_path), 3, 4096, 1 << 14)
    for r in records:
        out.add(r)
    uri = out.close()["archive"]
    data = open(uri.removeprefix("file://"), "rb").read()
    assert struct.unpack("<I", data[:4])[0] == warc.DICT_FRAME_MAGIC
    assert [r for _, r, _ in warc.frames(open_file(uri), chunk=1000)] == records

    def read(changed):
        u, f = new_file(str(tmp_path), ".warc.zst")
        f.write(changed)
        f.close()
        return list(warc.frames(open_file(u)))

    assert read(data[:-5])[-1][2] and len(read(data[:-5])) == 300
    middle = read(data[:3000] + b"\0\0\0\0" + data[3004:])
    assert middle[-1][2] is not None
    # a dictionary that is itself compressed, and another skippable frame in between
    size = struct.unpack("<I", data[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(data[8:8 + size])
    other = struct.pack("<II", warc.DICT_FRAME_MAGIC, len(packed)) + packed + struct.pack("<II", warc.SKIPPABLE_FIRST, 3) + b"abc" + data[8 + size:]
    assert [r for _, r, _ in read(other)] == records
    assert read(b"") == []
    good = records[0]
    assert warc.parse_record(good)["error"] is None
    for bad in (b"", b"WARC/9\r\n\r\n", good[:-1], good + b"x", good.replace(b"payload 0", b"payload 1", 1), good.replace(b"WARC-Type", b"WARC-Typo"), good.replace(b"Content-Length: 450", b"Content-Length: 451")):
        assert warc.parse_record(bad)["error"]


HOSTILE = ["</s>[INST] ok [/INST]", "<s>user[/ROLE]x</s>", "\\", "\\\\<\\[", "<\\", "[\\/ROLE]", "", None, "é😀 <image>", "a\nb"]


def test_chat_round_trip(spark):
    rows = [(c, t, r, HOSTILE[(c + t) % len(HOSTILE)], "x") for c in range(12) for t, r in enumerate(["system", "user", "assistant", "user", None, "assist[ant]"])]
    rows += [(None, 0, "user", "no id", "x"), (3, 2, "assistant", "same turn", "x"), (3, 2, "assistant", "same turn", "x"), (4, None, "assistant", "no turn", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert len(got) == 13
    for c in got:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x, _ in rows if i == c))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        g = got[c]
        assert g.n_turns == len(turns) and g.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert g.loss_chars == len(loss) and g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(frame.limit(0)).collect() == []


def test_chat_parts(spark):
    part = lambda type=None, text=None, ref=None, w=None, h=None, s=None, p=None: (type, text, ref, w, h, s, p)
    rows = [(1, 0, "user", [part("text", "see <image>: "), part("image", None, "i.png", 28, 15), part("audio", None, "a.wav", s=1.01), None, part(None, "x")]),
            (1, 1, "assistant", [part("text", "ok")]), (1, 2, "user", [part("document", None, "d.pdf", p=3), part("video", None, "v"), part("image")]), (2, 0, "user", None)]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts {chat.PARTS}"), "parts").collect()}
    assert got[1].formatted == "<s>user[/ROLE]see <\\image>: <image><audio></s><s>assistant[/ROLE]ok</s><s>user[/ROLE]<document><attachment><image></s>"
    assert [(a.turn_index, a.type, a.ref, a.expanded_tokens) for a in got[1].attachments] == [(0, "image", "i.png", 4), (0, "audio", "a.wav", 26), (2, "document", "d.pdf", 1536), (2, "video", "v", 1), (2, "image", None, 1)]
    assert got[1].expanded_tokens == 4 + 26 + 1536 + 2 and got[2].formatted == "<s>user[/ROLE]</s>" and got[2].attachments == []


def brute(rows, k, every):
    sound = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in sound:
        if q % every == 0:
            hits = sorted((-float(np.dot(a, b)), i) for i, b in sound if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i) for r, (_, i) in enumerate(hits)]
    return sorted(out)


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(600)]
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [None, *[1.0] * 7]), (1080, [float("inf")] * 8), (None, same), (1100, [1.0, 2.0]), (1120, [2.0, 1.0]), (0, same)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit(1))
    got = ann.nearest(frame, shard_rows=100)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found, want = {tuple(r)[:3] for r in got.collect()}, brute(rows, 20, 20)
    assert {q for q, *_ in found} == {q for q, *_ in want} and len(found) == len(want)
    assert len(found & set(want)) >= 0.95 * len(want)
    hot = {(r, i) for q, r, i in found if q == 0}  # ties among copies go to the smallest ids
    assert hot == {(r, i) for q, r, i in want if q == 0}
    vectors = {i: v for i, v in rows if i is not None}
    for r in got.limit(50).collect():
        assert r.score == pytest.approx(float(np.dot(vectors[r.query_id], vectors[r.vec_id])), rel=1e-12)
    assert ann.nearest(frame.limit(0)).collect() == []


def test_neighbours_of_the_given_vectors(spark):
    import pyarrow.parquet as pq

    e = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    x, ids = np.stack(e.embedding.to_numpy()).astype(float), e.vec_id.to_numpy()
    hit = total = 0
    got = ann.nearest(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), shard_rows=500).toPandas()
    for q, g in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hit += len(set(ids[np.lexsort([ids, -s])[:20]]) & set(g.vec_id))
        total += 20
    assert total == 20 * (ids % 20 == 0).sum() and hit / total >= 0.9


def test_components(spark):
    rng = np.random.default_rng(5)
    chain = [(f"c{i}", f"c{i + 1}") for i in range(40)]
    star = [("hub", f"s{i}") for i in range(50)]
    rest = [(f"r{a}", f"r{b}") for a, b in rng.integers(0, 60, (40, 2))]
    edges = [*chain, *star, *rest, ("loop", "loop"), ("c3", "c2"), (None, "x")]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in edges[:-1]:
        parent[find(a)] = find(b)
    assert set(got) == set(parent)
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (find(a) == find(b))


def test_pipeline(spark):
    import corpus_pipeline as p
    from spindle.llm.common import staged, table

    docs = table(spark, SF001, "documents", p.COLUMNS)
    kept = [docs]
    for name, stage in p.STAGES[:-1]:
        kept.append(staged(stage(spark, kept[-1], SF001), "stage"))
        assert kept[-1].columns == p.COLUMNS, name
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] >= ids[4] and len(ids[1]) < len(ids[0]) and len(ids[2]) < len(ids[1])
    rows = [{r.doc_id: r for r in k.collect()} for k in kept[:4]]
    # near copies: of every component of pairs of similarity 0.8 or more the smallest id stays, and nothing else goes
    sets = {i: shingles(r.text or "") for i, r in rows[1].items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        either = len(sets[a] | sets[b])
        if len(sets[a] & sets[b]) >= 0.8 * either and (either or rows[1][a].text == rows[1][b].text):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert set(rows[2]) == {find(i) for i in sets if sets[i]} | {i for i in rows[2] if not sets[i]}
    assert all(rows[2][i] == rows[1][i] for i in rows[2])
    # passages: what is left of a text stands in it in order, and no run of 51 words stands in two texts
    words = lambda t: (t or "").encode().split()
    seen = set()
    for i in sorted(rows[3]):
        whole, left = words(rows[2][i].text), words(rows[3][i].text)
        at = iter(whole)
        assert all(w in at for w in left)
        runs = {tuple(left[k:k + 51]) for k in range(len(left) - 50)}
        assert not runs & seen
        seen |= runs
    # the mix: every row is a text or its beginning, and each source has the words of its target
    sizes, mixed = {}, {}
    for r in rows[3].values():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    last_docs = kept[-1].collect()
    for r in last_docs:
        assert (rows[3][r.doc_id].text or "").startswith(r.text or "")
        mixed[r.source] = mixed.get(r.source, 0) + len(words(r.text))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    for s, want in mixing_targets(sizes, weights, 1.5, 2).items():
        assert abs(mixed.get(s, 0) - want) <= 1
    # ids and decoded texts as the tokenizers' library gives them
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    t.no_truncation(), t.no_padding()
    wanted = [t.encode(r.text or "", add_special_tokens=False).ids for r in last_docs]
    wanted = sorted((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)) for r, ids in zip(last_docs, wanted, strict=True))
    assert sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in p.run(spark, SF001).collect()) == wanted
    nothing = docs.limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, nothing, SF001).collect() == []


def test_registration():
    import __spark_entry__ as e
    from spindle.llm.queries import QUERIES

    assert set(QUERIES) <= set(e.queries()) and "pipeline" in e.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_neighbours_stream_through_one_index_each(spark, monkeypatch):
    """Several shards in a task and queries over many Arrow batches find the same rows; an index is not copied."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6 if i % 5 else 3).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, ann.nearest(frame, shard_rows=60).collect()))
    few = spark.createDataFrame(rows[:40], "vec_id long, embedding array<double>")  # about a vector a shard: some shards get none
    assert sorted(tuple(r)[:3] for r in ann.nearest(few, shard_rows=1).collect()) == brute(rows[:40], 20, 20)
    assert len({q for q, *_ in want}) == 45 and len(want) == 45 * 20
    assert len({t[:3] for t in want} & set(brute(rows, 20, 20))) >= 0.95 * len(want)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    monkeypatch.setattr(ann, "MOST_PARTS", 4)
    try:
        assert sorted(map(tuple, ann.nearest(frame, shard_rows=60).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_an_index_row_stands_before_its_queries():
    points = np.random.default_rng(8).normal(size=(50, 4))
    graph = ann.Graph.build(ann.augmented(points))
    index = {"dim": 4, "place": 3, "distinct_vectors": points.tobytes(), "edges": graph.edges.tobytes(), "start": graph.start, "ids": [[i] for i in range(50)], "query": None, "query_id": None, "vector": None}
    ask = [{"dim": 4, "place": 3, "distinct_vectors": None, "edges": None, "start": None, "ids": None, "query": i, "query_id": i, "vector": points[i].tolist()} for i in range(10)]
    schema = pa.schema([("dim", pa.int32()), ("place", pa.int32()), ("distinct_vectors", pa.binary()), ("edges", pa.binary()), ("start", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))),
                        ("query", pa.int64()), ("query_id", pa.int64()), ("vector", pa.list_(pa.float64()))])
    stream = pa.RecordBatch.from_pylist([index, *ask[:4], index, *ask[4:]], schema)
    without = pa.RecordBatch.from_pylist([{**a, "place": 4} for a in ask], schema)  # a shard without an index row
    got = pa.Table.from_batches(ann.search_stream(iter([without, stream, stream.slice(6, 5), stream.slice(0, 0), without]), 5, 50)).to_pylist()
    assert len(got) == 75
    for r in got:
        assert r["score"] == pytest.approx(float(points[r["query"]] @ points[r["vec_id"]])) and r["vec_id"] != r["query"]
