"""Objects that arrive, files of one row each, and dedup whose state ends."""

import os

import pytest
from pyspark.sql import functions as F

from spindle.sources import objects
from spindle.sources.objects import ObjectStream, object_arrivals, visible_objects, write_objects, file_system
from spindle.sources.readers import read_binary_files
from spindle.streaming.jobs import run_available_now
from spindle.streaming.stateful import dedup_with_late_rows, state_rows


def _files(folder):
    """Files that a reader lists, and the mark of success."""
    below = (os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs)
    return sorted(p for p in below if p == "_SUCCESS" or not any(part[0] in "_." for part in p.split("/")))


def test_one_file_a_row(spark, tmp_dir):
    rows = [(1, "a/b", b"one"), (2, "a/b", b""), (3, None, None), (4, "é ü", bytes(range(256))), (5, "", b"x")]
    df = spark.createDataFrame(rows, "id long, label string, content binary").repartition(3)
    write_objects(df, tmp_dir, "label", F.concat(F.col("id").cast("string"), F.lit(".bin")), F.col("content"))
    assert _files(tmp_dir) == sorted(["_SUCCESS", "a%2Fb/1.bin", "a%2Fb/2.bin", "none__/3.bin", "%C3%A9 %C3%BC/4.bin", "none__/5.bin"])
    got = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tmp_dir).collect()}
    assert got["1.bin"] == b"one" and got["4.bin"] == bytes(range(256))
    # more rows beside the old ones
    write_objects(df.where("id = 1").withColumn("id", F.lit(9)), tmp_dir, "label", F.concat(F.col("id").cast("string"), F.lit(".bin")), F.col("content"))
    assert "a%2Fb/9.bin" in _files(tmp_dir) and "a%2Fb/1.bin" in _files(tmp_dir)


def test_many_files_are_moved_and_read_by_few_large_tasks_on_all_cores(spark, tmp_dir, monkeypatch):
    cores, marks, moved = spark.sparkContext.defaultParallelism, f"{tmp_dir}/marks", objects.put_in_place
    os.makedirs(marks)

    def marked(root):
        def run(batches):
            from pyspark import TaskContext
            for batch in moved(root)(batches):
                open(f"{marks}/{TaskContext.get().partitionId()}", "w").close()
                yield batch
        return run

    monkeypatch.setattr(objects, "put_in_place", marked)
    n = 32 * 5 * cores
    df = spark.range(0, n, 1, 4).select("id", F.lit("l").alias("label"))
    write_objects(df, f"{tmp_dir}/all", "label", F.col("id").cast("string"), F.col("id").cast("string").cast("binary"))
    assert len(os.listdir(marks)) == 4  # a task for each that has written, not one for all
    files = read_binary_files(spark, f"{tmp_dir}/all")
    assert files.rdd.getNumPartitions() == 4 * cores  # before: 32 files a task
    assert sorted(int(r.content) for r in files.select("content").collect()) == [*range(n)]
    scan = read_binary_files(spark, f"{tmp_dir}/all", with_content=False).select("path")
    assert "content:binary" not in scan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bad", ["twice", "nameless", "late failure"])
def test_a_failed_write_leaves_no_files(spark, tmp_dir, bad):
    df = spark.range(40, numPartitions=2).select(F.col("id"), F.lit("l").alias("label"))
    name = F.col("id").cast("string")
    content = F.lit("x").cast("binary")
    if bad == "twice":
        name = F.when(F.col("id") == 39, "38").otherwise(name)
    elif bad == "nameless":
        name = F.when(F.col("id") != 39, name)
    else:
        content = F.when(F.col("id") == 39, F.raise_error(F.lit("broken"))).otherwise("x").cast("binary")
    with pytest.raises(Exception):
        write_objects(df, tmp_dir, "label", name, content)
    assert _files(tmp_dir) == []


def test_objects_arrive_once(spark, tmp_dir):
    landing, log = f"{tmp_dir}/landing", f"{tmp_dir}/log"

    def put(name, data):
        os.makedirs(os.path.dirname(f"{landing}/{name}"), exist_ok=True)
        with open(f"{landing}/{name}", "wb") as f:
            f.write(data)

    def run():
        text = F.col("content").cast("string")
        df = object_arrivals(spark, landing, log, objects_per_task=2).select("path", "name", "size", F.size(F.split(text, "\n", -1)).alias("n"))
        run_available_now(df, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
        rows = spark.read.parquet(f"{tmp_dir}/out").collect()
        assert len({r.path for r in rows}) == len(rows)
        return {r.path: (r.name, r.size, r.n) for r in rows}

    put("a/1.txt", b"one\ntwo\n"), put("a/empty", b""), put("2.txt", b"x"), put("_hidden/3.txt", b"y"), put("a/.part", b"z")
    first = {"a/1.txt": ("1.txt", 8, 3), "a/empty": ("empty", 0, 1), "2.txt": ("2.txt", 1, 1)}
    assert run() == first
    assert run() == first  # started again with nothing new
    put("b/4.txt", b"\n\n"), put("2.txt", b"changed")
    assert run() == first | {"b/4.txt": ("4.txt", 2, 3)}
    # another checkpoint over the same log sees everything again
    stream = ObjectStream({"path": landing, "log": log, "objects_per_task": "2"})
    parts = stream.partitions(stream.initialOffset(), stream.latestOffset())
    assert sorted(p for part in parts for p, _ in part.paths) == sorted([*first, "b/4.txt"]) and max(len(p.paths) for p in parts) == 2
    assert visible_objects(*file_system(f"{tmp_dir}/nowhere")) == []


def test_state_of_the_dedup_ends(spark, tmp_dir):
    """Twelve batches of ten minutes: copies one batch later are duplicates, three batches later late; state keeps some batches' slots alone."""
    minute = 60
    schema = "id long, ts timestamp, outcome string"
    sent = []
    for b in range(12):
        batch = [(100 * b + i, b * 10 * minute + i * 12) for i in range(50)]
        batch += [(100 * (b - 1) + i, (b - 1) * 10 * minute + i * 12) for i in range(0, 50, 5) if b]
        batch += [(100 * (b - 3) + i, (b - 3) * 10 * minute + i * 12) for i in range(1, 50, 10) if b >= 3]
        batch += [batch[0], (-1 - b, None)]
        sent.append(batch)
        df = spark.createDataFrame(batch, "id long, s long").select("id", F.timestamp_seconds("s").alias("ts"), F.lit("clash").alias("outcome"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    job = lambda: run_available_now(dedup_with_late_rows(stream(), ["id"], "ts", "15 minutes", slot_ms=5 * minute * 1000, buckets=2), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", state_partitions=2)
    progress = job()
    want, seen, top = [], set(), 0
    for batch in sent:
        mark = max(0, top - 15 * minute)
        for i, s in batch:
            late = s is None or s < mark
            want.append((i, "late" if late else "duplicate" if i in seen else "kept", mark * 1000))
            if not late:
                seen.add(i)
        top = max([top, *(s for _, s in batch if s is not None)])
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.columns == ["id", "ts", "event_ms", "outcome", "watermark_ms"]
    assert sorted((r.id, r.outcome, r.watermark_ms) for r in got.collect()) == sorted(want)
    assert {o for _, o, _ in want} == {"kept", "duplicate", "late"}
    rows = [n for _, n in state_rows(progress)]
    # keys, timers and their index of at most 25 minutes in slots of five, two buckets each; half of it goes when the stream ends
    assert max(rows) < 3 * max(rows[:4]) and rows[-1] < max(rows)
    assert job() == [] or spark.read.parquet(f"{tmp_dir}/out").count() == len(want)
