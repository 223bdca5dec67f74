"""Metrics observed while batches are written, and catalog tables bucketed by key."""

import os
import random
import uuid

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from spindle.operators.clean import dedup, first_line
from spindle.operators.metrics import accuracy_f1
from spindle.operators.profile import duplicate_keys
from spindle.sources.bucketed import bucket_skew, write_bucketed
from spindle.sources.readers import load_table, read_lines, read_table
from spindle.streaming.jobs import run_foreach_batch
from spindle.streaming.observed import MAX_CLASSES, class_counts, observed_batch_writer


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [1, 2])
def test_observed_scores_equal_the_aggregate(spark, tmp_dir, seed):
    rng = random.Random(seed)
    rows = [(float(rng.randrange(4)), float(rng.randrange(5))) for _ in range(500)]
    batch = spark.createDataFrame(rows, "label double, prediction double")
    observed_batch_writer(tmp_dir, [0.0, 1.0, 2.0, 3.0, 4.0], also=[F.max("label").alias("top")])(batch, 7)
    got, want = spark.read.parquet(f"{tmp_dir}/metrics").first(), accuracy_f1(batch).first()
    assert (got.batch_id, got.n, got.top) == (7, 500, max(r[0] for r in rows)) and got.write_ms > 0
    assert got.n_right == sum(a == b for a, b in rows)
    assert got.accuracy == pytest.approx(want.accuracy, abs=1e-12) and got.f1 == pytest.approx(want.f1, abs=1e-12)
    assert spark.read.parquet(f"{tmp_dir}/predictions").count() == 500


def test_null_unknown_and_no_rows(spark, tmp_dir):
    write = observed_batch_writer(tmp_dir, ["a", "b"])
    rows = [("a", "a"), ("b", None), (None, "b"), ("new", "new")]
    write(spark.createDataFrame(rows, "label string, prediction string"), 0)
    write(spark.createDataFrame([], "label string, prediction string"), 1)
    write(spark.createDataFrame(rows[:1], "label string, prediction string"), 0)  # a replay replaces
    got = {r.batch_id: (r.n, r.n_right, r.accuracy, r.f1) for r in spark.read.parquet(f"{tmp_dir}/metrics").collect()}
    assert got == {0: (1, 1, 1.0, 1.0), 1: (0, 0, None, None)}
    write(spark.createDataFrame(rows, "label string, prediction string"), 2)
    assert spark.read.parquet(f"{tmp_dir}/metrics").where("batch_id = 2").select("n", "n_right", "accuracy", "f1").first() == (4, 1, 0.25, 0.25)
    with pytest.raises(ValueError, match="classes"):
        class_counts("label", "prediction", range(MAX_CLASSES + 1))


def test_every_batch_of_a_stream_has_its_row(spark, tmp_dir):
    for part in range(5):
        spark.range(part * 10, part * 10 + 3 + part, numPartitions=1).select((F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("prediction")) \
            .write.mode("append").parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema("label double, prediction double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    for _ in range(2):  # the second run finds nothing new
        run_foreach_batch(stream, observed_batch_writer(f"{tmp_dir}/out", [0.0, 1.0]), f"{tmp_dir}/checkpoint")
    got = spark.read.parquet(f"{tmp_dir}/out/metrics").collect()
    assert sorted(r.batch_id for r in got) == list(range(5)) and sorted(r.n for r in got) == [3, 4, 5, 6, 7]


def test_work_on_a_bucketed_key_plans_without_an_exchange(spark, tmp_dir):
    orders, lines = read_table(spark, SF001, "orders"), read_table(spark, SF001, "lineitem")
    names = [f"t_{uuid.uuid4().hex[:12]}" for _ in range(2)]
    assert write_bucketed(orders, names[0], ["o_orderkey"], 4, path=f"{tmp_dir}/orders")
    assert write_bucketed(lines, names[1], ["l_orderkey"], 4, path=f"{tmp_dir}/lines")
    o, li = (load_table(spark, n) for n in names)
    assert o.count() == orders.count() and li.count() == lines.count()
    sums = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    joined = dedup(o, ["o_orderkey"], deterministic=True).join(sums.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    for df in (dedup(o, ["o_orderkey"], deterministic=True), duplicate_keys(o, "o_orderkey"), sums, joined):
        assert "hashpartitioning" not in _plan(df)
    assert joined.agg(F.sum("n")).first()[0] == lines.count()


def test_a_hot_key_keeps_its_rows_without_buckets(spark, tmp_dir):
    df = spark.range(3000).select(F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id")).alias("k"), "id")
    name = f"t_{uuid.uuid4().hex[:12]}"
    assert bucket_skew(df, ["k"], 16) > 4
    assert not write_bucketed(df, name, ["k"], 16, path=f"{tmp_dir}/t")
    assert load_table(spark, name).agg(F.count("id"), F.sum("id")).first() == (3000, 3000 * 2999 // 2)
    empty = f"t_{uuid.uuid4().hex[:12]}"
    assert write_bucketed(df.limit(0), empty, ["k"], 16, path=f"{tmp_dir}/e") and load_table(spark, empty).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "k long, v int")
    assert write_bucketed(nulls, empty, ["k"], 2, path=f"{tmp_dir}/n") and dedup(load_table(spark, empty), ["k"]).count() == 2


def test_first_line_of_files_with_empty_ones_between(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/log")
    for i, text in enumerate(["", "head\n1\n", "2\n" * 500, ""]):
        with open(f"{tmp_dir}/log/part {i}.txt", "w") as f:  # a blank in the name
            f.write(text)
    lines = read_lines(spark, f"{tmp_dir}/log")
    assert first_line(lines) == first_line(lines, folder=f"{tmp_dir}/log") == "head"
    os.makedirs(f"{tmp_dir}/none")
    open(f"{tmp_dir}/none/a.txt", "w").close()
    assert first_line(read_lines(spark, f"{tmp_dir}/none"), folder=f"{tmp_dir}/none") is None
    assert first_line(spark.createDataFrame([("x",)], "value string")) == "x"
