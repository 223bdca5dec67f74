"""Sources, sinks and streaming jobs on small fixtures."""

import os

import pytest
from pyspark.sql import functions as F

from spindle.operators.clean import PARKING_LABEL, PARKING_SPEC, clean
from spindle.operators.inference import image_size
from spindle.operators.text import line_lengths_from_files
from spindle.session import scratch_path
from spindle.sinks.writers import to_messages, write_messages, write_text
from spindle.sources.readers import (read_binary_files, read_csv, read_lines,
                                     read_whole_texts, stack_batches)
from spindle.streaming.jobs import (decode_messages, dedup_stream, file_arrivals, message_stream,
                                    metrics_batch_writer, per_file_line_counts, progress_durations,
                                    run_available_now, run_foreach_batch)


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_csv_inferred_and_declared(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", b"Summons Number,Issue Date,Violation Time,Unregistered Vehicle?\n"
                               b"9000000001,01/02/2015,0752A,0\n5,1/2/2015,1200P,\n")
    inferred = read_csv(spark, tmp_dir, infer=True)
    types = dict(inferred.dtypes)
    assert types["Summons Number"] in ("bigint", "int") and types["Issue Date"] == "string"
    assert types["Violation Time"] == "string"
    declared = read_csv(spark, tmp_dir, schema="`Summons Number` long, `Issue Date` string, "
                                               "`Violation Time` string, `Unregistered Vehicle?` int")
    assert declared.count() == 2 and declared.where(F.col("Unregistered Vehicle?").isNull()).count() == 1


def test_text_lines_whole_text_and_empty_file(spark, tmp_dir):
    _write(f"{tmp_dir}/t/a.txt", "one\ntwo\n".encode())
    _write(f"{tmp_dir}/t/b.txt", "x\r\ny".encode())
    _write(f"{tmp_dir}/t/c.txt", b"")
    lines = read_lines(spark, f"{tmp_dir}/t")
    assert sorted(r[0] for r in lines.collect()) == ["one", "two", "x", "y"]
    per_file = {os.path.basename(r["path"]): r["n_lines"] for r in line_lengths_from_files(lines).collect()}
    assert per_file == {"a.txt": 2, "b.txt": 2}  # an empty file gives no row
    whole = {os.path.basename(r["path"]): r["value"] for r in read_whole_texts(spark, f"{tmp_dir}/t").collect()}
    assert whole["a.txt"] == "one\ntwo\n"


def test_binary_files_glob_and_png_size(spark, tmp_dir):
    png = b"\x89PNG\r\n\x1a\n" + b"\x00\x00\x00\rIHDR" + (32).to_bytes(4, "big") + (16).to_bytes(4, "big") + b"\x08"
    _write(f"{tmp_dir}/img/cat/1.png", png)
    _write(f"{tmp_dir}/img/dog/2.png", png)
    _write(f"{tmp_dir}/img/dog/notes.txt", b"skip me")
    files = read_binary_files(spark, f"{tmp_dir}/img", glob="*.png")
    rows = files.select(F.regexp_extract("path", "img/([^/]+)/", 1).alias("label"),
                        image_size("content").alias("size")).orderBy("label").collect()
    assert [(r["label"], r["size"]["width"], r["size"]["height"]) for r in rows] == \
        [("cat", 32, 16), ("dog", 32, 16)]
    assert "content" not in read_binary_files(spark, f"{tmp_dir}/img", with_content=False).columns


def test_text_sink_single_file_and_stack(spark, tmp_dir):
    df = spark.createDataFrame([("0-6", 3), ("6-12", 4)], "bin string, n long")
    write_text(df, f"{tmp_dir}/out", single_file=True)
    parts = [p for p in os.listdir(f"{tmp_dir}/out") if p.startswith("part-")]
    assert len(parts) == 1
    stacked = stack_batches([df, df.select("n", "bin")])
    assert stacked.count() == 4 and stacked.columns == ["bin", "n"]


def test_messages_omit_nulls_and_quarantine(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, "b")], "id long, s string")
    vals = [bytes(r[0]).decode() for r in to_messages(df, "t").select("value").collect()]
    assert vals == ['{"id":1}', '{"id":2,"s":"b"}']
    bad = spark.createDataFrame([(bytearray(b"\xff"),), (bytearray(b"nope"),), (bytearray(b'{"id":3}'),)],
                                "value binary")
    rows, quarantine = decode_messages(bad, "id long, s string")
    assert [r["id"] for r in rows.collect()] == [3]
    assert sorted(r["reason"] for r in quarantine.collect()) == ["not json", "not utf-8"]


def test_stream_dedup_restart_emits_nothing_new(spark, tmp_dir):
    topic, sink, ckpt = f"{tmp_dir}/topic", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    ev = spark.createDataFrame([(i, f"e{i % 3}") for i in range(50)], "event_id long, kind string")
    write_messages(ev, topic, "ev")
    write_messages(ev.where("event_id < 10"), topic, "ev")  # duplicates in a later file

    def run():
        rows, _ = decode_messages(message_stream(spark, topic), "event_id long, kind string")
        return run_available_now(dedup_stream(rows, ["event_id"]), sink, ckpt)
    run()
    assert spark.read.parquet(sink).count() == 50
    write_messages(ev.where("event_id >= 45"), topic, "ev")  # only duplicates arrive
    progress = run()
    assert spark.read.parquet(sink).count() == 50
    assert all(p["rows"] >= 0 for p in progress_durations(progress))
    run()  # nothing new at all
    assert spark.read.parquet(sink).count() == 50


def test_metrics_writer_handles_empty_batch_and_replay(spark, tmp_dir):
    write = metrics_batch_writer(f"{tmp_dir}/m")
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    write(df, 0)
    write(df.where(F.lit(False)), 1)
    write(df, 0)  # a replayed batch replaces its own output
    m = {r["batch_id"]: r for r in spark.read.parquet(f"{tmp_dir}/m/metrics").collect()}
    assert set(m) == {0, 1}
    assert m[0]["n"] == 2 and m[0]["accuracy"] == 0.5 and m[0]["accuracy_pct"] == 50.0
    assert m[1]["n"] == 0 and m[1]["accuracy"] is None
    assert spark.read.parquet(f"{tmp_dir}/m/predictions").count() == 2


def test_file_arrival_counts(spark, tmp_dir):
    _write(f"{tmp_dir}/land/a.txt", b"1\n2\n3\n")
    _write(f"{tmp_dir}/land/b.txt", b"1\n")
    run_foreach_batch(file_arrivals(spark, f"{tmp_dir}/land", max_files_per_trigger=1),
                      per_file_line_counts(f"{tmp_dir}/counts"), f"{tmp_dir}/ckpt")
    got = {os.path.basename(r["path"]): r["n_lines"] for r in spark.read.parquet(f"{tmp_dir}/counts").collect()}
    assert got == {"a.txt": 4, "b.txt": 2}  # as splitting at every line break counts
    _write(f"{tmp_dir}/land/c.txt", b"x\r\ny")
    _write(f"{tmp_dir}/land/d.txt", "\ufeffé\n\n".encode())
    _write(f"{tmp_dir}/land/e.txt", b"\n")
    run_foreach_batch(file_arrivals(spark, f"{tmp_dir}/land", max_files_per_trigger=1),
                      per_file_line_counts(f"{tmp_dir}/counts"), f"{tmp_dir}/ckpt")
    got = {os.path.basename(r["path"]): r["n_lines"] for r in spark.read.parquet(f"{tmp_dir}/counts").collect()}
    assert got == {"a.txt": 4, "b.txt": 2, "c.txt": 2, "d.txt": 3, "e.txt": 2}


# --- the citation cleaning on a fixture with the edge rows -------------------

PARKING_COLS = ["Summons Number", "Plate ID", "Registration State", "Plate Type", "Issue Date",
                "Violation Code", "Vehicle Body Type", "Vehicle Make", "Issuing Agency",
                "Street Code1", "Street Code2", "Street Code3", "Issuer Code", "Issuer Command",
                "Issuer Squad", "Violation Time", "Time First Observed", "Violation_County",
                "Meter Number", "Law Section"]
PARKING_DDL = ", ".join(f"`{c}` " + ("long" if c == "Summons Number" else
                                     "int" if c in ("Violation Code", "Street Code1", "Street Code2",
                                                    "Street Code3", "Issuer Code", "Law Section")
                                     else "string") for c in PARKING_COLS)


def _citation(key, date, time, county, state=None, code1=None):
    return (key, "P1", state, "PAS", date, 21, "SUBN", "FORD", "T", code1, 0, 0, 7, "T103", "A",
            time, None, county, None, 408)


def parking_fixture(spark):
    rows = [
        _citation(1, "01/05/2015", "0752A", "NY"),
        _citation(1, "01/05/2015", "0752A", "NY"),          # repeated key
        _citation(None, "03/04/2016", "1200A", "K"),         # null key
        _citation(2, "06/07/2012", "0100P", "Q"),            # year 2012: removed
        _citation(3, "06/07/2018", "0100P", "Q"),            # year 2018: removed
        _citation(4, "1/2/2015", "0030P", "BX"),             # one-digit parts
        _citation(5, "13/02/2015", "0800A", "R"),            # bad date: removed
        _citation(6, None, "0800A", "R"),                    # null date: removed
        _citation(7, "02/02/2017", "0752a", "NY"),           # lower-case marker
        _citation(8, "02/02/2017", "7:52A", None),           # odd time text; null county
        _citation(9, "02/02/2017", "", "K"),                 # empty time
        _citation(10, "02/02/2017", None, "K", state="NJ", code1=5),
    ]
    return spark.createDataFrame(rows, PARKING_DDL)


def test_parking_clean_fixture(spark):
    out = clean(parking_fixture(spark), PARKING_SPEC)
    rows = sorted(out.collect(), key=lambda r: (r["Issue Year"], r["Time bin"], r["Registration State"]))
    assert "Summons Number" not in out.columns and "Time First Observed" not in out.columns
    assert "Meter Number" not in out.columns and "Issue Date" not in out.columns
    assert {r["Issue Year"] for r in rows} <= {2013, 2014, 2015, 2016, 2017}
    assert len(rows) == 7  # 12 rows - 1 duplicate - 4 removed by date
    bins = sorted(r["Time bin"] for r in rows)
    assert bins == [1, 2, 2, 3, 3, 3, 4]
    assert {r["Registration State"] for r in rows} == {"NY", "NJ"}  # default filled
    assert all(r["Street Code1"] in (0, 5) for r in rows)
    assert {r[PARKING_LABEL] for r in rows} >= {"NY", "K", None}


@pytest.mark.parametrize("n_files", [1, 3])
def test_clean_batch_equals_stream(spark, tmp_dir, n_files):
    """The shared clean gives the same rows on a batch and on a stream split
    into ``n_files`` micro-batches (the repeated key's rows are identical,
    and its second copy arrives in a later micro-batch when n_files > 1)."""
    fixture = parking_fixture(spark)
    batch = clean(fixture, PARKING_SPEC)
    topic = scratch_path(spark, "parking-topic")
    rows_py = fixture.collect()
    for i in range(n_files):
        part = [r for j, r in enumerate(rows_py) if j % n_files == i]
        write_messages(spark.createDataFrame(part, fixture.schema).coalesce(1), topic, "citations")
    msgs = message_stream(spark, topic, max_files_per_trigger=1)
    rows, _ = decode_messages(msgs, fixture.schema)
    sink = f"{tmp_dir}/clean"
    progress = run_available_now(clean(rows, PARKING_SPEC), sink, f"{tmp_dir}/ckpt")
    assert len(progress) >= n_files
    stream = spark.read.parquet(sink).select(*batch.columns)
    assert sorted(map(tuple, batch.collect()), key=str) == sorted(map(tuple, stream.collect()), key=str)


def test_file_arrivals_archive_processed_files(spark, tmp_dir):
    _write(f"{tmp_dir}/zone/in/a.txt", b"1\n2\n")
    run_foreach_batch(file_arrivals(spark, f"{tmp_dir}/zone/in", archive_dir=f"{tmp_dir}/archive"),
                      per_file_line_counts(f"{tmp_dir}/counts"), f"{tmp_dir}/ckpt")
    _write(f"{tmp_dir}/zone/in/b.txt", b"3\n")
    run_foreach_batch(file_arrivals(spark, f"{tmp_dir}/zone/in", archive_dir=f"{tmp_dir}/archive"),
                      per_file_line_counts(f"{tmp_dir}/counts"), f"{tmp_dir}/ckpt")
    got = sorted(r["n_lines"] for r in spark.read.parquet(f"{tmp_dir}/counts").collect())
    assert got == [2, 3]
    # files of completed batches are moved out of the landing folder
    assert "a.txt" not in os.listdir(f"{tmp_dir}/zone/in")


def test_clean_stream_with_watermark_dedup(spark, tmp_dir):
    from dataclasses import replace
    ddl = ("`Summons Number` long, `Issue Date` string, `Violation Time` string, "
           "ts timestamp, Violation_County string")
    rows = [(1, "01/05/2015", "0752A", "2015-01-05 07:52:00", "K"),
            (1, "01/05/2015", "0752A", "2015-01-05 07:52:00", "K"),
            (2, "01/05/2015", "0130P", "2015-01-05 13:30:00", "Q")]
    df = spark.createDataFrame(rows, ddl.replace("ts timestamp", "ts string")) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    topic = f"{tmp_dir}/wm-topic"
    write_messages(df, topic, "citations")
    msgs, _ = decode_messages(message_stream(spark, topic), ddl)
    spec = replace(PARKING_SPEC, stream_watermark=("ts", "1 hour"))
    run_available_now(clean(msgs, spec), f"{tmp_dir}/wm-out", f"{tmp_dir}/wm-ckpt")
    out = spark.read.parquet(f"{tmp_dir}/wm-out")
    assert out.count() == 2 and sorted(r["Time bin"] for r in out.collect()) == [2, 4]


def test_load_table_by_path_and_by_view(spark, tmp_dir):
    from spindle.sources.readers import load_table, register_view
    df = spark.createDataFrame([(1,), (2,)], "k int")
    df.write.mode("overwrite").parquet(f"{tmp_dir}/t.parquet")
    assert load_table(spark, f"{tmp_dir}/t.parquet").count() == 2
    register_view(df, "spindle_test_view")
    assert load_table(spark, "spindle_test_view").count() == 2


def test_watermark_dedup_over_many_batches_keeps_every_row(spark):
    from spindle.plans.streams import _dedup_job
    got = _dedup_job(spark, "/root/testdata/sf0.001", watermark=True, max_files_per_trigger=1)
    want = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert sorted(r.event_id for r in got.select("event_id").collect()) == sorted(r.event_id for r in want.select("event_id").collect())


def test_messages_that_are_no_objects_are_quarantined(spark):
    from spindle.streaming.jobs import decode_messages
    msgs = spark.createDataFrame([(bytearray(v),) for v in (b'{"id": 1}', b' {"id": 2}', b"123", b"[1]", b'"x"', b"{", b"\xff")] + [(None,)], "value binary")
    rows, quarantine = decode_messages(msgs, "id int")
    assert sorted(r.id for r in rows.collect()) == [1, 2] and quarantine.count() == 6
