"""Quick start: the original workflows as spindle calls.

Run with ``PYTHONPATH=. python examples/quickstart.py``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml.feature import StringIndexer  # noqa: E402

import spindle as sp  # noqa: E402
from spindle.functions import click_hour_bin, hour_from_log_line  # noqa: E402
from spindle.operators.clean import drop_header_lines  # noqa: E402
from spindle.operators.features import assembler, category_bins, string_indexer  # noqa: E402
from spindle.operators.models import logistic_regression, score_report, train_pipelines  # noqa: E402
from spindle.sinks.writers import write_messages  # noqa: E402
from spindle.sources.readers import read_csv, read_lines  # noqa: E402
from spindle.streaming import (decode_messages, message_stream, metrics_batch_writer,  # noqa: E402
                               run_foreach_batch)


def run(spark) -> dict:
    root = sp.scratch_path(spark, "quickstart")

    # 1. click log -> four hour bins (text source, header lines removed)
    spark.createDataFrame([("date time",), ("2024-01-01 07:15:00",), ("2024-01-01 19:02:11",)],
                          "value string").write.mode("overwrite").text(f"{root}/clicks")
    lines = drop_header_lines(read_lines(spark, f"{root}/clicks"))
    bins = lines.groupBy(click_hour_bin(hour_from_log_line("value")).alias("bin")).count()

    # 2. citations: declared-schema CSV -> the shared clean -> one-scan profile
    cit = spark.createDataFrame(
        [(1, "01/05/2015", "0752A", "NY", "K"), (1, "01/05/2015", "0752A", "NY", "K"),
         (2, "1/2/2016", "0030P", None, "Q"), (3, "13/02/2015", "0800A", "NJ", "K")],
        "`Summons Number` long, `Issue Date` string, `Violation Time` string, "
        "`Registration State` string, Violation_County string")
    cit.write.mode("overwrite").option("header", True).csv(f"{root}/citations")
    raw = read_csv(spark, f"{root}/citations", schema=cit.schema)
    df = sp.clean(raw, sp.PARKING_SPEC)
    profile = sp.frequency_many(df, ["Registration State", "Time bin", "Issue Year"])

    # 3. index -> assemble -> train -> evaluate (a fresh stage list per model)
    label = StringIndexer(inputCol="Violation_County", outputCol="label").fit(df)
    data, max_bins = df, category_bins(df, ["Registration State"], limit=10000)
    stages = [label, string_indexer(["Registration State"]),
              assembler(["Issue Day", "Issue Month", "Issue Year", "Time bin", "Registration State_idx"])]
    models = train_pipelines(stages, {"lr": logistic_regression(maxIter=10)}, data)
    report = score_report(models, {"all": data})

    # 4. the same clean + model on a message stream; per-batch metrics tables
    write_messages(raw, f"{root}/topic", "citations")
    rows, _quarantine = decode_messages(message_stream(spark, f"{root}/topic"), raw.schema)
    scored = models["lr"].transform(sp.clean(rows, sp.PARKING_SPEC))
    run_foreach_batch(scored.select("label", "prediction"), metrics_batch_writer(f"{root}/scores"),
                      f"{root}/ckpt")
    return {"bins": sorted(map(tuple, bins.collect())), "profile_rows": profile.count(),
            "report": [r.asDict() for r in report.collect()],
            "stream_metrics": [r.asDict() for r in spark.read.parquet(f"{root}/scores/metrics").collect()]}


if __name__ == "__main__":
    print(run(sp.get_spark("local[*]")))
