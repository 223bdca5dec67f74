"""CSV with broken rows, the declared schema, and sketches that merge."""

import os

import pytest
from pyspark.sql import functions as F

from spindle.operators.sketches import batch_sketches, merged_profile
from spindle.sources.citations import CITATION_COLUMNS, CITATION_SCHEMA, part_csv


def _csv(folder, *lines, name="a.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def test_broken_rows_are_parted(spark, tmp_dir):
    header = ",".join(CITATION_COLUMNS)
    rest = "," * (len(CITATION_COLUMNS) - 6)
    lines = [f"1,P,NY,PAS,01/02/2015,5{rest}", f"x,P,NY,PAS,01/02/2015,5{rest}", "2,too,few", f"3,P,NY,PAS,01/02/2015,5{rest},more", f'4,"a, b",NY,PAS,,{rest}', f"5,P,NY,PAS,01/02/2015,5.5{rest}"]
    good, bad = part_csv(spark, _csv(f"{tmp_dir}/in", header, *lines), CITATION_SCHEMA, f"{tmp_dir}/out")
    assert good.columns == CITATION_COLUMNS and [t for _, t in good.dtypes].count("string") == 38
    assert sorted((r["Summons Number"], r["Plate ID"]) for r in good.collect()) == [(1, "P"), (4, "a, b")]
    assert sorted(r.raw for r in bad.collect()) == sorted([lines[1], lines[2], lines[3], lines[5]])


def test_a_drifted_header_stops_the_job(spark, tmp_dir):
    names = [CITATION_COLUMNS[1], CITATION_COLUMNS[0], *CITATION_COLUMNS[2:]]
    with pytest.raises(Exception, match="(?i)header"):
        part_csv(spark, _csv(f"{tmp_dir}/in", ",".join(names), "," * 47), CITATION_SCHEMA, f"{tmp_dir}/out")


def test_merged_sketches_equal_one_of_all(spark):
    df = spark.range(20_000, numPartitions=4).select((F.col("id") % 5).alias("day"), F.when(F.col("id") % 10 != 0, F.col("id") * 1.0).alias("x"),
                                                     (F.col("id") % 3000).alias("v")).unionByName(spark.createDataFrame([(9, float("nan"), None), (9, None, None)], "day long, x double, v long"))
    got = {r.column: r for r in merged_profile(batch_sketches(df, ["x"], ["v"], ["day"])).collect()}
    assert (got["x"].n, got["x"].n_null, got["x"].n_distinct) == (18_000, 2_002, None) and (got["v"].n, got["v"].n_null, got["v"].quantiles) == (20_000, 2, None)
    assert abs(got["v"].n_distinct - 3000) < 150
    for q, x in zip((0.25, 0.5, 0.75), got["x"].quantiles, strict=True):
        assert abs(x / 20_000 - q) < 0.02
    assert merged_profile(batch_sketches(df.limit(0), ["x"], ["v"], ["day"])).collect() == []
