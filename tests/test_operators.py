"""Operators: edge cases and agreement with numpy/pandas/ML evaluators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spindle.operators.clean import (dedup, drop_header_lines, equals_typed, fill_defaults,
                                     iqr_filter, null_ratios)
from spindle.operators.metrics import accuracy_f1
from spindle.operators.models import evaluate
from spindle.operators.profile import (boxplot_stats, duplicate_keys, frequency, frequency_many,
                                       histogram, histogram_by, null_nan_counts, summary, top_k_per_group)
from spindle.operators.quantile import exact_quantiles
from spindle.operators.split import hash_split


def test_exact_quantiles_narrowing_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(0, 2, 5000), np.full(3000, 7.5), rng.normal(0, 1e-6, 500)])
    y = rng.integers(0, 5, x.size).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    # a tiny max_collect forces several narrowing passes
    got = exact_quantiles(df, ["x", "y"], probs, buckets=16, max_collect=50)
    for c, arr in (("x", x), ("y", y)):
        for p in probs:
            assert math.isclose(got[(c, p)], float(np.quantile(arr, p)), rel_tol=1e-12, abs_tol=1e-15)


def test_exact_quantiles_skip_null_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None), (None, None)],
                               "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.5])
    assert got[("a", 0.5)] == 2.0 and got[("b", 0.5)] is None


def test_histogram_matches_numpy_and_constant_column(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(10, 3, 2000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "c": np.full(2000, 4.0)}))
    h = {(r["column"], r["bin"]): r["count"] for r in histogram(df, ["x", "c"], 10).collect()}
    counts, _ = np.histogram(x, 10)
    assert [h[("x", i)] for i in range(10)] == counts.tolist()
    ccounts, _ = np.histogram(np.full(2000, 4.0), 10)
    assert [h[("c", i)] for i in range(10)] == ccounts.tolist()


def test_histogram_by_matches_numpy_per_category(spark):
    rng = np.random.default_rng(2)
    x, group = rng.normal(10, 3, 3000), rng.choice(["a", "b", "c"], 3000, p=[0.9, 0.09, 0.01]).tolist()
    rows = [(g, float(v), 4.0, None if g == "c" else 1.0) for g, v in zip(group, x)]
    rows += [(None, 11.0, 4.0, 2.0), ("d", None, None, float("nan"))]
    df = spark.createDataFrame(rows, "group string, `x.y` double, c double, column double")
    got = histogram_by(df.withColumnRenamed("x.y", "x"), "group", ["x", "c", "column"], 7)
    assert got.columns == ["group", "column", "bin", "bin_lo", "bin_hi", "count"]
    got = {(r["group"], r["column"], r["bin"]): r for r in got.collect()}
    edges = np.histogram_bin_edges([*x, 11.0], 7)
    for g in ("a", "b", "c"):
        want = np.histogram(x[np.array(group) == g], edges)[0].tolist()
        assert [got[(g, "x", i)]["count"] for i in range(7)] == want
        assert np.allclose([got[(g, "x", i)]["bin_lo"] for i in range(7)], edges[:-1]) and got[(g, "x", 6)]["bin_hi"] == edges[-1]
        assert [got[(g, "c", i)]["count"] for i in range(7)] == [0, 0, 0, sum(want), 0, 0, 0]
    assert sum(got[(None, "x", i)]["count"] for i in range(7)) == 1 and got[(None, "column", 6)]["count"] == 1
    # no value, no rows: "c" has none in the last column and "d" in no column
    assert {k[:2] for k in got} == {*[(g, c) for g in ("a", "b", None) for c in ("x", "c", "column")], ("c", "x"), ("c", "c")}
    assert histogram_by(df.limit(0), "group", ["c"]).collect() == []
    with pytest.raises(Exception, match="infinite value in c"):
        histogram_by(spark.createDataFrame([("a", float("inf"))], "g string, c double"), "g", ["c"]).collect()


def test_frequency_ties_and_null_group(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",), (None,), ("c",)], "v string")
    rows = [tuple(r) for r in frequency(df, "v").collect()]
    assert rows == [(None, 2), ("a", 2), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in frequency(df, "v", n=2).collect()] == [(None, 2), ("a", 2)]


def test_frequency_many_is_one_scan(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "a int, b string")
    out = frequency_many(df, ["a", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("FileScan") <= 1
    assert sorted(tuple(r) for r in out.collect()) == [("a", "1", 1), ("a", "2", 1), ("b", "x", 2)]


def test_top_k_per_group_uses_group_limit(spark):
    df = spark.createDataFrame([("g", 1), ("g", 1), ("g", 2), ("g", 3), ("h", 5)], "g string, v int")
    out = top_k_per_group(df, "g", "v", 2)
    assert sorted(tuple(r) for r in out.collect()) == [("g", 1, 2, 1), ("g", 2, 1, 2), ("h", 5, 1, 1)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_dedup_deterministic_keeps_smallest_row_and_null_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (None, "z", 1), (None, "y", 1), (2, "q", 0)],
                               "k int, s string, n int")
    rows = sorted((tuple(r) for r in dedup(df, ["k"], deterministic=True).collect()),
                  key=lambda r: (r[0] is None, r[0]))
    assert rows == [(1, "a", 9), (2, "q", 0), (None, "y", 1)]
    assert dedup(df, ["k"]).count() == 3


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "k int")
    assert [tuple(r) for r in duplicate_keys(df, "k").collect()] == [(3, 3), (1, 2)]


def test_fill_defaults_checks_types(spark):
    df = spark.createDataFrame([(None, None, float("nan"))], "s string, i int, d double")
    out = fill_defaults(df, {"s": "NY", "i": 0, "d": 1.5, "missing": 3}).first()
    assert tuple(out) == ("NY", 0, 1.5)
    with pytest.raises(TypeError):
        fill_defaults(df, {"i": "zero"})
    with pytest.raises(TypeError):
        fill_defaults(df, {"s": 5})


def test_equals_typed_casts_literal(spark):
    df = spark.createDataFrame([(9000000001,), (5,)], "k long")
    assert df.where(equals_typed(df, "k", "9000000001")).count() == 1


def test_drop_header_removes_every_copy(spark):
    df = spark.createDataFrame([("h",), ("a",), ("h",), ("b",)], "value string")
    assert [r[0] for r in drop_header_lines(df, "h").collect()] == ["a", "b"]


def test_iqr_filter_keeps_null_and_nan(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, None, float("nan")]
    df = spark.createDataFrame([(v, 1.0) for v in vals], "x double, y double")
    kept = [r[0] for r in iqr_filter(df, ["x", "y"]).collect()]
    assert 100.0 not in kept and None in kept and any(isinstance(v, float) and math.isnan(v) for v in kept)
    pdf = pd.DataFrame({"x": [1.0, 2.0, 3.0, 4.0, 100.0]})
    q1, q3 = pdf.quantile(0.25)["x"], pdf.quantile(0.75)["x"]
    expect = pdf[~((pdf < q1 - 1.5 * (q3 - q1)) | (pdf > q3 + 1.5 * (q3 - q1))).any(axis=1)]
    assert sorted(v for v in kept if v is not None and not math.isnan(v)) == expect["x"].tolist()


def test_boxplot_and_summary(spark):
    x = [1.0, 2.0, 2.0, 3.0, 4.0, 50.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    b = boxplot_stats(df, ["x"]).first()
    assert b["n_outliers"] == 1 and b["whisker_hi"] == 4.0 and b["whisker_lo"] == 1.0
    s = summary(df, ["x"]).first()
    assert s["count"] == 6 and math.isclose(s["stddev"], float(pd.Series(x).std()))


def test_null_profile_counts_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"), None), (None, "a"), (1.0, None)], "d double, s string")
    rows = {r["column"]: (r["n_nan"], r["n_null"]) for r in null_nan_counts(df).collect()}
    assert rows == {"d": (1, 1), "s": (0, 2)}
    assert null_ratios(df) == {"d": 1 / 3, "s": 2 / 3}


def test_metrics_match_evaluator_and_empty(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 3.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = accuracy_f1(df).first()
    ev = evaluate(df)
    assert math.isclose(m["accuracy"], ev["accuracy"]) and math.isclose(m["f1"], ev["f1"])
    empty = accuracy_f1(df.where(F.lit(False))).first()
    assert empty["n"] == 0 and empty["accuracy"] is None and empty["f1"] is None


def test_hash_split_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a1, b1 = hash_split(df, "k")
    a2, _ = hash_split(df.repartition(7), "k")
    assert a1.count() + b1.count() == 1000
    assert sorted(r[0] for r in a1.collect()) == sorted(r[0] for r in a2.collect())


def test_native_minmax_equals_ml_scaler(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from spindle.operators.features import assembler, minmax_scale, minmax_scaler
    rows = [(1.0, 5.0, 2.0), (3.0, 5.0, -1.0), (2.0, 5.0, 7.5), (9.0, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    train = df.limit(3)
    model = Pipeline(stages=[assembler(["a", "b", "c"], "v"), minmax_scaler("v", "s")]).fit(train)
    ml = [r[0] for r in model.transform(df).select(vector_to_array("s")).collect()]
    native = [[r["s_a"], r["s_b"], r["s_c"]] for r in minmax_scale(df, ["a", "b", "c"], fit_on=train).collect()]
    assert ml == native


def test_category_bins_cover_every_value(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    from spindle.operators.features import category_bins
    df = spark.createDataFrame([(f"v{i % 40}" if i % 41 else None, float(i % 2)) for i in range(400)], "v string, label double")
    bins = category_bins(df, ["v"], 100)
    assert bins == 41
    stages = [StringIndexer(inputCol="v", outputCol="i", handleInvalid="keep"), VectorAssembler(inputCols=["i"], outputCol="features")]
    model = Pipeline(stages=[*stages, RandomForestClassifier(numTrees=2, maxBins=bins)]).fit(df)
    assert model.transform(spark.createDataFrame([("unseen", 0.0)], df.schema)).count() == 1
    with pytest.raises(ValueError, match="'v' has 40 categories"):
        category_bins(df, ["v"], 40)


@pytest.mark.parametrize("accuracy", [None, 3, 1000, 100_000])
def test_exact_quantiles_with_any_sketch_bracket(spark, accuracy):
    """Coarse sketches give loose or wrong brackets; the result stays exact."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.standard_cauchy(3000), np.full(2000, -1.25)])
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = exact_quantiles(df, ["x"], probs, buckets=8, max_collect=40, sketch_accuracy=accuracy)
    for p in probs:
        assert math.isclose(got[("x", p)], float(np.quantile(x, p)), rel_tol=1e-12, abs_tol=1e-15)


def test_exact_quantiles_survive_a_wrong_sketch(spark, monkeypatch):
    """A sketch whose bracket misses the rank is caught by the exact check
    and the rank is found from the full range instead."""
    import spindle.operators.quantile as Q
    real = Q.F.percentile_approx

    def wrong(col, percentages, accuracy):
        _ = real
        return F.array(*[F.lit(1e9) for _ in percentages])
    monkeypatch.setattr(Q.F, "percentile_approx", wrong)
    x = np.arange(500, dtype=float)[::-1]
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = Q.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], buckets=8, max_collect=20,
                            sketch_accuracy=1000)
    for p in (0.1, 0.5, 0.9):
        assert math.isclose(got[("x", p)], float(np.quantile(x, p)))


def test_header_is_the_first_line_of_the_first_file(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/log", exist_ok=True)
    with open(f"{tmp_dir}/log/part-0.txt", "w") as f:
        f.write("date time\n2024-01-01 07:15:00\n")
    with open(f"{tmp_dir}/log/part-1.txt", "w") as f:  # larger file, read first by Spark
        f.write("".join(f"2024-01-0{1 + i % 9} 19:0{i % 10}:11\n" for i in range(200)))
    from spindle.sources.readers import read_lines
    lines = read_lines(spark, f"{tmp_dir}/log")
    kept = drop_header_lines(lines)
    assert kept.count() == 201 and kept.where("value = 'date time'").count() == 0


def test_edge_cases_quotes_null_keys_maps(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5)], "`it's` double, k int")
    assert summary(df, ["it's"]).first()["column"] == "it's"
    assert boxplot_stats(df, ["it's"]).first()["column"] == "it's"
    a, b = hash_split(df, "k")
    assert a.count() + b.count() == 2  # the null key is not lost
    m = spark.createDataFrame([(1, {"b": 2}), (1, {"a": 1})], "k int, m map<string,int>")
    assert dedup(m, ["k"], deterministic=True).first()["m"] == {"a": 1}
    from spindle.functions import chw_to_hwc
    n = spark.createDataFrame([(None,)], "a array<double>")
    assert n.select(chw_to_hwc("a", 1, 1, 2)).first()[0] is None


def test_approx_quartiles_within_rank_error(spark):
    from spindle.operators.profile import quartiles
    from spindle.operators.quantile import approx_quantiles
    x = np.arange(10_000, dtype=float)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    q = approx_quantiles(df, ["x"], [0.25, 0.5], accuracy=1000)
    assert abs(q[("x", 0.5)] - 5000) <= 10_000 / 1000 + 1
    row = quartiles(df, ["x"], exact=False).first()
    assert abs(row["q1"] - 2500) <= 11 and abs(row["q3"] - 7500) <= 11


def test_fit_transform_on_train_only_and_metrics_frame(spark):
    from spindle.operators.features import assembler, fit_transform, minmax_scaler, vector_columns
    from spindle.sources.readers import metrics_frame
    df = spark.createDataFrame([(0.0,), (10.0,), (20.0,)], "x double")
    train = df.where("x <= 10")
    _, tr, full = fit_transform([assembler(["x"], "v"), minmax_scaler("v", "s")], train, df)
    got = sorted(r["s0"] for r in vector_columns(full, "s", ["s0"]).collect())
    assert got == [0.0, 1.0, 2.0]  # the test value lies outside the train range
    assert tr.count() == 2
    m = metrics_frame(spark, [(0, 0.5)], "batch_id long, accuracy double")
    assert m.first()["accuracy"] == 0.5


def test_summary_matches_describe(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"a": rng.normal(size=300), "b": rng.integers(0, 9, 300)}))
    desc = {r["summary"]: r for r in df.describe("a", "b").collect()}
    for r in summary(df, ["a", "b"]).collect():
        c = r["column"]
        assert r["count"] == int(desc["count"][c])
        for stat in ("mean", "stddev", "min", "max"):
            assert math.isclose(r[stat], float(desc[stat][c]), rel_tol=1e-9)


def test_quantiles_with_infinities_and_huge_ranges(spark):
    from spindle.operators.quantile import exact_quantiles
    inf = float("inf")
    values = [inf, -inf, -inf, 1e308, -1e308, 0.0, 5e-324] + [float(i) for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.003, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999, 1.0]
    want = np.quantile(values, [0.25, 0.5, 0.75])
    for limit in (1, 500):
        got = exact_quantiles(df, ["x"], probs, max_collect=limit)
        assert [got["x", p] for p in (0.25, 0.5, 0.75)] == pytest.approx(want)
        assert got["x", 0.0] == -inf and got["x", 1.0] == inf
    only = exact_quantiles(spark.createDataFrame([(inf,), (inf,)], "x double"), ["x"], [0.5])
    assert only["x", 0.5] == inf


def test_histogram_of_a_large_constant_and_words_of_empty_texts(spark):
    from spindle.operators.profile import histogram
    from spindle.operators.text import words_per_line
    rows = histogram(spark.createDataFrame([(1e17,), (1e17,)], "x double"), ["x"]).collect()
    assert sum(r["count"] for r in rows) == 2
    with pytest.raises(Exception, match="infinite"):
        histogram(spark.createDataFrame([(1.0,), (float("inf"),)], "x double"), ["x"]).collect()
    got = words_per_line(spark.createDataFrame([("a", ""), ("b", "x y")], "g string, text string"), by=["g"]).collect()
    assert {r.g: r.avg_words_per_line for r in got} == {"a": None, "b": 2.0}


def test_lines_without_an_hour_have_no_bin(spark):
    from spindle.functions import click_hour_bin, hour_from_log_line
    rows = spark.createDataFrame([("d 23:10",), ("d x:10",), ("d",)], "v string").select(click_hour_bin(hour_from_log_line("v")).alias("b")).collect()
    assert [r.b for r in rows] == ["18-24", None, None]
