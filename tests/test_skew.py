"""One key holding a third of all rows: results stay whole and exact, and
every operator reduces map-side before its shuffle."""

import numpy as np
import pandas as pd
import pytest


from spindle.operators.clean import dedup
from spindle.operators.metrics import accuracy_f1
from spindle.operators.profile import duplicate_keys, frequency, top_k_per_group
from spindle.operators.quantile import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    n = 30_000
    key = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 2_000, n))  # key 0: a third
    pdf = pd.DataFrame({"k": key, "v": rng.integers(0, 50, n), "x": rng.normal(size=n),
                        "label": rng.integers(0, 3, n).astype(float)})
    pdf["prediction"] = np.where(pdf["k"] == 0, pdf["label"], (pdf["label"] + 1) % 3)
    return spark.createDataFrame(pdf).repartition(24), pdf


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_results_are_whole(skewed):
    df, pdf = skewed
    assert dedup(df, ["k"], deterministic=True).count() == pdf["k"].nunique()
    hot = dedup(df, ["k"], deterministic=True).where("k = 0").first()
    exp = pdf[pdf["k"] == 0].sort_values(["v", "x", "label", "prediction"]).iloc[0]
    assert (hot["v"], hot["x"]) == (exp["v"], exp["x"])
    top = {r["k"]: r["count"] for r in frequency(df, "k", n=1).collect()}
    assert top == {0: int((pdf["k"] == 0).sum())}
    d = duplicate_keys(df, "k").first()
    assert d["k"] == 0 and d["count"] == 10_000
    tk = top_k_per_group(df, "k", "v", 3).where("k = 0").orderBy("rank").collect()
    exp_counts = pdf[pdf["k"] == 0]["v"].value_counts()
    exp_top = sorted(exp_counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [(r["v"], r["count"]) for r in tk] == [(int(a), int(b)) for a, b in exp_top]
    m = accuracy_f1(df).first()
    assert m["n"] == len(pdf) and abs(m["accuracy"] - (pdf["label"] == pdf["prediction"]).mean()) < 1e-12
    q = exact_quantiles(df.where("k = 0"), ["x"], [0.5], buckets=16, max_collect=100)
    assert abs(q[("x", 0.5)] - pdf[pdf["k"] == 0]["x"].median()) < 1e-12


def test_every_operator_reduces_before_the_shuffle(skewed):
    df, _ = skewed
    for out in (frequency(df, "k"), duplicate_keys(df, "k"), accuracy_f1(df)):
        plan = _plan(out)
        assert "partial_" in plan  # map-side partial aggregate below the exchange
    for out in (dedup(df, ["k"], deterministic=True), top_k_per_group(df, "k", "v", 3)):
        plan = _plan(out)
        assert "WindowGroupLimit" in plan and "Partial" in plan

