def test_quickstart_runs(spark):
    from examples.quickstart import run
    out = run(spark)
    assert out["bins"] == [("18-24", 1), ("6-12", 1)]
    assert out["report"][0]["n"] == 2 and out["stream_metrics"][0]["n"] == 2
