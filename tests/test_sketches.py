import datetime

import numpy as np
import pytest

from lectern.operators import sketches

SHARES = [0.0, 0.5, 0.95, 1.0]


def events(spark, values, days=5):
    start = datetime.datetime(2024, 1, 1)
    rows = [(start + datetime.timedelta(days=i % days), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ts timestamp, v double")


def percentiles(found):
    return {r["share"]: r["value"] for r in found.collect()}


@pytest.mark.parametrize("k,slack,ranked", [(1024, 0.005, 10_000), (8, 0.0001, 10_000), (8, 0.05, 100)])
def test_kept_sketches_give_exact_percentiles(spark, tmp_path, k, slack, ranked):
    values = np.round(np.random.default_rng(1).exponential(50, 3001), 1).tolist()
    df, path = events(spark, [*values, None, float("nan")]), str(tmp_path / "kept")
    for day in range(5):
        sketches.append_sketches(df.where(f"day(ts) = {day + 1}"), path, "ts", "v", k)
    kept = sketches.read_sketches(spark, path)
    assert kept.selectExpr("sum(n)").first()[0] == 3001 and kept.count() == 5
    found = percentiles(sketches.exact_from_sketches(df, "v", kept, SHARES, slack, ranked))
    assert found == pytest.approx({s: np.quantile(values, s) for s in SHARES})


def test_sketches_that_lag_behind_or_are_empty(spark):
    df = events(spark, [float(i) for i in range(100)])
    old = sketches.day_sketches(df.where("v < 10"), "ts", "v")
    for kept in (old, old.limit(0)):
        assert percentiles(sketches.exact_from_sketches(df, "v", kept, SHARES)) == pytest.approx({0.0: 0.0, 0.5: 49.5, 0.95: 94.05, 1.0: 99.0})
    nothing = df.where("v < 0")
    assert sketches.exact_from_sketches(nothing, "v", old, SHARES).collect() == []
    assert sketches.estimated_percentiles(old.limit(0), SHARES).collect() == []


def test_estimates_need_no_data(spark):
    values = [float(i) for i in range(10_000)]
    found = percentiles(sketches.estimated_percentiles(sketches.day_sketches(events(spark, values), "ts", "v"), SHARES))
    assert all(abs(found[s] - s * 9999) < 100 for s in SHARES)
