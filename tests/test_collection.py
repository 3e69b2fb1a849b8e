"""Stored collections and bounded cell search."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import cells, search
from lectern.operators.collection import Collection


def points(spark, n, subjects=4, version=0):
    rows = [(f"p{i}", f"s{i % subjects}" if i % 11 else None, version, [float(i), 1.0]) for i in range(n)]
    return spark.createDataFrame(rows, "point_id string, subject string, version int, vector array<double>")


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/points/**/*.parquet", recursive=True)}


def content(df):
    return {r["point_id"]: (r["subject"], r["version"]) for r in df.collect()}


def test_newest_rows_win_and_untouched_buckets_keep_their_files(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"), buckets=6)
    held.upsert(points(spark, 200))
    want = content(points(spark, 200))
    assert content(held.read()) == want
    first = files(held.path)
    # a small upsert: moves one point to another subject, changes one, adds one; of two rows with one id the last by order stays
    new = spark.createDataFrame(
        [("p3", "moved", 1, [0.0, 1.0], 1), ("p3", "older", 1, [0.0, 1.0], 0), ("p4", "s0", 1, None, 0), ("new", None, 1, [1.0, 1.0], 0)],
        "point_id string, subject string, version int, vector array<double>, o int",
    )
    held.upsert(new, order="o")
    want |= {"p3": ("moved", 1), "p4": ("s0", 1), "new": (None, 1)}
    assert content(held.read()) == want
    assert content(held.read(subject="s3")) == {k: v for k, v in want.items() if v[0] == "s3"}
    assert content(held.read(subject="moved")) == {"p3": ("moved", 1)}
    assert {f: t for f, t in files(held.path).items() if f in first} == first
    # only buckets worn enough are rewritten
    held.upsert(points(spark, 40, version=2))
    want |= content(points(spark, 40, version=2))
    before = held.state()[1]
    worn = held.compact(share=0.18)
    after = held.state()[1]
    assert 0 < len(worn) < 6 and content(held.read()) == want
    for b in before:
        assert (len(after[b]) == 1) if b in worn else (after[b] == before[b])
    held.compact(share=0.0)
    assert all(len(batches) == 1 for batches in held.state()[1].values()) and content(held.read()) == want
    assert "LeftAnti" not in held.read()._jdf.queryExecution().executedPlan().toString()


def shuffles(spark, run):
    """Shuffles of whole rows in the plans of the writes that `run` makes, and their plans."""
    plans, write = [], Collection._write

    def watched(self, rows, batch, one_per_id=None):
        def picked(dealt, ids):
            plans.append(one_per_id(dealt, ids)._jdf.queryExecution().executedPlan().toString())
            return one_per_id(dealt, ids)

        return write(self, rows, batch, picked if one_per_id else None)

    Collection._write = watched
    try:
        run()
    finally:
        Collection._write = write
    return [(plan.count("Exchange hashpartitioning"), "Join" in plan) for plan in plans]


def test_rows_are_shuffled_once_by_upserts_and_compactions(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"), buckets=3)
    twice = points(spark, 300).union(points(spark, 300))
    some = spark.createDataFrame([("p1", "x", 9, [1.0], 2), ("p1", "y", 8, [1.0], 1), (None, "x", 1, [1.0], 1)], "point_id string, subject string, version int, vector array<double>, o int")
    none = some.where("point_id IS NULL").drop("o")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = [lambda: held.upsert(twice), lambda: held.upsert(some, order="o"), lambda: held.upsert(none), lambda: held.compact(share=0.0)]
        assert [x for run in runs for x in shuffles(spark, run)] == [(1, False)] * 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(len(batches) == 1 for batches in held.state()[1].values())
    got = [(r["point_id"], r["version"]) for r in held.read().collect()]
    assert sorted(x for x in got if x[0]) == sorted((f"p{i}", 9 if i == 1 else 0) for i in range(300))
    assert [x for x in got if not x[0]] == [(None, 1)] * 2


def test_a_batch_without_a_state_is_not_there(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"))
    with pytest.raises(ValueError):
        held.read()
    held.upsert(points(spark, 20))
    held._write(points(spark, 30, version=9), held._number(2))
    assert content(held.read()) == content(points(spark, 20))
    held.upsert(points(spark, 10, version=1))
    assert content(held.read()) == content(points(spark, 20)) | content(points(spark, 10, version=1))


def test_subjects_prune_folders(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"), buckets=2)
    odd = spark.createDataFrame([("a", "", 0), ("b", None, 0), ("c", "x/y=1", 0), ("d", "007", 0), ("e", "s1", 0)], "point_id string, subject string, version int")
    held.upsert(odd)
    assert content(held.read()) == content(odd)
    for s in ("", "x/y=1", "007"):
        one = held.read(subject=s)
        assert [r["subject"] for r in one.collect()] == [s]
        assert "PartitionFilters: [isnotnull(part" in one._jdf.queryExecution().executedPlan().toString()

    def read_files(df):
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return sum(s.metrics().get("numFiles").get().value() for s in scans if "parquet" in s.nodeName())

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        every, one = read_files(held.read()), read_files(held.read(subject="s1"))
        wanted = spark.createDataFrame([("s1", 5), ("", 1)], "subject string, n int").where(F.col("n") > 2)
        among = held.read(among=wanted)
        assert "dynamicpruning" in among._jdf.queryExecution().executedPlan().toString()
        assert (every, one, read_files(among)) == (5, 1, 1) and [r["point_id"] for r in among.collect()] == ["e"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("cell_rows", [8, 100, 10_000])
def test_cells_return_the_hits_of_a_full_scan(spark, cell_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 6))
    v = centres[rng.integers(0, 20, 1500)] + rng.normal(scale=0.05, size=(1500, 6))
    v[:5], v[5:40] = 0, v[40]
    rows = [(f"p{i}", x.tolist()) for i, x in enumerate(v)] + [("none", None)]
    df = spark.createDataFrame(rows, "point_id string, vector array<double>")
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate([v[40], v[100], -v[7], np.zeros(6), rng.normal(size=6)])] + [(9, None)], "query_id long, vector array<double>")
    for k in (1, 4, 50):
        got, work = cells.top_k_in_cells(spark, cells.write_cells(df, cell_rows=cell_rows), asked, k)
        want = search.top_k(df, asked, k)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
        assert work["read"] >= 0 and work["compared"] <= work["pairs"]


def test_bounds_leave_most_points_unread(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    v = centres[rng.integers(0, 40, 4000)] + rng.normal(scale=0.1, size=(4000, 16))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "point_id long, vector array<double>")
    asked = df.where("point_id % 500 = 0").withColumnRenamed("point_id", "query_id")
    got, work = cells.top_k_in_cells(spark, cells.write_cells(df, cell_rows=50), asked, 10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, search.top_k(df, asked, 10).select(got.columns).collect()))
    assert work["compared"] < 0.25 * work["pairs"], work


def test_cells_without_points_or_queries(spark):
    none = spark.createDataFrame([], "point_id long, vector array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0])], "point_id long, vector array<double>")
    asked = one.withColumnRenamed("point_id", "query_id")
    assert cells.top_k_in_cells(spark, cells.write_cells(none), asked)[0].collect() == []
    assert cells.top_k_in_cells(spark, cells.write_cells(one), asked.where("query_id > 1"))[0].collect() == []
