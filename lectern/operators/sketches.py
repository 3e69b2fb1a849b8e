"""Percentiles from a kept table of mergeable quantile sketches: one row per day and batch, merged when asked."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.ordered import RANKED_VALUES, narrowed, ranked_between

#: Size parameter of the sketches: their ranks are off by about a third of a percent at most, nearly always.
SKETCH_K = 1024
#: Ranks by which a bracket reaches beyond its share.
SLACK = 0.005


def _number(value: str) -> Column:
    return F.col(value).cast("double")


def _numbers(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a number: neither null nor NaN."""
    return df.where(_number(value).isNotNull() & ~F.isnan(_number(value)))


def day_sketches(df: DataFrame, ts: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """(day, n, sketch) of the numbers of each day; partial sketches merge before the shuffle."""
    return _numbers(df, value).groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(_number(value), F.lit(k)).alias("sketch")
    )


def append_sketches(batch: DataFrame, path: str, ts: str, value: str, k: int = SKETCH_K) -> None:
    """Add a batch to the sketch table; a day that comes in several batches has several rows. Earlier rows aren't read."""
    day_sketches(batch, ts, value, k).write.mode("append").parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("day date, n bigint, sketch binary").parquet(path)


def estimated_percentiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, value) of all rows of the sketch table, without the data: each within the rank error of the sketch."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("s"), F.sum("n").alias("n")).where(F.col("n") > 0)
    # the sketch function takes constant ranks only
    rows = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("s", F.lit(float(s))).alias("value")) for s in shares]
    return merged.select(F.inline(F.array(*rows)))


def exact_from_sketches(
    df: DataFrame, value: str, sketches: DataFrame, shares: Sequence[float], slack: float = SLACK, ranked: int = RANKED_VALUES
) -> DataFrame:
    """Interpolated percentiles (share, value), exact whatever the sketches say.

    The merged sketch brackets every share; one pass counts below and inside all brackets. A bracket that misses its rank
    (an unlucky sketch, or one that lags behind the data) becomes the whole range; one with more than `ranked` rows is
    narrowed; then the values inside are ranked. No numbers give no rows.
    """
    wanted = sorted({min(1.0, max(0.0, s + side)) for s in shares for side in (-slack, slack)})
    guess = {r["share"]: r["value"] for r in estimated_percentiles(sketches, wanted).collect()}
    numbers, number = _numbers(df, value), _number(value)
    sides = [(guess.get(max(0.0, s - slack), 0.0), guess.get(min(1.0, s + slack), 0.0)) for s in shares]
    counts = [c for lo, hi in sides for c in (F.count_if(number < lo), F.count_if(number <= hi))]
    total, least, most, *found = numbers.agg(F.count("*"), F.min(number), F.max(number), *counts).first()
    brackets = []
    for share, (lo, hi), below, upto in zip(shares, sides, found[::2], found[1::2]):
        pos = float(share) * (total - 1)
        if not below <= math.floor(pos) or not upto > math.ceil(pos):
            lo, hi, below, upto = least, most, 0, total
        if upto - below > ranked:
            lo, hi = narrowed(numbers, number, lo, hi, pos, ranked)
        brackets.append((lo, hi))
    return ranked_between(numbers, number, shares, brackets, total)
