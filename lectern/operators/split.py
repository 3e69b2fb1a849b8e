"""Seeded sampling, stratified split and leak checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import normalize_key, seeded_hash
from lectern.session import cut_lineage


#: Rows of one stratum that are ranked together, about; strata whose cuts are broadcast.
SLICE_ROWS = 10_000
BROADCAST_STRATA = 100_000


def seeded_sample(df: DataFrame, row_id: str, n: int, seed: int = C.SEED) -> DataFrame:
    """n rows in the order of a seeded hash: the same rows on any cluster."""
    return df.orderBy(seeded_hash(seed, row_id), row_id).limit(n)


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def _flag_lowest(df: DataFrame, row_id: str, quotas: DataFrame, seed: int, out: str) -> DataFrame:
    """Flag the `quota` rows with the lowest seeded hash in every `__stratum`.

    Hash-prefix counts tell in which slice of a stratum the quota ends; only that slice
    is ranked, and prefixes are long enough that it holds about `SLICE_ROWS` rows. The
    cuts, one row per stratum, are found once; while their counted number is within
    `BROADCAST_STRATA` they are broadcast, so the rows themselves are not shuffled.
    """
    facts = quotas.agg(F.max("n").alias("most"), F.count("*").alias("strata")).first()
    digits = max(1, math.ceil(math.log(max(1, facts["most"] or 0) / SLICE_ROWS, 16))) if (facts["most"] or 0) > SLICE_ROWS else 1
    hashed = df.withColumn("__h", seeded_hash(seed, row_id)).withColumn("__slice", F.substring("__h", 1, digits))
    sizes = hashed.groupBy("__stratum", "__slice").agg(F.count("*").alias("__n"))
    w = Window.partitionBy("__stratum").orderBy("__slice")
    ends = (
        sizes.withColumn("__upto", F.sum("__n").over(w))
        .join(quotas.drop("n"), "__stratum")
        .where((F.col("__upto") >= F.col("quota")) & (F.col("__upto") - F.col("__n") < F.col("quota")))
        .select("__stratum", "__slice", (F.col("quota") - F.col("__upto") + F.col("__n")).alias("__need"))
    )
    rank = F.row_number().over(Window.partitionBy("__stratum", "__slice").orderBy("__h", row_id))
    cuts = (
        hashed.select("__stratum", "__slice", "__h", row_id)
        .join(ends, ["__stratum", "__slice"])
        .withColumn("__rank", rank)
        .where(F.col("__rank") == F.col("__need"))
        .select("__stratum", F.struct(F.col("__h"), F.col(row_id).alias("__id")).alias("__cut"))
    )
    if facts["strata"] <= BROADCAST_STRATA:
        cuts = F.broadcast(df.sparkSession.createDataFrame(cuts.collect(), cuts.schema))
    here = F.struct(F.col("__h"), F.col(row_id).alias("__id"))
    return (
        hashed.join(cuts, "__stratum", "left")
        .withColumn(out, F.coalesce(here <= F.col("__cut"), F.lit(False)))
        .drop("__h", "__slice", "__cut")
    )


def _flag_lowest_overall(df: DataFrame, row_id: str, quota: int, seed: int, out: str) -> DataFrame:
    """The same without strata: 4096 slice counts and one cut row reach the driver, nothing is joined."""
    hashed = df.withColumn("__h", seeded_hash(seed, row_id))
    slice_ = F.substring("__h", 1, 3)
    before = 0
    for name, size in sorted(hashed.groupBy(slice_).agg(F.count("*")).collect()):
        if before + size >= quota > before:
            ends = hashed.where(slice_ == name).orderBy("__h", row_id).limit(quota - before)
            cut = ends.agg(F.max(F.struct(F.col("__h"), F.col(row_id).alias("id"))).alias("cut")).first()["cut"]
            later_id = (F.col("__h") == cut["__h"]) & (F.col(row_id) > cut["id"])
            return hashed.withColumn(out, (F.col("__h") <= cut["__h"]) & ~later_id).drop("__h")
        before += size
    return hashed.withColumn(out, F.lit(False)).drop("__h")


def split_level(df: DataFrame, eval_ratio: float = C.EVAL_RATIO) -> str:
    """Which strata the split can use: subject_grade, subject or none."""
    fine = df.groupBy("subject", "grade").agg(F.count("*").alias("n"))
    coarse = fine.groupBy("subject").agg(F.sum("n").alias("m"), F.min("n").alias("lo"), F.count("*").alias("k"))
    row = coarse.agg(
        F.sum("m").alias("rows"),
        F.min("lo").alias("fine_min"),
        F.sum("k").alias("fine"),
        F.min("m").alias("coarse_min"),
        F.count("*").alias("coarse"),
    ).first()
    if not row["rows"]:
        return "none"
    n_eval = -int(-(eval_ratio * row["rows"]) // 1)
    smaller = min(n_eval, row["rows"] - n_eval)
    if row["fine_min"] >= 2:
        return "subject_grade" if smaller >= row["fine"] else "none"
    return "subject" if row["coarse_min"] >= 2 and smaller >= row["coarse"] else "none"


def _stratum(level: str) -> Column:
    if level == "subject_grade":
        return F.concat_ws("_", "subject", F.col("grade").cast("string"))
    return F.col("subject")


def stratified_split(
    df: DataFrame, row_id: str, eval_ratio: float = C.EVAL_RATIO, seed: int = C.SEED, level: str | None = None
) -> DataFrame:
    """Add `split` (train/eval). Eval takes ceil(ratio * n) rows; train quotas by largest remainder."""
    level = level or split_level(df, eval_ratio)
    if level == "none":
        n = df.count()
        flagged = _flag_lowest_overall(df, row_id, n + int(-(eval_ratio * n) // 1), seed, "__train")
        return flagged.withColumn("split", F.when(F.col("__train"), F.lit("train")).otherwise(F.lit("eval"))).drop("__train")
    rows = df.withColumn("__stratum", _stratum(level))
    # one small row per stratum, counted once
    sizes = cut_lineage(rows.groupBy("__stratum").agg(F.count("*").alias("n")))
    total = sizes.agg(F.sum("n")).scalar()
    parts = (
        sizes.withColumn("total", total)
        .withColumn("train", F.col("total") - F.ceil(F.lit(eval_ratio) * F.col("total")))
        .withColumn("base", F.expr("(n * train) div total"))
        .withColumn("rest", F.expr("(n * train) % total"))
    )
    # one small row per stratum; the split is only stratified when eval has a row for each
    spare = F.col("train") - F.sum("base").over(Window.partitionBy("total"))
    turn = F.row_number().over(Window.partitionBy("total").orderBy(F.col("rest").desc(), "__stratum"))
    quotas = parts.select("__stratum", "n", (F.col("base") + F.when(turn <= spare, 1).otherwise(0)).alias("quota"))
    flagged = _flag_lowest(rows, row_id, quotas, seed, "__train")
    return flagged.withColumn("split", F.when(F.col("__train"), F.lit("train")).otherwise(F.lit("eval"))).drop(
        "__train", "__stratum"
    )


def _keys(df: DataFrame, text: str) -> DataFrame:
    return df.select(normalize_key(text).alias("key"))


def leaked(train: DataFrame, evaluation: DataFrame, text: str) -> DataFrame:
    """Train rows whose key also occurs in the evaluation rows.

    The right side is made distinct first, so a hot key is one row there and the
    left rows of that key can be split by adaptive skew handling.
    """
    other = _keys(evaluation, text).distinct()
    return train.withColumn("key", normalize_key(text)).join(other, "key", "left_semi")


def shared_keys(left: DataFrame, right: DataFrame, text: str) -> DataFrame:
    return _keys(left, text).intersect(_keys(right, text))


def duplicate_keys(left: DataFrame, right: DataFrame, text: str) -> DataFrame:
    """Rows of both sides together, distinct keys, and how many rows repeat a key."""
    per_key = _keys(left, text).unionByName(_keys(right, text)).groupBy("key").agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )
