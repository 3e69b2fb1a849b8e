"""Corpus statistics. Every one reduces map-side before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.session import cut_lineage


def subject_grade_pivot(df: DataFrame, grades: Sequence[int] = (9, 10, 11, 12)) -> DataFrame:
    """Subject rows, one column per grade (absent cell 0) and the row total."""
    counts = df.groupBy("subject", "grade").count()
    cells = [
        F.coalesce(F.sum(F.when(F.col("grade") == g, F.col("count"))), F.lit(0)).cast("bigint").alias(f"grade_{g}")
        for g in grades
    ]
    return counts.groupBy("subject").agg(*cells, F.sum("count").cast("bigint").alias("total"))


def subject_grade_cube(df: DataFrame) -> DataFrame:
    """Counts with both margins; `all` marks a margin."""
    return (
        df.groupBy("subject", "grade")
        .count()
        .cube("subject", "grade")
        .agg(F.sum("count").cast("bigint").alias("n"), F.grouping_id().alias("gid"))
        .select(
            F.when(F.col("gid") >= 2, F.lit("all")).otherwise(F.col("subject")).alias("subject"),
            F.when(F.col("gid") % 2 == 1, F.lit("all")).otherwise(F.col("grade").cast("string")).alias("grade"),
            "n",
        )
    )


def cross_table_ranges(df: DataFrame, grades: Sequence[int] = (9, 10, 11, 12)) -> DataFrame:
    """Smallest and largest subject total, smallest and largest grade total, empty cells."""
    pivot = subject_grade_pivot(df, grades)
    names = [f"grade_{g}" for g in grades]
    empty = sum((F.when(F.col(n) == 0, 1).otherwise(0) for n in names), F.lit(0))
    return (
        pivot.agg(
            F.min("total").alias("subject_min"),
            F.max("total").alias("subject_max"),
            *[F.sum(n).cast("bigint").alias(n) for n in names],
            F.sum(empty).cast("bigint").alias("empty_cells"),
        )
        .withColumn("grade_min", F.least(*names))
        .withColumn("grade_max", F.greatest(*names))
        .drop(*names)
    )


def length_stats(df: DataFrame, text: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean, quartiles, min, max, sample deviation of text length.

    Lengths are merged to (length, rows) first, so the exact quantiles work on
    distinct lengths and a hot group costs no more than a cold one. The deviation sums
    distances to the mean, so long texts lose no digits.
    """
    counts = df.groupBy(*group, F.length(text).cast("double").alias("len")).agg(F.count("*").alias("n"))
    total, mass = F.sum("n"), F.sum(F.col("len") * F.col("n"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    counts = counts.withColumn("mean", F.sum(F.col("len") * F.col("n")).over(whole) / F.sum("n").over(whole))
    spread = F.sum(F.pow(F.col("len") - F.col("mean"), F.lit(2)) * F.col("n")) / (total - 1)

    def quantile(p):
        return F.percentile(F.col("len"), F.lit(p), F.col("n"))

    return counts.groupBy(*group).agg(
        total.cast("bigint").alias("n"),
        (mass / total).alias("mean"),
        quantile(0.25).alias("q1"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("q3"),
        F.min("len").cast("bigint").alias("min"),
        F.max("len").cast("bigint").alias("max"),
        F.when(total > 1, F.sqrt(spread)).alias("std"),
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows and exact distinct values per column, in long form, each column its own aggregate."""
    per_value = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]))
    ).groupBy("col.column", "col.v").agg(F.count("*").alias("n"))
    return per_value.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("n_rows"), F.count("v").alias("n_distinct")
    )


def histogram(df: DataFrame, value: str, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the last bin is closed."""
    v = F.col(value).cast("double")
    counts = cut_lineage(df.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count("*").alias("n")))
    lo = counts.agg(F.min("v")).scalar()
    hi = counts.agg(F.max("v")).scalar()
    span = F.col("hi") - F.col("lo")
    # all values equal: the range becomes [v - 0.5, v + 0.5]
    start = F.when(span == 0, F.col("lo") - 0.5).otherwise(F.col("lo"))
    width = F.when(span == 0, F.lit(1.0)).otherwise(span) / bins
    index = F.least(F.floor((F.col("v") - F.col("start")) / F.col("width")), F.lit(bins - 1)).cast("bigint")
    return (
        counts.withColumn("lo", lo)
        .withColumn("hi", hi)
        .withColumn("start", start)
        .withColumn("width", width)
        .groupBy(index.alias("bin"))
        .agg(F.sum("n").cast("bigint").alias("n"))
    )


def strata_sizes(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("size"))


def smallest_stratum(df: DataFrame, *columns: str) -> DataFrame:
    return strata_sizes(df, *columns).agg(F.min("size").alias("smallest"), F.count("*").alias("strata"))


def longest(df: DataFrame, length: str, tie: str, n: int = 3) -> DataFrame:
    return df.orderBy(F.col(length).desc(), tie).limit(n)


def shortest(df: DataFrame, length: str, tie: str, n: int = 3) -> DataFrame:
    return df.orderBy(length, tie).limit(n)
