"""Vectors of a table: which take part, and equal ones as one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vector) -> F.Column:
    """Not null, without null or non-finite components, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def least_ids(rows: DataFrame, value: str, keep: int) -> DataFrame:
    """(value, id: the smallest, ids: the `keep` smallest, ascending); rows: (id, value).

    The limit on the row number applies before the shuffle, so a value that a third of the rows share stays cheap.
    """
    order = Window.partitionBy(value).orderBy("id")
    first = rows.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= keep)
    return first.groupBy(value).agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"))
