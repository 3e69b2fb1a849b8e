"""Connected components of a link table, in rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.tables import saved


def _star(links: DataFrame, smaller: bool) -> DataFrame:
    """Every vertex u hangs its larger (or, for smaller, its not larger) neighbours on the least vertex it sees.

    The least neighbour is an aggregate that combines before the shuffle; the join that follows has one row per vertex on
    its right side, so a vertex with very many links can be split.
    """
    if smaller:
        sides = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        sides = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a")))
    least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = sides.join(least, "u")
    out = moved.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")) if smaller else moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return (out.union(least.filter("u != m").select("u", "m")) if smaller else out).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each linked id reaches; links: (a, b) of whole numbers."""
    now = saved(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if seen[0] == 0 or tuple(seen[:2]) == mark:
            break
        mark = tuple(seen[:2])
        now = saved(_star(_star(now, False), True), "links")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
