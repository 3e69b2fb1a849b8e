"""Exact nearest neighbours of 64-bit codes in Hamming distance: multi-index hashing with growing segment radii.

Method: codes are cut into m segments, about as long as the logarithm of their number, and indexed by each. In round r
every open query looks up the keys that differ from its own segment in exactly r bits, in all segments; what it meets is
verified with the whole code. After round r all codes within m (r + 1) - 1 bits have been met, since more differences would
put more than r of them into some segment. A query closes when its kth verified distance is within that bound, so no
neighbour and no tie is missed. All look-ups are equality joins; equal codes are one row with their smallest ids, so
copies cost nothing.

Odd input: vectors that are null, zero or hold null or non-finite components take no part, as queries or candidates; if there are
fewer candidates than k, all are returned; rows that share an id are one row if their codes are equal, else candidates each; an
empty table gives no rows; further columns are not read. Sign codes need vectors of at most 64 components.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.tables import read_table, saved
from lectern.llm.vectors import least_ids, usable

K = 10
QUERY_STEP = 50
#: Bits of a segment: longer ones would have too many keys within a few bits.
LEAST_BITS, MOST_BITS = 8, 16


def sign_code(vector) -> F.Column:
    """Bit i is set if component i is positive."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def sign_codes(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, code) of the usable vectors."""
    taken = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    size = F.when(F.size("v") <= 64, F.col("v")).otherwise(F.raise_error(F.lit("sign codes need at most 64 components")))
    return taken.select("id", sign_code(size).alias("code"))


def segments(count: int) -> list[tuple[int, int]]:
    """(first bit, length) of each segment."""
    bits = min(MOST_BITS, max(LEAST_BITS, round(math.log2(max(2, count)))))
    m = math.ceil(64 / bits)
    ends = [64 * j // m for j in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(ends, ends[1:])]


def _keys(code, cuts: list[tuple[int, int]]) -> F.Column:
    """One struct (segment, length, key) per segment."""
    parts = [F.struct(F.lit(j).alias("seg"), F.lit(n).alias("len"), F.shiftrightunsigned(code, lo).bitwiseAND((1 << n) - 1).alias("key")) for j, (lo, n) in enumerate(cuts)]
    return F.explode(F.array(*parts))


def _masks(spark: SparkSession, cuts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(length, masks with `radius` bits): one row per different segment length."""
    rows = [(n, [sum(1 << b for b in c) for c in combinations(range(n), radius)]) for n in sorted({n for _, n in cuts})]
    return spark.createDataFrame(rows, "len int, masks array<long>")


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, distance): the k nearest other ids of every query, ties to the smaller id.

    codes, queries: (id, code); a query leaves out the rows that have its own id.
    """
    spark = codes.sparkSession
    table = saved(least_ids(codes.dropDuplicates(["id", "code"]), "code", k + 1), "codes")
    count, entries = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    cuts = segments(count)
    need = min(k + 1, entries)
    index = saved(table.select("code", "id", F.size("ids").alias("n"), _keys(F.col("code"), cuts).alias("s")).select("s.seg", "s.key", "code", "id", "n"), "segments")
    asked = saved(queries.dropDuplicates(["id", "code"]).select(F.col("id").alias("query_id"), F.col("code").alias("q")), "queries")
    open_ = asked.select("q").distinct().withColumn("far", F.lit(64))
    best = None
    for radius in range(max(n for _, n in cuts) + 1):
        probes = open_.select("q", "far", _keys(F.col("q"), cuts).alias("s")).select("q", "far", "s.*")
        probes = probes.join(F.broadcast(_masks(spark, cuts, radius)), "len").select("q", "far", "seg", "key", F.explode("masks").alias("mask"))
        probes = probes.select("q", "far", "seg", F.col("key").bitwiseXOR(F.col("mask")).alias("key"))
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int")
        met = probes.join(index, ["seg", "key"]).withColumn("d", distance).filter("d <= far").select("q", "d", "id", "n", "code").distinct()
        every = met if best is None else best.union(met).distinct()
        order = Window.partitionBy("q").orderBy("d", "id")
        ranked = every.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= k + 1)
        best = saved(ranked.drop("__n"), "best")
        # the distance at which a query has all the entries it needs
        running = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        kth = best.withColumn("have", running).filter(F.col("have") >= need).groupBy("q").agg(F.min("d").alias("far"))
        bound = len(cuts) * (radius + 1) - 1
        open_ = saved(asked.select("q").distinct().join(kth, "q", "left").select("q", F.coalesce("far", F.lit(64)).alias("far")).filter(F.col("far") > bound), "open")
        if open_.isEmpty():
            break
    if best is None:
        best = spark.createDataFrame([], "q long, d int, id long, n int, code long")
    near = best.join(table.select("code", "ids"), "code").select("q", "d", F.explode("ids").alias("vec_id"))
    near = near.withColumn("__n", F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))).filter(F.col("__n") <= k + 1)
    found = asked.join(near, "q").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("d", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("distance"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = sign_codes(read_table(spark, sf_dir, "embeddings"))
    return nearest_codes(codes, codes.filter(F.col("id") % QUERY_STEP == 0))


SQL = f"""
WITH taken AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.bits) + 1), lambda i: CASE WHEN q.bits[i] <> c.bits[i] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
  FROM taken q JOIN taken c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_STEP} = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance FROM pairs)
SELECT * FROM ranked WHERE rank <= {K}
"""
