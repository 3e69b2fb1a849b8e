"""Filtered cosine top-k for a batch of queries, and what is built from the hits."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import constants as C
from lectern.operators.blocks import LocalTopK, unit_rows, values
from lectern.session import cut_lineage

BROADCAST_BYTES = 32 * 1024 * 1024
BLOCK_BYTES = 16 * 1024 * 1024
#: Hits that are broadcast to the payload, at most (query id, point id, score and rank of each).
BROADCAST_HITS = 200_000


def by_subject(points: DataFrame, subject: str | None) -> DataFrame:
    """Equality filter before the search; None, empty or blank text means no filter."""
    wanted = (subject or "").strip()
    return points.where(F.col("subject") == wanted) if wanted else points


def _arrow(values_: Sequence, kind: T.DataType) -> pa.Array:
    return pa.array(values_, pa.int32() if kind == T.IntegerType() else pa.int64() if kind == T.LongType() else pa.string())


def _counted(side: DataFrame) -> tuple[int, int, int]:
    """(rows, vector size, bytes of ids, vectors and subjects once they are arrays of fixed width)."""
    key, vector, *subject = side.columns
    texts = [F.max(F.length(F.col(c).cast("string"))) for c in (key, *subject)]
    n, dim, *widths = side.agg(F.count("*"), F.max(F.size(vector)), *texts).first()
    return n, dim or 0, n * (8 * (dim or 0) + sum(8 + 4 * (w or 0) for w in widths))


def top_k(
    points: DataFrame,
    queries: DataFrame,
    k: int = C.TOP_K,
    point_id: str = "point_id",
    query_id: str = "query_id",
    vector: str = "vector",
    subject: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact best k points per query: (query_id, point_id, score, rank), ties by point id.

    One pass over the points: every task multiplies its batches with the query matrix
    and sends on at most k rows per query. The matrix is broadcast only while its
    counted size is within `broadcast_bytes`; beyond that a small corpus is broadcast
    to the queries instead, and with both sides large they are cut into blocks of
    `block_bytes` that meet in pairs, again sending on k rows per query.
    With `subject` (a column of both sides) a non-empty query subject must match.
    """
    id_type, query_type = points.schema[point_id].dataType, queries.schema[query_id].dataType
    schema = T.StructType(
        [T.StructField(query_id, query_type), T.StructField(point_id, id_type), T.StructField("score", T.DoubleType())]
    )
    if subject:
        left = points.select(point_id, vector, F.coalesce(F.col(subject), F.lit("")).alias("subject"))
        right = queries.select(query_id, vector, F.coalesce(F.trim(F.col(subject)), F.lit("")).alias("subject"))
    else:
        left, right = points.select(point_id, vector), queries.select(query_id, vector)
    left, right = left.where(F.col(vector).isNotNull()), right.where(F.col(vector).isNotNull())
    n, dim, size = _counted(right)
    if size <= broadcast_bytes:
        hits = _scan_points(left, right, k, schema)
    else:
        n_points, _, size = _counted(left)
        if size <= broadcast_bytes:
            hits = _scan_queries(left, right, k, schema)
        else:
            hits = _scan_in_blocks(left, right, k, schema, point_id, query_id, n_points, n, dim, block_bytes)
    best = F.row_number().over(Window.partitionBy(query_id).orderBy(F.col("score").desc(), point_id))
    return hits.withColumn("rank", best).where(F.col("rank") <= k)


def _batch(schema: T.StructType, query_ids: np.ndarray, local: LocalTopK) -> pa.RecordBatch:
    at, ids, scores = local.result()
    columns = [_arrow(query_ids[at].tolist(), schema[0].dataType), _arrow(ids, schema[1].dataType), pa.array(scores)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _collected(df: DataFrame):
    """Broadcast (ids, unit rows, subjects or None) of a side whose size has been checked."""
    table = df.toArrow()
    subjects = values(table.column(2)) if table.num_columns > 2 else None
    return df.sparkSession.sparkContext.broadcast((values(table.column(0)), unit_rows(table.column(1)), subjects))


def _scan_points(points: DataFrame, queries: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    sent = _collected(queries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, wanted = sent.value
        local = LocalTopK(matrix, wanted, k)
        for batch in batches:
            own = values(batch.column(2)) if wanted is not None else None
            local.add(values(batch.column(0)), unit_rows(batch.column(1)), own)
        if len(query_ids):
            yield _batch(schema, query_ids, local)

    return points.mapInArrow(scan, schema)


def _scan_queries(points: DataFrame, queries: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    sent = _collected(points)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        point_ids, matrix, own = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            local = LocalTopK(unit_rows(batch.column(1)), values(batch.column(2)) if own is not None else None, k)
            local.add(point_ids, matrix, own)
            yield _batch(schema, values(batch.column(0)), local)

    return queries.mapInArrow(scan, schema)


def _scan_in_blocks(
    points: DataFrame, queries: DataFrame, k: int, schema: T.StructType,
    point_id: str, query_id: str, n_points: int, n: int, dim: int, block_bytes: int,
) -> DataFrame:
    rows = max(1, block_bytes // (8 * max(dim, 1)))
    point_blocks = max(1, math.ceil(n_points / rows))
    query_blocks = max(1, math.ceil(n / rows))

    def spread(df: DataFrame, own: str, own_id: str, blocks: int, other: str, other_blocks: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64(own_id), F.lit(blocks)).cast("int")).withColumn(other, every)

    left = spread(points, "__p", point_id, point_blocks, "__q", query_blocks)
    right = spread(queries, "__q", query_id, query_blocks, "__p", point_blocks)

    def meet(p: pa.Table, q: pa.Table) -> pa.Table:
        local = None
        query_ids = values(q.column(0))
        if q.num_rows and p.num_rows:
            filtered = "subject" in p.column_names
            local = LocalTopK(unit_rows(q.column(1)), values(q.column("subject")) if filtered else None, k)
            local.add(values(p.column(0)), unit_rows(p.column(1)), values(p.column("subject")) if filtered else None)
        if local is None:
            local = LocalTopK(np.empty((0, 0)), None, k)
        return pa.Table.from_batches([_batch(schema, query_ids, local)])

    return left.groupBy("__p", "__q").cogroup(right.groupBy("__p", "__q")).applyInArrow(meet, schema)


# --- what is built from hits ---------------------------------------------------


def hit_documents(hits: DataFrame, points: DataFrame, key: str = "point_id", query_id: str = "query_id") -> DataFrame:
    """Hits with their payload; empty texts go after the limit, so fewer than k may stay.

    The hits (k rows a query) are fetched once; while their counted number is within
    `BROADCAST_HITS` they go to the payload, whose texts are then not shuffled.
    """
    payload = points.select(
        key, "text", "source", F.col("page_num").alias("page"), "subject", "chunk_index", "doc_id"
    )
    hits = cut_lineage(hits.select(query_id, key, "score", "rank"))
    small = hits.count() <= BROADCAST_HITS
    return payload.join(F.broadcast(hits) if small else hits, key).where(F.coalesce(F.col("text"), F.lit("")) != "")


def context_strings(documents: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Numbered, sourced context per query: at most k rows meet in a group."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "source", "page", "text")))
    blocks = F.transform(
        ordered,
        lambda d, i: F.concat(
            F.lit("["), (i + 1).cast("string"), F.lit("] (kaynak: "), F.coalesce(d["source"], F.lit("None")),
            F.lit(", sayfa: "), F.coalesce(d["page"].cast("string"), F.lit("None")), F.lit(")\n"), d["text"],
        ),
    )
    return documents.groupBy(query_id).agg(F.array_join(blocks, "\n\n").alias("context"))


def no_result_message(query: Column, subject: Column) -> Column:
    subject = F.trim(F.coalesce(subject, F.lit("")))
    scope = F.when(subject != "", F.concat(subject, F.lit(C.SCOPE_WORDS))).otherwise(F.lit(""))
    return F.concat(F.lit("'"), query, F.lit("' sorgusu için "), scope, F.lit(C.NOTHING_FOUND))


def search_answers(queries: DataFrame, contexts: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Context per query, or the message that nothing was found. Needs columns text, subject."""
    joined = queries.join(contexts, query_id, "left")
    return joined.withColumn("result", F.coalesce("context", no_result_message(F.col("text"), F.col("subject"))))


def confidence(queries: DataFrame, documents: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Score of the best hit per query, 0 without hits."""
    best = documents.groupBy(query_id).agg(F.max("score").alias("__best"))
    return queries.join(best, query_id, "left").withColumn("confidence", F.coalesce("__best", F.lit(0.0))).drop("__best")


def merged_search(corpora: dict[str, DataFrame], k: int = C.TOP_K, query_id: str = "query_id", key: str = "point_id") -> DataFrame:
    """Hits of several corpora on one scale (min-max per query and corpus), best k of all."""
    parts = [hits.select(F.lit(name).alias("corpus"), query_id, key, "score") for name, hits in corpora.items()]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    # at most k hits per query and corpus reach this window
    w = Window.partitionBy("corpus", query_id)
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    scaled = both.withColumn("scaled", F.when(hi == lo, F.lit(1.0)).otherwise((F.col("score") - lo) / (hi - lo)))
    order = Window.partitionBy(query_id).orderBy(F.round("scaled", 9).desc(), "corpus", key)
    return scaled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
