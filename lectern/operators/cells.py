"""Exact top-k search that reads only the cells it must: balls around centroids, visited by their bound.

Points are dealt to the nearest of some centroids and stored by cell; a small table keeps each cell's centroid, its radius (the
largest angle of a point to it) and its size. No point of a cell has a cosine with q above cos(max(0, angle(q, c) - radius)). Every
query visits its cells by falling bound, a doubling number in each round, and rests once its k-th score is above the next
bound. The result is that of a full scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import constants as C
from lectern.operators.blocks import SCORE_DIGITS, LocalTopK, unit_rows, values
from lectern.operators.search import BROADCAST_BYTES, _arrow, _counted
from lectern.session import shared_path

#: Points of a cell on average, and points from which centroids are drawn: by the least hash of the id.
CELL_ROWS = 4096
SAMPLE = 20_000
#: Bytes of centroids at most; beyond, cells grow. Angles are kept wider by this than they were computed.
CENTROID_BYTES = 32 * 1024 * 1024
SLACK = 1e-7
CELLS = "cell int, centre array<double>, radius double, n long"


def _centres(points: DataFrame, count: int, vector: str, key: str) -> np.ndarray:
    """Centroids by a few rounds of spherical k-means on a bounded sample."""
    sample = points.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(SAMPLE).select(vector).toArrow()
    rows = unit_rows(sample.column(0))
    centre = rows[:count].copy()
    for _ in range(8):
        own = (rows @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, rows)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(length > 1e-12, total / np.maximum(length, 1e-12), centre)
    return centre


def write_cells(points: DataFrame, path: str | None = None, key: str = "point_id", vector: str = "vector", cell_rows: int = CELL_ROWS) -> str:
    """Store (key, vector) by cell, and the table of cells; returns the folder. Zero vectors are at no angle: their cell has radius pi."""
    spark = points.sparkSession
    path = path or shared_path(spark, "cells")
    rows = points.select(key, F.col(vector).cast("array<double>").alias(vector)).where(F.col(vector).isNotNull())
    n, dim = rows.agg(F.count("*"), F.max(F.size(vector))).first()
    most = max(1, CENTROID_BYTES // (8 * max(dim or 1, 1)))
    sent = spark.sparkContext.broadcast(_centres(rows, max(1, min(most, math.ceil(n / cell_rows), SAMPLE)), vector, key) if n else np.empty((0, 0)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = unit_rows(batch.column(1))
                near = v @ sent.value.T
                cell = near.argmax(axis=1)
                angle = np.where((v * v).sum(axis=1) > 0, np.arccos(np.clip(near[np.arange(len(v)), cell], -1, 1)) + SLACK, np.pi)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angle)], [*batch.schema.names, "cell", "angle"])

    kind = points.schema[key].dataType.simpleString()
    placed = rows.mapInArrow(dealt, f"`{key}` {kind}, `{vector}` array<double>, cell int, angle double")
    placed.repartition("cell").write.partitionBy("cell").parquet(f"{path}/points")
    sizes = _points(spark, path).groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")) if n else None
    listed = [(r["cell"], sent.value[r["cell"]].tolist(), r["radius"], r["n"]) for r in sizes.collect()] if n else []
    spark.createDataFrame(listed, CELLS).coalesce(1).write.parquet(f"{path}/cells")
    return path


def _points(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/points")


def top_k_in_cells(spark, path: str, queries: DataFrame, k: int = C.TOP_K, key: str = "point_id", query_id: str = "query_id", vector: str = "vector") -> tuple[DataFrame, dict]:
    """((query_id, key, score, rank) as `search.top_k` returns them, {rounds, cells, points read and point comparisons, of how many})."""
    asked = queries.select(query_id, vector).where(F.col(vector).isNotNull())
    _, _, size = _counted(asked)
    if size > BROADCAST_BYTES:
        raise ValueError("search larger sets of queries in parts: their vectors are broadcast")
    table = asked.toArrow()
    ids, matrix = values(table.column(0)), unit_rows(table.column(1))
    cells = spark.read.schema(CELLS).parquet(f"{path}/cells").toArrow().sort_by("cell")
    names, radius, sizes = (cells.column(c).to_numpy() for c in ("cell", "radius", "n"))
    work = {"rounds": 0, "cells": len(names), "read": 0, "points": int(sizes.sum()), "compared": 0, "pairs": int(sizes.sum()) * len(ids)}
    query_type = queries.schema[query_id].dataType
    if not len(names) or not len(ids):
        kind = next(iter(spark.read.parquet(f"{path}/points").schema)).dataType if len(names) else T.LongType()
        return spark.createDataFrame([], T.StructType([T.StructField(query_id, query_type), T.StructField(key, kind), T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])), work
    angle = np.arccos(np.clip(matrix @ unit_rows(cells.column("centre")).T, -1, 1))
    bound = np.cos(np.maximum(0.0, angle - radius - SLACK)) + 10.0**-SCORE_DIGITS
    order = np.argsort(-bound, axis=1, kind="stable")
    points = _points(spark, path)
    key_type = points.schema[key].dataType
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField(key, key_type), T.StructField("score", T.DoubleType())])
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), key))
    found, floor = None, np.full(len(ids), -np.inf)
    seen, step, open_ = 0, 1, np.arange(len(ids))
    while len(open_) and seen < len(names):
        visits = order[open_, seen : seen + step]
        useful = bound[open_[:, None], visits] >= floor[open_][:, None]
        wanted: dict[int, list[int]] = {}
        for row, col in zip(*np.nonzero(useful)):
            wanted.setdefault(int(names[visits[row, col]]), []).append(int(open_[row]))
        work["rounds"] += 1
        count = dict(zip(names.tolist(), sizes.tolist()))
        work["read"] += sum(count[c] for c in wanted)
        work["compared"] += sum(count[c] * len(q) for c, q in wanted.items())
        sent = spark.sparkContext.broadcast((matrix, {c: np.array(q) for c, q in wanted.items()}))

        def visit(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            vectors, readers = sent.value
            hits: dict[int, LocalTopK] = {}
            for batch in batches:
                cell = batch.column(2).to_numpy()
                for c in np.unique(cell).tolist():
                    part = batch.take(pa.array(np.flatnonzero(cell == c)))
                    local = hits.setdefault(c, LocalTopK(vectors[readers[c]], None, k))
                    local.add(values(part.column(0)), unit_rows(part.column(1)), None)
            for c, local in hits.items():
                at, found_ids, scores = local.result()
                yield pa.RecordBatch.from_arrays([pa.array(readers[c][at].astype(np.int32)), _arrow(found_ids, key_type), pa.array(scores)], names=schema.names)

        # only the folders of the wanted cells are read
        scan = points.where(F.col("cell").isin(list(wanted))).select(key, vector, "cell")
        hits = scan.mapInArrow(visit, schema)
        both = hits if found is None else found.unionByName(hits)
        top = both.withColumn("rank", best).where(F.col("rank") <= k).drop("rank").toArrow()
        # at most k rows per query come back
        found = spark.createDataFrame(top, schema)
        score, at = top.column("score").to_numpy(), top.column("q").to_numpy()
        full = np.bincount(at, minlength=len(ids)) >= k
        least = np.full(len(ids), np.inf)
        np.minimum.at(least, at, score)
        floor = np.where(full, least, -np.inf)
        seen += step
        step *= 2
        if seen < len(names):
            nxt = bound[open_, order[open_, seen]]
            open_ = open_[nxt >= floor[open_]]
    names_of = spark.createDataFrame(pa.table({"q": pa.array(np.arange(len(ids)), pa.int32()), query_id: table.column(0)}))
    ranked = found.withColumn("rank", best).join(F.broadcast(names_of), "q")
    return ranked.select(F.col(query_id).cast(query_type).alias(query_id), key, "score", "rank"), work
