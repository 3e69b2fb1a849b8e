"""Approximate nearest neighbours by balanced posting lists.

Method: centroids are fitted on a bounded sample by k-means with a penalty on full clusters, about one per `LIST` vectors.
A vector near a boundary is written to several lists: to every centroid not much farther than its nearest (`CLOSURE`), unless an
already chosen centroid is nearer to that centroid than the vector is. Centroids are searched by an in-memory graph of their
nearest neighbours, best first. A query reads the lists whose centroid is at most `PRUNE` times as far as its nearest
one. Inside the lists every vector is compared; the scores are exact cosines in double precision.

Only centroids and their graph travel to every task; their number and the sample are bounded. Short lists are read
together and long ones in parts, at most about `BLOCK` vectors at once, and the queries of a bundle likewise, so a hot list is
many bounded groups; a query meets only the lists it reads, and each group sends on its best k + 1. Equal vectors are one
row with their smallest ids.

Odd input: vectors that are null, zero or hold null or non-finite components take no part; all others must have the same number
of components; with fewer candidates than k all are returned; rows with one id and equal vectors are one row; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.tables import read_table, saved
from lectern.llm.vectors import least_ids, usable

K = 5
QUERY_STEP = 50
#: Vectors the centroids are fitted on, and centroids, at most.
SAMPLE, CENTROIDS = 20_000, 1024
LIST = 256
COPIES, CLOSURE = 4, 1.10
PRUNE = 1.25
NEIGHBOURS, BEAM = 16, 32
BLOCK = 2048
#: Candidates a block gives beyond k, so that rounding in the matrix product can lose none.
SPARE = 4
BATCH = 1000


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    # the largest component first, so that no square overflows or vanishes
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def balanced_centroids(points: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit points; a cluster above its share becomes less attractive."""
    rng = np.random.default_rng(7)
    centre = points[np.sort(rng.choice(len(points), count, replace=False))]
    weight = np.zeros(count)
    for _ in range(rounds):
        own = (points @ centre.T - weight).argmax(axis=1)
        size = np.bincount(own, minlength=count)
        total = np.zeros_like(centre)
        np.add.at(total, own, points)
        length = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(length > 1e-12, total / np.maximum(length, 1e-12), centre)
        weight += 0.02 * (size / (len(points) / count) - 1)
    return centre


class CentroidGraph:
    """Centroids linked to their nearest ones, searched best first for many vectors at once."""

    def __init__(self, centre: np.ndarray, links: np.ndarray | None = None, neighbours: int = NEIGHBOURS):
        self.centre, self.links = centre, links
        n = len(centre)
        self.entry = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))
        if links is None:
            self._link(n, neighbours)

    def parts(self) -> tuple:
        """What a broadcast carries: arrays only, so that executors need no copy of this package to read it."""
        return self.centre, self.links

    def _link(self, n: int, neighbours: int) -> None:
        near = self.centre @ self.centre.T
        np.fill_diagonal(near, -np.inf)
        links = np.argsort(-near, axis=1, kind="stable")[:, : max(1, min(neighbours, n - 1))]
        # a ring beside the nearest ones keeps every centroid within reach
        self.links = np.concatenate([links, ((np.arange(n) + 1) % n)[:, None]], axis=1)

    def search(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the `beam` nearest found per vector, nearest first."""
        n, m = len(self.centre), len(vectors)
        beam = min(beam, n)
        rows = np.arange(m)
        dist = np.full((m, n), np.inf)
        spread = np.zeros((m, n), dtype=bool)
        dist[:, self.entry] = self._far(vectors, np.broadcast_to(self.entry, (m, len(self.entry))))
        live = rows
        while len(live):
            limit = np.partition(dist[live], beam - 1, axis=1)[:, beam - 1]
            waiting = np.where(spread[live], np.inf, dist[live])
            next_ = waiting.argmin(axis=1)
            best = waiting[np.arange(len(live)), next_]
            go = (best <= limit) & np.isfinite(best)
            live, next_ = live[go], next_[go]
            spread[live, next_] = True
            reached = self.links[next_]
            dist[live[:, None], reached] = self._far(vectors[live], reached)
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        return order, np.take_along_axis(dist, order, axis=1)

    def _far(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ikj->ik", vectors, self.centre[which]), 0))

    def within(self, vectors: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, centroid, distance) of all centroids found within ratio times the nearest; the beam grows until it holds them."""
        beam, n = BEAM, len(self.centre)
        which, dist = self.search(vectors, beam)
        open_ = np.flatnonzero(dist[:, -1] <= ratio * dist[:, 0]) if beam < n else np.empty(0, np.int64)
        parts = []
        done = np.ones(len(vectors), dtype=bool)
        done[open_] = False
        parts.append((np.flatnonzero(done), which[done], dist[done]))
        while len(open_):
            beam = min(n, beam * 2)
            which, dist = self.search(vectors[open_], beam)
            full = (dist[:, -1] <= ratio * dist[:, 0]) & (beam < n)
            parts.append((open_[~full], which[~full], dist[~full]))
            open_ = open_[full]
        out = []
        for rows, which, dist in parts:
            take = dist <= ratio * dist[:, :1] + 1e-12
            at, place = np.nonzero(take & np.isfinite(dist))
            out.append((rows[at], which[at, place], dist[at, place]))
        return tuple(np.concatenate(x) for x in zip(*out))


def chosen_lists(graph: CentroidGraph, vectors: np.ndarray, ratio: float, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, list): the nearest, and further ones within the ratio that no chosen list already covers."""
    row, which, dist = graph.within(vectors, ratio)
    order = np.lexsort((which, dist, row))
    row, which, dist = row[order], which[order], dist[order]
    taken: list[list[int]] = [[] for _ in range(len(vectors))]
    between = np.sqrt(np.maximum(2 - 2 * graph.centre @ graph.centre.T, 0))
    for r, c, d in zip(row.tolist(), which.tolist(), dist.tolist()):
        own = taken[r]
        if len(own) < copies and all(between[c, o] >= d for o in own):
            own.append(c)
    return np.repeat(np.arange(len(vectors)), [len(t) for t in taken]), np.array([c for t in taken for c in t], dtype=np.int64)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and len(flat) % len(column):
        raise ValueError("vectors must all have the same number of components")
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.empty((0, 0))


def _lists(graph, ratio: float, copies: int | None):
    """Lists of every vector: to be written to (with the vector) if `copies` is given, else to be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidGraph(*graph.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                vectors = unit(matrix(batch.column("v")))
                if copies is None:
                    row, which, _ = lists.within(vectors, ratio)
                else:
                    row, which = chosen_lists(lists, vectors, ratio, copies)
                names = ["id"] if copies is None else ["id", "v"]
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), *[batch.column(n).take(pick) for n in names]], ["list", *names])

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision: the same for a pair wherever it is computed."""
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _compared(k: int):
    """Best k + 1 vectors of one bundle for every query, among the lists that the query reads."""

    def run(asked: pa.Table, listed: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if asked.num_rows and listed.num_rows:
            q, q_id = matrix(asked.column("v")), asked.column("id").to_numpy()
            v_id, first, place = np.unique(listed.column("id").to_numpy(), return_index=True, return_inverse=True)
            v = matrix(listed.column("v").combine_chunks().take(pa.array(first)))
            names, at = np.unique(listed.column("list").to_numpy(), return_inverse=True)
            holds = np.zeros((len(names), len(v)), dtype=np.float32)
            holds[at.reshape(-1), place.reshape(-1)] = 1
            lists = asked.column("lists").combine_chunks()
            row = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            name = np.searchsorted(names, lists.flatten().to_numpy())
            name[name == len(names)] = 0
            here = names[name] == lists.flatten().to_numpy()
            reads = np.zeros((len(q), len(names)), dtype=np.float32)
            reads[row[here], name[here]] = 1
            to, points = min(k + 1 + SPARE, len(v)), unit(v).T
            for at in range(0, len(q), 512):
                part = slice(at, at + 512)
                near = np.where(reads[part] @ holds > 0, unit(q[part]) @ points, -np.inf)
                # ties with the last one must not be cut by chance
                edge = np.partition(near, len(v) - to, axis=1)[:, len(v) - to]
                row, col = np.nonzero((near >= edge[:, None] - 1e-12) & np.isfinite(near))
                score = cosines(q[at + row], v[col])
                order = np.lexsort((v_id[col], -score, row))
                row, col, score = row[order], col[order], score[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) <= k
                found.append((q_id[at + row[best]], v_id[col[best]], score[best]))
        q_ids, ids, scores = (np.concatenate(x) for x in zip(*found))
        return pa.table({"q": pa.array(q_ids), "id": pa.array(ids), "score": pa.array(scores)})

    return run


def _bundles(listed: DataFrame) -> DataFrame:
    """(list, bundle, parts): short lists are read together, long ones in parts; one row per list, so at most `CENTROIDS`."""
    sizes = listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("list").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("bundle", F.floor(before / BLOCK).cast("int"))
    parts = (F.floor(F.sum("n").over(Window.partitionBy("bundle")) / BLOCK) + 1).cast("int")
    return saved(sizes.withColumn("parts", parts).select("list", "bundle", "parts"), "bundles")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, prune: float = PRUNE, closure: float = CLOSURE, copies: int = COPIES, list_size: int = LIST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query, itself left out; both tables: (id, v)."""
    spark = vectors.sparkSession
    taken = vectors.filter(F.col("id").isNotNull() & usable(F.col("v")))
    table = saved(least_ids(taken.dropDuplicates(["id", "v"]), "v", k + 1), "vectors")
    asked = saved(queries.filter(F.col("id").isNotNull() & usable(F.col("v"))).dropDuplicates(["id", "v"]).select(F.col("id").alias("query_id"), "v"), "queries")
    count = table.count()
    sample = matrix(table.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v"))
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = CentroidGraph(balanced_centroids(unit(sample), max(1, min(CENTROIDS, count // list_size, len(sample)))))
    sent = spark.sparkContext.broadcast(graph.parts())
    kind = dict(table.dtypes)["v"]
    listed = saved(table.select("id", "v").mapInArrow(_lists(sent, closure, copies), f"list int, id long, v {kind}"), "lists")
    # equal query vectors are searched once, under the id that stands for the vector in the table
    wanted = asked.select("v").distinct().join(table.select("v", "id"), "v", "left")
    wanted = wanted.select(F.coalesce("id", -F.abs(F.xxhash64("v")) - 1).alias("id"), "v")
    wanted = saved(wanted, "wanted")
    bundles = F.broadcast(_bundles(listed))
    probes = wanted.mapInArrow(_lists(sent, prune, None), "list int, id long").join(bundles, "list")
    probes = saved(probes.groupBy("bundle", "parts", "id").agg(F.collect_set("list").alias("lists")), "probes")
    asks = probes.groupBy("bundle").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).cast("int").alias("asks"))
    asks = F.broadcast(saved(asks, "asks"))
    left = probes.join(asks, "bundle").join(wanted, "id").withColumn("ask", F.pmod(F.xxhash64("id"), F.col("asks")).cast("int"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = listed.join(bundles, "list").join(asks, "bundle").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    right = right.withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
    keys = ["bundle", "part", "ask"]
    groups = left.select(*keys, "id", "v", "lists").groupBy(*keys).cogroup(right.select(*keys, "id", "v", "list").groupBy(*keys))
    met = groups.applyInArrow(_compared(k), "q long, id long, score double")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    met = met.distinct().withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= k + 1)
    near = met.select("q", "id", "score").join(table.select("id", "ids"), "id").select("q", "score", F.explode("ids").alias("vec_id"))
    near = near.withColumn("__n", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id"))).filter(F.col("__n") <= k + 1)
    found = asked.join(wanted, "v").select("query_id", F.col("id").alias("q")).join(near, "q").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return nearest(vectors, vectors.filter(F.col("id") % QUERY_STEP == 0))
