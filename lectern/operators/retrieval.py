"""Retrieval quality from ranked hits and gold ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.vectors import cosine
from lectern.operators.blocks import SCORE_DIGITS, LocalTopK, unit_rows, values
from lectern.operators.search import BROADCAST_BYTES, _arrow, _counted, top_k


def gold_ranks(hits: DataFrame, gold: DataFrame, query_id: str = "query_id", point_id: str = "point_id") -> DataFrame:
    """Per gold row (query_id, gold_id): rank of the gold hit, null when it was not found."""
    found = hits.select(query_id, F.col(point_id).alias("gold_id"), F.col("rank").alias("gold_rank"))
    return gold.join(found, [query_id, "gold_id"], "left")


def recall_at(ranks: DataFrame, ks: Sequence[int] = (1, 3), by: Sequence[str] = ()) -> DataFrame:
    """(k, recall, n) rows; k = 1 is top-1 accuracy."""
    hits = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.coalesce(F.col("gold_rank") <= k, F.lit(False)).cast("double").alias("hit"))
            for k in ks
        ]
    )
    long = ranks.select(*by, F.explode(hits).alias("e")).select(*by, "e.*")
    return long.groupBy(*by, "k").agg(F.avg("hit").alias("recall"), F.count("*").alias("n"))


def score_margins(
    hits: DataFrame, gold: DataFrame, queries: DataFrame, points: DataFrame,
    query_id: str = "query_id", point_id: str = "point_id", vector: str = "vector",
) -> DataFrame:
    """Per query: top-1 id and score, the gold paragraph's own score, margin, hit flag.

    Every query with a gold id has a row. A gold id that the corpus lacks leaves its score
    and the margin null; such a query, and one without hits, counts as wrong.
    """
    own = (
        gold.join(queries.select(query_id, F.col(vector).alias("__q")), query_id)
        .join(points.select(F.col(point_id).alias("gold_id"), F.col(vector).alias("__p")), "gold_id")
        .select(query_id, "gold_id", F.round(cosine("__q", "__p"), SCORE_DIGITS).alias("gold_score"))
    )
    first = hits.where(F.col("rank") == 1).select(
        query_id, F.col(point_id).alias("top1"), F.col("score").alias("top1_score")
    )
    return (
        gold.select(query_id, "gold_id")
        .join(first, query_id, "left")
        .join(own, [query_id, "gold_id"], "left")
        .withColumn("ok", F.coalesce(F.col("top1") == F.col("gold_id"), F.lit(False)))
        .withColumn("margin", F.col("top1_score") - F.col("gold_score"))
    )


def margin_summary(margins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    wrong = F.when(~F.col("ok"), F.col("margin"))
    return margins.groupBy(*by).agg(
        F.avg("top1_score").alias("top1_mean"),
        F.min("top1_score").alias("top1_min"),
        F.count_if(~F.col("ok")).alias("wrong"),
        F.avg(wrong).alias("wrong_margin_mean"),
    )


def choose_model(results: DataFrame) -> DataFrame:
    """Best model: top-1, then top-3, then smaller vectors, then faster; dimension 0 means it failed."""
    order = [F.col("top1_acc").desc(), F.col("top3_recall").desc(), "vector_dim", "encode_latency_sec", "model_id"]
    return results.where(F.col("vector_dim") > 0).orderBy(*order).limit(1)


RESULT = "model_id string, vector_dim int, top1_acc double, top3_recall double, encode_latency_sec double, error string"


def _shapes(points: DataFrame, queries: DataFrame) -> list:
    """One row per model: the vector sizes of both sides."""
    sides = points.select("model_id", F.size("vector").alias("p"), F.lit(None).cast("int").alias("q")).unionByName(
        queries.select("model_id", F.lit(None).cast("int").alias("p"), F.size("vector").alias("q"))
    )
    return sides.groupBy("model_id").agg(F.min("p"), F.max("p"), F.min("q"), F.max("q")).collect()


def top_k_by_model(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(model_id, query_id, point_id, score, rank) over rows (model_id, id, vector): all models in one scan of the points.

    Each task holds one query matrix per model while their counted size is within the broadcast bound; beyond it the
    vectors are filled up with zeros to one size, which changes no cosine, and meet in `top_k` with the model as its filter.
    """
    best = F.row_number().over(Window.partitionBy("model_id", "query_id").orderBy(F.col("score").desc(), "point_id"))
    _, _, size = _counted(queries.select("query_id", "vector", "model_id"))
    if size > BROADCAST_BYTES:
        dim = points.agg(F.max(F.size("vector"))).first()[0]
        filled = F.concat(F.col("vector").cast("array<double>"), F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vector")))
        asked = queries.select(F.struct("model_id", "query_id").alias("pair"), filled.alias("vector"), "model_id")
        asked = asked.withColumn("query_id", F.to_json("pair"))
        names = asked.select("query_id", F.col("pair.model_id").alias("model_id"), F.col("pair.query_id").alias("__id"))
        hits = top_k(points.withColumn("vector", filled), asked, k, subject="model_id")
        return hits.join(names, "query_id").select("model_id", F.col("__id").alias("query_id"), "point_id", "score", "rank")
    matrices = {}
    for model, part in queries.select("model_id", "query_id", "vector").toArrow().to_pandas().groupby("model_id"):
        matrices[model] = (part["query_id"].to_numpy(), unit_rows(pa.array(part["vector"].tolist())))
    sent = points.sparkSession.sparkContext.broadcast(matrices)
    id_type, query_type = points.schema["point_id"].dataType, queries.schema["query_id"].dataType
    fields = [("model_id", T.StringType()), ("query_id", query_type), ("point_id", id_type), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, LocalTopK] = {}
        for batch in batches:
            for model in batch.column(0).unique().to_pylist():
                if model in sent.value:
                    part = batch.filter(pc.equal(batch.column(0), model))
                    local = found.setdefault(model, LocalTopK(sent.value[model][1], None, k))
                    local.add(values(part.column(1)), unit_rows(part.column(2)), None)
        for model, local in found.items():
            at, ids, scores = local.result()
            asked = sent.value[model][0][at].tolist()
            yield pa.RecordBatch.from_arrays([pa.array([model] * len(at)), _arrow(asked, query_type), _arrow(ids, id_type), pa.array(scores)], names=schema.names)

    hits = points.select("model_id", "point_id", "vector").mapInArrow(scan, schema)
    return hits.withColumn("rank", best).where(F.col("rank") <= k)


def benchmark_models(
    spark: SparkSession,
    models: dict[str, Callable[[], tuple[DataFrame, DataFrame]]],
    gold: DataFrame,
    latency: dict[str, float] | None = None,
) -> DataFrame:
    """One row per model over its (points, queries) vector tables, all models in one search.

    A model whose tables can't be made, or whose vectors differ in size, is a row of dimension 0 with the cause and
    doesn't stop the rest. Rows without a vector (an encoder's isolated failures) are left out.
    """
    failed, sides = {}, []
    for model, tables in models.items():
        try:
            sides.append([t.select(F.lit(model).alias("model_id"), *ids, "vector").where(F.col("vector").isNotNull()) for t, ids in zip(tables(), (["point_id"], ["query_id"]))])
        except (PySparkException, OSError, ValueError, RuntimeError) as cause:
            failed[model] = f"{type(cause).__name__}: {str(cause)[:200]}"
    rows = [(model, 0, 0.0, 0.0, float("inf"), cause) for model, cause in failed.items()]
    if not sides:
        return spark.createDataFrame(rows, RESULT)
    points, queries = (reduce(DataFrame.unionByName, side) for side in zip(*sides))
    shapes = {r["model_id"]: set(r[1:]) for r in _shapes(points, queries)}
    good = {}
    for model in models.keys() - failed.keys():
        sizes = shapes.get(model, {None})
        if len(sizes) == 1 and None not in sizes:
            good[model] = sizes.pop()
        else:
            rows.append((model, 0, 0.0, 0.0, float("inf"), f"ValueError: vector sizes {sorted(s for s in sizes if s is not None)}"))
    if good:
        names = F.col("model_id").isin(list(good))
        hits = top_k_by_model(points.where(names), queries.where(names), 3)
        # every model answers every question
        asked = gold.withColumn("model_id", F.explode(F.array(*[F.lit(m) for m in good])))
        found = hits.select("model_id", "query_id", F.col("point_id").alias("gold_id"), F.col("rank").alias("gold_rank"))
        recall: dict[str, dict[int, float]] = {m: {} for m in good}
        for r in recall_at(asked.join(found, ["model_id", "query_id", "gold_id"], "left"), by=["model_id"]).collect():
            recall[r["model_id"]][r["k"]] = r["recall"]
        rows += [(m, dim, recall[m].get(1, 0.0), recall[m].get(3, 0.0), (latency or {}).get(m, 0.0), None) for m, dim in good.items()]
    return spark.createDataFrame(rows, RESULT)
