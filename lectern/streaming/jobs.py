"""Structured Streaming versions of the incremental jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.answers import folded_attempts, picked
from lectern.operators.index import document_parts, merged_documents
from lectern.operators.sessions import rollup_aggregates
from lectern.session import shared_path


#: Batches after which the table of known ids is written as a whole again.
COMPACT = 20


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    """A Parquet folder (or glob) as a stream, its schema taken from the files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _drain(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], None], state: str) -> StreamingQuery:
    """Run everything available now through `each`, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()
    return query


def session_counters(events: DataFrame, out: str, state: str, session: str = "session_id", sessions: DataFrame | None = None) -> StreamingQuery:
    """Keep session counters current; each trigger writes its changed sessions under its batch number.

    Events of unknown sessions are dropped by a stream-static join. Sessions never expire,
    so the state holds one row per session.
    """
    if sessions is not None:
        events = events.join(sessions.select(session).distinct(), session, "left_semi")
    counters = events.groupBy(session).agg(*rollup_aggregates())

    def write(batch: DataFrame, number: int) -> None:
        # a repeated batch overwrites its own folder, so a restart changes nothing
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _drain(counters, "update", write, state)


def current_counters(spark: SparkSession, out: str, session: str = "session_id") -> DataFrame:
    """Newest row per session over all triggers."""
    rows = spark.read.parquet(out)
    value = F.struct(*[c for c in rows.columns if c not in (session, "batch")])
    return rows.groupBy(session).agg(F.max_by(value, "batch").alias("v")).select(session, "v.*")


def run_session_counters(spark: SparkSession, events: DataFrame, session: str = "session_id") -> DataFrame:
    """Drain a stream into a fresh shared folder and return the counters."""
    base = shared_path(spark, "session-counters")
    session_counters(events, f"{base}/out", f"{base}/state", session)
    return current_counters(spark, f"{base}/out", session)


def ingest(documents: DataFrame, out: str, state: str, to_points: Callable[[DataFrame, DataFrame | None], DataFrame]) -> StreamingQuery:
    """Index newly arriving documents; content already indexed is skipped.

    `to_points(documents, existing)` builds the points of a batch against the ids of the
    documents indexed by earlier ones. Ids have a table of their own (`<out>-ids`), one folder a
    batch; every `COMPACT` batches the folder of the batch holds all ids so far, and later batches read
    from there on, so a batch does not read the points nor every earlier folder again. A
    repeated batch overwrites its own folders.
    """
    ids = f"{out}-ids"

    def known(spark: SparkSession, number: int) -> DataFrame | None:
        whole = (number - 1) // COMPACT * COMPACT
        rows = spark.read.schema("doc_id string, batch int").parquet(ids)
        return rows.where((F.col("batch") < number) & (F.col("batch") >= whole)).select("doc_id")

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        existing = known(spark, number) if number else None
        points = f"{out}/batch={number}"
        found = to_points(batch, existing)
        found.write.mode("overwrite").parquet(points)
        fresh = spark.read.schema(found.schema).parquet(points).select("doc_id").distinct()
        if number and number % COMPACT == 0:
            fresh = fresh.union(existing)
        fresh.write.mode("overwrite").parquet(f"{ids}/batch={number}")

    return _drain(documents, "append", each, state)


def run_ingest(spark: SparkSession, documents: DataFrame, to_points: Callable[[DataFrame, DataFrame | None], DataFrame]) -> DataFrame:
    base = shared_path(spark, "ingest")
    ingest(documents, f"{base}/out", f"{base}/state", to_points)
    return spark.read.parquet(f"{base}/out")


def folded_steps(steps: DataFrame, run: str = "run_id", step: str = "step", field: str = "field", value: str = "value") -> DataFrame:
    """Streaming or batch: the last value of every field of a run."""
    return steps.groupBy(run, field).agg(F.max_by(value, step).alias(value))


def run_folded_steps(spark: SparkSession, steps: DataFrame) -> DataFrame:
    base = shared_path(spark, "steps")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    _drain(folded_steps(steps), "update", write, f"{base}/state")
    rows = spark.read.parquet(f"{base}/out")
    return rows.groupBy("run_id", "field").agg(F.max_by("value", "batch").alias("value"))


def attempt_folds(attempts: DataFrame, out: str, state: str, question: str = "question_id") -> StreamingQuery:
    """Fold arriving attempts; each trigger writes the questions it touched under its batch number.

    A fold is a minimum and a maximum per question, so attempts may arrive in any order and any batch, and a hot question
    merges map-side. Questions never expire: the state holds one row per question.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _drain(folded_attempts(attempts, question), "update", write, state)


def current_attempts(spark: SparkSession, out: str, question: str = "question_id") -> DataFrame:
    """Result of `fold_attempts` over all triggers."""
    rows = spark.read.parquet(out)
    return picked(rows.groupBy(question).agg(F.min("done").alias("done"), F.max("last").alias("last")), question)


def run_attempt_folds(spark: SparkSession, attempts: DataFrame, question: str = "question_id") -> DataFrame:
    base = shared_path(spark, "attempts")
    attempt_folds(attempts, f"{base}/out", f"{base}/state", question)
    return current_attempts(spark, f"{base}/out", question)


def document_summaries(points: DataFrame, out: str, state: str) -> StreamingQuery:
    """Keep the list of documents current: each batch adds the parts that its points make, no earlier point is read again.

    Every `COMPACT` batches the folder of the batch holds the merged parts of all so far, and reading starts there.
    """

    def each(batch: DataFrame, number: int) -> None:
        parts = document_parts(batch)
        if number and number % COMPACT == 0:
            parts = merged_documents(parts.unionByName(_parts(batch.sparkSession, out, number)), parts_only=True)
        parts.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _drain(points, "append", each, state)


def _parts(spark: SparkSession, out: str, before: int | None = None) -> DataFrame:
    """Parts of the batches that count: the last merged one and those after it."""
    rows = spark.read.parquet(out)
    newest = before - 1 if before is not None else rows.agg(F.max("batch")).first()[0] or 0
    live = F.col("batch").between(newest // COMPACT * COMPACT, newest)
    return rows.where(live).drop("batch")


def current_documents(spark: SparkSession, out: str) -> DataFrame:
    """Result of `list_documents` over all points that came so far."""
    return merged_documents(_parts(spark, out))


def run_document_summaries(spark: SparkSession, points: DataFrame) -> DataFrame:
    base = shared_path(spark, "summaries")
    document_summaries(points, f"{base}/out", f"{base}/state")
    return current_documents(spark, f"{base}/out")
