"""Documents to index points, upsert by deterministic id, document summaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import document_id, file_stem, is_blank, point_id, retrieval_text
from lectern.operators.chunking import explode_pages, explode_single_pages
from lectern.operators.embed import Vectorizer, embed_passages

AUTOMATIC = ("point_id", "vector", "source", "page_num", "chunk_index", "doc_id", "text")


def _content_digests(pages: DataFrame, file: str) -> DataFrame:
    """SHA-256 per file of its pages joined by newlines, in page order.

    Sorted pages stream through the hash, so memory does not grow with the file;
    the chain itself is sequential per file by definition.
    """
    file_type = pages.schema[file].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, source, running = None, None, None

        def done():
            return pa.RecordBatch.from_pylist(
                [{file: current, "__source": source, "__digest": running.hexdigest()}], schema=arrow_schema
            )

        for batch in batches:
            arrow_schema = pa.schema([batch.schema.field(0), pa.field("__source", pa.string()), pa.field("__digest", pa.string())])
            for row_file, row_source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if running is None or row_file != current:
                    if running is not None:
                        yield done()
                    current, source, running = row_file, row_source, hashlib.sha256(text.encode())
                else:
                    running.update(b"\n" + text.encode())
        if running is not None:
            yield done()

    return (
        pages.select(file, "source", "text", "page_num")
        .repartition(file)
        .sortWithinPartitions(file, "page_num")
        .mapInArrow(digests, f"`{file}` {file_type}, __source string, __digest string")
    )


def with_document_id(pages: DataFrame, file: str = "file_id", single_page: bool = False) -> DataFrame:
    """Add `doc_id` from the source stem and the file's non-blank pages joined by newlines."""
    filled = pages.where(~is_blank("text"))
    if single_page:
        return filled.withColumn("doc_id", document_id(file_stem("source"), "text"))
    name = F.concat(file_stem("__source"), F.lit("_"), F.substring("__digest", 1, 16))
    return filled.join(_content_digests(filled, file).select(file, name.alias("doc_id")), file)


def blank_files(pages: DataFrame, file: str = "file_id") -> DataFrame:
    """Files rejected because every page is blank."""
    return pages.groupBy(file).agg(F.every(is_blank("text")).alias("blank")).where("blank").select(file)


def new_documents(pages: DataFrame, existing: DataFrame | None = None, file: str = "file_id") -> DataFrame:
    """Pages of the first file per doc_id whose doc_id is not indexed yet.

    `rank() = 1` is pushed below the shuffle (WindowGroupLimit), so copies of one
    document collapse inside each map task.
    """
    rank = F.rank().over(Window.partitionBy("doc_id").orderBy(file))
    if existing is not None:
        pages = pages.join(existing.select("doc_id").distinct(), "doc_id", "left_anti")
    return pages.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def build_points(
    pages: DataFrame,
    chunks: Column,
    vectorizer: Vectorizer,
    metadata: Sequence[str] = ("subject",),
    model: str = "",
    single_page: bool = False,
    normalize: bool = True,
) -> DataFrame:
    """Chunk, number, vectorize, id. Metadata named like an automatic field is ignored."""
    extra = [m for m in metadata if m not in AUTOMATIC]
    rows = pages.select("doc_id", "source", "page_num", "text", *extra)
    pieces = explode_single_pages(rows, chunks) if single_page else explode_pages(rows, chunks)
    points = embed_passages(pieces, "text", vectorizer, model, normalize)
    return points.select(
        point_id("doc_id", "chunk_index").alias("point_id"), *extra,
        "source", "page_num", "chunk_index", "doc_id", "text", "vector",
    )


def record_points(records: DataFrame, position: str, vectorizer: Vectorizer, prefix: str = "train") -> DataFrame:
    """One point per question-answer record; defaults: subject `genel`, grade 0."""
    n = F.col(position).cast("string")
    rows = records.select(
        F.concat(F.lit(f"{prefix}_"), n).alias("doc_id"),
        F.concat(F.lit(f"{prefix}.jsonl#"), n).alias("source"),
        F.lit(0).alias("page_num"),
        F.coalesce(F.col("subject"), F.lit("genel")).alias("subject"),
        F.coalesce(F.col("grade"), F.lit(0)).cast("int").alias("grade_level"),
        F.lit(0).alias("chunk_index"),
        retrieval_text("instruction", "output").alias("text"),
    )
    return embed_passages(rows, "text", vectorizer).withColumn("point_id", point_id("doc_id", "chunk_index"))


def upsert(existing: DataFrame, new: DataFrame, key: str = "point_id", order: str | None = None) -> DataFrame:
    """New rows replace old ones of the same id; one row per id is left.

    Of several new rows with one id the last by the column `order` stays (it is dropped
    from the result); without `order` any one of them, for rows that are known to be equal.
    """
    if order is None:
        new = new.dropDuplicates([key])
    else:
        last = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
        new = new.withColumn("__last", last).where(F.col("__last") == 1).drop("__last", order)
    return existing.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def save_points(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    points.write.mode(mode).partitionBy("subject").parquet(path)


def wrong_size(points: DataFrame, size: int, vector: str = "vector") -> DataFrame:
    """Points whose vector does not have the collection's size; must be empty."""
    return points.where(F.coalesce(F.size(vector) != size, F.lit(True)))


def scan_collection(points: DataFrame) -> DataFrame:
    """Payload without vectors; the column never leaves the files."""
    return points.drop("vector")


def list_documents(points: DataFrame) -> DataFrame:
    """Per document: source and subject of its first chunk, its pages, page and chunk counts."""
    return merged_documents(document_parts(points))


def document_parts(points: DataFrame) -> DataFrame:
    """What a set of points tells of its documents: (doc_id, head, pages, n). Parts of different points add up."""
    doc = F.coalesce(F.col("doc_id"), F.lit(C.UNKNOWN_DOC))
    page = F.coalesce(F.col("page_num"), F.lit(0))
    first = F.coalesce(F.col("chunk_index"), F.lit(0))
    # merged per page first: the page set of a document is built from distinct pages only
    per_page = points.groupBy(doc.alias("doc_id"), page.alias("page")).agg(
        F.min(F.struct(first.alias("i"), "source", "subject")).alias("head"), F.count("*").alias("n")
    )
    return per_page.groupBy("doc_id").agg(
        F.min("head").alias("head"), F.array_sort(F.collect_set("page")).alias("pages"), F.sum("n").cast("bigint").alias("n")
    )


def merged_documents(parts: DataFrame, parts_only: bool = False) -> DataFrame:
    """Parts of the same documents put together, as the list of documents or as parts again."""
    merged = parts.groupBy("doc_id").agg(
        F.min("head").alias("head"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"),
        F.sum("n").cast("bigint").alias("n"),
    )
    if parts_only:
        return merged
    return merged.select(
        "doc_id", F.col("head.source").alias("source"), F.col("head.subject").alias("subject"), "pages",
        F.size("pages").cast("bigint").alias("page_count"), F.col("n").alias("chunk_count"),
    )


def upload_report(uploads: DataFrame, new_points: DataFrame, file: str = "file_id") -> DataFrame:
    """One row per accepted upload: `chunks_indexed` is 0 for content already known.

    `new_points` counts go to the first upload of a doc_id only.
    """
    counts = new_points.groupBy("doc_id").agg(F.count("*").alias("__n"))
    firsts = uploads.groupBy("doc_id").agg(F.min(file).alias(file))
    known = firsts.join(counts, "doc_id").select(file, "__n")
    return (
        uploads.join(known, file, "left")
        .withColumn("chunks_indexed", F.coalesce("__n", F.lit(0)).cast("bigint"))
        .withColumn("status", F.lit("ready"))
        .drop("__n")
    )
