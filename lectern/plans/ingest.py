"""Uploads and documents to an index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.embed import Vectorizer
from lectern.operators.index import build_points, new_documents, upload_report, with_document_id
from lectern.operators.rules import upload_reject


def index_documents(
    pages: DataFrame, chunks: Column, vectorizer: Vectorizer, metadata: Sequence[str] = ("subject",),
    existing: DataFrame | None = None, file: str = "file_id", single_page: bool = False, normalize: bool = True, model: str = "",
) -> DataFrame:
    """New points of the given pages: id, skip known, chunk, number, vectorize."""
    named = with_document_id(pages, file, single_page)
    fresh = new_documents(named, existing, file)
    return build_points(fresh, chunks, vectorizer, metadata, model, single_page, normalize)


def index_uploads(
    uploads: DataFrame, chunks: Column, vectorizer: Vectorizer, metadata: Sequence[str] = ("subject",),
    existing: DataFrame | None = None, file: str = "file_id",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points, report of accepted uploads, rejected uploads with their status).

    Uploads are one text each: file_id, source, text and metadata columns.
    """
    sized = uploads.withColumn("size_bytes", F.octet_length("text").cast("bigint")).withColumn("page_num", F.lit(0))
    checked = sized.withColumn("status_code", upload_reject("source", F.col("size_bytes")))
    rejected = checked.where(F.col("status_code").isNotNull()).select(file, "source", "status_code")
    accepted = checked.where(F.col("status_code").isNull()).drop("status_code")
    named = with_document_id(accepted, file, single_page=True)
    points = build_points(new_documents(named, existing, file), chunks, vectorizer, metadata, single_page=True)
    report = upload_report(named.select(file, "source", "size_bytes", "doc_id"), points, file)
    return points, report, rejected
