"""Readers and writers for JSON lines, text documents, marked corpora and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import base_name, file_suffix, is_blank, strip

RECORD = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("grade", T.IntegerType()),
    ]
)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Declared schema, no inference pass; blank lines are skipped, a broken line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines for the contract check, blank ones dropped."""
    return spark.read.text(path).where(~is_blank("value")).withColumnRenamed("value", "line")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One page (number 0) per text file: (source, page_num, text). Another suffix fails the read."""
    raw = spark.read.text([path] if isinstance(path, str) else list(path), wholetext=True)
    source = base_name(F.input_file_name())
    wrong = F.raise_error(F.concat(F.lit("unsupported file format: "), F.col("source")))
    return (
        raw.select(F.url_decode(F.replace(source, F.lit("+"), F.lit("%2B"))).alias("source"), F.col("value").alias("text"))
        .withColumn("text", F.when(file_suffix("source") == ".txt", F.col("text")).otherwise(wrong))
        .select("source", F.lit(0).alias("page_num"), "text")
    )


def read_seed_documents(spark: SparkSession, folder: str, seeds: Sequence[tuple[str, str]]) -> DataFrame:
    """Documents of a (file name, subject) list; names without a file in the folder itself are skipped.

    The list is resolved to paths (their number is that of the list at most) and only those
    files are read; one that is no text fails the read, as in `read_documents`.
    """
    wanted = spark.createDataFrame(list(seeds), "source string, subject string").distinct()
    found = spark.read.format("binaryFile").load(folder).select("path")
    present = found.withColumn("source", base_name(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))))
    paths = [r["path"] for r in present.join(F.broadcast(wanted.select("source").distinct()), "source").select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "source string, page_num int, text string, subject string")
    return read_documents(spark, paths).join(F.broadcast(wanted), "source")


def marked_paragraphs(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Paragraphs of texts marked with `##P<n>` lines: (keep..., paragraph_id, text).

    Other lines starting with `#` are dropped, the rest stripped and joined by one space;
    empty paragraphs and text before the first marker are dropped.
    """
    clean = F.regexp_replace(F.col(text), r"\r\n?|[\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]", "\n")
    pieces = F.split(clean, r"(?m)(?=^##P\d+[^\S\n]*$)")
    marker = F.regexp_extract("piece", r"\A##P(\d+)[^\S\n]*(?:\n|\z)", 1)
    every = F.split("piece", "\n")
    lines = F.slice(every, F.lit(2), F.size(every))
    body = F.transform(F.filter(lines, lambda x: ~x.startswith("#")), strip)
    return (
        df.select(*keep, F.explode(pieces).alias("piece"))
        .where(marker != "")
        .select(
            *keep,
            marker.cast("bigint").alias("paragraph_id"),
            F.array_join(F.filter(body, lambda x: x != ""), " ").alias("text"),
        )
        .where(F.col("text") != "")
    )


def read_marked_corpus(spark: SparkSession, path: str) -> DataFrame:
    return marked_paragraphs(spark.read.text(path, wholetext=True), "value")
