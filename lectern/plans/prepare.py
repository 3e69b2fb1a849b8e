"""Dataset preparation: replies to filtered, deduplicated, split records with a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.operators.embed import Vectorizer, embed_passages
from lectern.operators.neardup import semantic_dedup
from lectern.operators.quality import filter_funnel, quality_filter
from lectern.operators.split import duplicate_keys, leaked, stratified_split
from lectern.operators.rules import contract_violations
from lectern.operators.stats import length_stats, subject_grade_pivot
from lectern.session import cut_lineage
from lectern.sources.files import write_jsonl


@dataclass
class Prepared:
    """Split records and the numbers of the run, all lazy DataFrames."""

    records: DataFrame
    funnel: DataFrame
    pivot: DataFrame
    lengths: DataFrame


def clean_records(
    records: DataFrame, row_id: str = "rec_id", vectorizer: Vectorizer | None = None,
    threshold: float = C.NEAR_DUPLICATE_COSINE,
) -> DataFrame:
    """Length filter, exact dedup and, with a vectorizer, semantic dedup on the instruction."""
    clean = quality_filter(records, "instruction", "output", row_id)
    if vectorizer is None:
        return clean
    clean = cut_lineage(clean)
    kept = semantic_dedup(embed_passages(clean, "instruction", vectorizer), row_id, "vector", threshold)
    return clean.join(kept, row_id, "left_semi")


def prepare(
    records: DataFrame, row_id: str = "rec_id", vectorizer: Vectorizer | None = None,
    threshold: float = C.NEAR_DUPLICATE_COSINE, eval_ratio: float = C.EVAL_RATIO,
    seed: int = C.SEED, min_records: int = C.MIN_RECORDS,
) -> Prepared:
    """The whole preparation. Fewer than `min_records` clean records is an error."""
    clean = cut_lineage(clean_records(records, row_id, vectorizer, threshold))
    if clean.limit(min_records).count() < min_records:
        raise ValueError(f"fewer than {min_records} records left after the filters")
    split = cut_lineage(stratified_split(clean, row_id, eval_ratio, seed))
    sizes = split.agg(
        F.count("*").alias("final"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "eval").alias("eval"),
    )
    funnel = filter_funnel(records, "instruction", "output")
    final = sizes.select("final").scalar()
    report = (
        funnel.withColumn("semantic", F.col("kept") - final)
        .withColumn("final", final)
        .withColumn("train", sizes.select("train").scalar())
        .withColumn("eval", sizes.select("eval").scalar())
        .drop("kept")
    )
    return Prepared(split, report, subject_grade_pivot(split), length_stats(split, "output"))


def write_splits(prepared: Prepared, folder: str) -> None:
    fields = ["instruction", "input", "output", "subject", "grade"]
    for part in ("train", "eval"):
        write_jsonl(prepared.records.where(F.col("split") == part).select(*fields), f"{folder}/{part}")


def split_report(train_lines: DataFrame, eval_lines: DataFrame, train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Quality report (check, n): contract violations per rule, repeated keys, leaked keys."""
    lines = train_lines.unionByName(eval_lines)
    broken = contract_violations(lines, "line", []).groupBy(F.concat(F.lit("contract:"), F.col("rule")).alias("check"))
    repeated = duplicate_keys(train, evaluation, "instruction")
    shared = leaked(train, evaluation, "instruction").agg(F.count("*").alias("n"))
    return (
        broken.agg(F.count("*").alias("n"))
        .unionByName(repeated.select(F.lit("duplicate_rows").alias("check"), F.col("duplicates").alias("n")))
        .unionByName(shared.select(F.lit("leaked_rows").alias("check"), "n"))
    )
