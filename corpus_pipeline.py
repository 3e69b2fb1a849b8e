"""Corpus pipeline: each stage reads what its predecessor wrote; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import best_two_fit, fm_dedup, gray_simhash, line_dedup, toxicity
from lectern.llm.tables import read_table, saved

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", gray_simhash.stage),
    ("substring_dedup", fm_dedup.stage),
    ("best_fit_packing", best_two_fit.stage),
]

#: A trained classifier, hash fingerprints, text indexes and tokenizers have no SQL form; a test compares with a plain restatement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
