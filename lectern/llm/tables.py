"""Written intermediate tables and numbers that Spark counts once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lectern.session import shared_path


def saved(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read again: survives lost executors and is computed once."""
    path = shared_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
