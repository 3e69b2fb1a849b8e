"""Texts to vectors through a pluggable vectorizer.

A vectorizer maps a text Column to an ARRAY column: the keyword vectorizer is plain
SQL, a real encoder is an iterator pandas UDF that loads its model once per worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import passage_prefix, query_prefix
from lectern.functions.vectors import l2_normalize

Vectorizer = Callable[[Column], Column]
PREVIEW_CHARS = 80


def isolating_vectorizer(load: Callable[[], Callable[[list[str]], list]]) -> Vectorizer:
    """Vectorizer with results STRUCT<vector, error>: one bad text does not fail its batch.

    `load` runs once per worker and returns a batch encoder. When a batch fails, its
    texts are tried alone and the failing ones carry the cause.
    """

    @F.pandas_udf("struct<vector:array<float>,error:string>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = load()

        def alone(text):
            try:
                return encoder([text])[0], None
            except Exception as cause:
                return None, f"{type(cause).__name__}: {cause}"

        for texts in batches:
            values = texts.tolist()
            try:
                vectors = list(encoder(values)) if values else []
                if len(vectors) != len(values):
                    raise ValueError("encoder changed the number of rows")
                pairs = [(v, None) for v in vectors]
            except Exception:
                pairs = [alone(v) for v in values]
            yield pd.DataFrame(
                {"vector": pd.Series([v for v, _ in pairs], dtype=object), "error": pd.Series([e for _, e in pairs], dtype=object)}
            )

    return lambda text: encode(text)


def split_failures(df: DataFrame, encoded: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a vector, quarantined rows with preview and cause) of an isolating vectorizer."""
    good = df.where(F.col(f"{encoded}.error").isNull()).withColumn("vector", F.col(f"{encoded}.vector")).drop(encoded)
    bad = (
        df.where(F.col(f"{encoded}.error").isNotNull())
        .withColumn("preview", F.substring(text, 1, PREVIEW_CHARS))
        .withColumn("cause", F.col(f"{encoded}.error"))
        .drop(encoded, text)
    )
    return good, bad


def embed_passages(
    df: DataFrame, text: str, vectorizer: Vectorizer, model: str = "", normalize: bool = True, out: str = "vector"
) -> DataFrame:
    vector = vectorizer(F.concat(passage_prefix(F.lit(model)), F.col(text)))
    return df.withColumn(out, l2_normalize(vector) if normalize else vector)


def embed_queries(
    df: DataFrame, text: str, vectorizer: Vectorizer, model: str = "", normalize: bool = True, out: str = "vector"
) -> DataFrame:
    """Every distinct query text is vectorized once and joined back; a null text keeps its row, without a vector."""
    vector = vectorizer(F.concat(query_prefix(F.lit(model)), F.col(text)))
    unique = df.select(text).where(F.col(text).isNotNull()).distinct().withColumn(out, l2_normalize(vector) if normalize else vector)
    return df.join(unique, text, "left")
