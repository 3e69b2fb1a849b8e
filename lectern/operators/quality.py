"""Length filter, exact dedup and the funnel counters over one flagged scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import estimated_tokens, normalize_key


def length_ok(text: str, low: int = C.OUTPUT_CHARS[0], high: int = C.OUTPUT_CHARS[1]) -> Column:
    return F.length(text).between(low, high)


def _key_digest(text: str) -> Column:
    # a digest keeps the sort and shuffle key short for long texts
    return F.sha2(normalize_key(text), 256)


def first_per_key(df: DataFrame, text: str, order: str) -> DataFrame:
    """Keep the first row of every normalized key.

    `row_number() = 1` makes Spark drop repeats inside each map task before the
    shuffle (WindowGroupLimit), so a key holding a third of the rows sends one row per task.
    """
    w = Window.partitionBy("__key").orderBy(order)
    return (
        df.withColumn("__key", _key_digest(text))
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .drop("__key", "__rn")
    )


def quality_filter(df: DataFrame, key_text: str, length_text: str, order: str) -> DataFrame:
    """Length filter first, so a dropped row never claims a key; then exact dedup."""
    return first_per_key(df.where(length_ok(length_text)), key_text, order)


def filter_funnel(df: DataFrame, key_text: str, length_text: str) -> DataFrame:
    """One row: total, dropped by length, dropped as exact copy, kept. Rows merge per key first."""
    ok = F.coalesce(length_ok(length_text), F.lit(False))
    per_key = df.groupBy(F.when(ok, _key_digest(key_text)).alias("key")).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("length"),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("n") - 1)), F.lit(0))
        .cast("bigint")
        .alias("exact_duplicate"),
        F.count("key").alias("kept"),
    )


def outlier_class(text: str) -> Column:
    n = F.length(text)
    return (
        F.when(~n.between(*C.OUTPUT_CHARS), F.lit("violation"))
        .when(n < C.SHORT_CHARS, F.lit("short"))
        .when(n > C.LONG_CHARS, F.lit("long"))
        .otherwise(F.lit("normal"))
    )


def outlier_counts(df: DataFrame, text: str) -> DataFrame:
    n = F.length(text)
    return df.agg(
        F.count_if(n < C.SHORT_CHARS).alias("short"),
        F.count_if(n > C.LONG_CHARS).alias("long"),
        F.count_if(~n.between(*C.OUTPUT_CHARS)).alias("violation"),
    )


def sequence_budget(
    df: DataFrame,
    instruction_tokens: Column | None = None,
    output_tokens: Column | None = None,
    limit: int = C.MAX_SEQUENCE_TOKENS,
) -> DataFrame:
    """Add token counts, the total with chat overhead, and over/near flags.

    Counts come from the caller's tokenizer (any column, e.g. an iterator pandas UDF);
    without one the built-in estimate is used.
    """
    ins = estimated_tokens("instruction") if instruction_tokens is None else instruction_tokens
    out = estimated_tokens("output") if output_tokens is None else output_tokens
    total = F.col("total_tokens")
    return (
        df.withColumn("instruction_tokens", ins.cast("bigint"))
        .withColumn("output_tokens", out.cast("bigint"))
        .withColumn("total_tokens", F.col("instruction_tokens") + F.col("output_tokens") + C.CHAT_OVERHEAD_TOKENS)
        .withColumn("over", total > limit)
        .withColumn("near", (total > limit * 0.9) & (total <= limit))
    )


def chars_per_token(df: DataFrame, text: str, tokens: str) -> DataFrame:
    ratio = F.when(F.col(tokens) > 0, F.length(text) / F.col(tokens))
    return df.agg(F.avg(ratio).alias("chars_per_token"))
