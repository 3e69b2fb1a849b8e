"""Raw model replies to question-answer records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.constants import JSON_FENCE
from lectern.functions.text import _col, strip


def json_array_text(reply: Column | str) -> Column:
    """Fenced array first, else first `[` to last `]`, else the reply itself."""
    reply = _col(reply)
    fenced = F.regexp_extract(reply, JSON_FENCE, 1)
    start = F.instr(reply, "[")
    end = F.length(reply) - F.instr(F.reverse(reply), "]") + 1
    closed = (F.instr(reply, "]") > 0) & (start > 0) & (end > start)
    return (
        F.when(fenced != "", fenced)
        .when(closed, F.substring(reply, start, end - start + 1))
        .otherwise(reply)
    )


def with_items(df: DataFrame, reply: str) -> DataFrame:
    """Add `items` (array of variants, null when the reply holds no JSON list) and `parse_ok`."""
    body = F.try_parse_json(json_array_text(reply))
    listed = F.schema_of_variant(body).startswith("ARRAY")
    items = F.when(listed, F.try_variant_get(body, "$", "array<variant>"))
    return df.withColumn("items", items).withColumn("parse_ok", F.col("items").isNotNull())


def _field(item: Column, key: str) -> Column:
    """Text of a field as Python's str() prints it for scalars; missing gives ''."""
    value = F.try_variant_get(item, f"$.{key}", "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(item, f"$.{key}", "string")
    return strip(
        F.when(value.isNull(), F.lit(""))
        .when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(F.coalesce(text, F.lit("")))
    )


def parse_replies(df: DataFrame, reply: str, keep: Sequence[str]) -> DataFrame:
    """Records (keep..., position, instruction, input, output); blank or non-object items dropped."""
    items = with_items(df, reply).select(*keep, F.posexplode("items").alias("position", "item"))
    return (
        items.where(F.schema_of_variant("item").startswith("OBJECT"))
        .select(
            *keep,
            "position",
            _field(F.col("item"), "instruction").alias("instruction"),
            F.lit("").alias("input"),
            _field(F.col("item"), "output").alias("output"),
        )
        .where((F.col("instruction") != "") & (F.col("output") != ""))
    )


def parse_counts(df: DataFrame, reply: str) -> DataFrame:
    return with_items(df, reply).agg(
        F.count("*").alias("replies"),
        F.count_if("parse_ok").alias("parsed"),
        F.coalesce(F.sum(F.size("items")), F.lit(0)).cast("bigint").alias("items"),
    )
