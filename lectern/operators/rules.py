"""Row validation: named predicates in, one row per broken rule out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import is_blank

_UUID = r"(?i)\A[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}\z"


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; an unknown (null) outcome counts as broken."""
    marks = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.filter(F.array(*marks), lambda x: x.isNotNull())


def violations(df: DataFrame, rules: dict[str, Column], keep: list[str]) -> DataFrame:
    return df.select(*keep, F.explode(broken_rules(rules)).alias("rule"))


def request_rules(session_id: str | None = None) -> dict[str, Column]:
    rules = {
        "question_length": F.length("question").between(*C.QUESTION_CHARS),
        "subject": F.col("subject").isin(*C.REQUEST_SUBJECTS),
        "grade_level": F.col("grade_level").between(*C.REQUEST_GRADES),
    }
    if session_id:
        rules["session_id"] = F.col(session_id).rlike(_UUID)
    return rules


def response_rules() -> dict[str, Column]:
    return {
        "confidence": F.col("confidence").between(0.0, 1.0),
        "processing_time_ms": F.col("processing_time_ms") >= 0,
    }


def upload_reject(file_name: str, size_bytes: Column) -> Column:
    """Status of the first broken upload rule: 415 wrong suffix, 413 too large, else null."""
    name = F.lower(F.coalesce(F.col(file_name), F.lit("")))
    known = F.lit(False)
    for suffix in C.UPLOAD_SUFFIXES:
        known = known | name.endswith(suffix)
    return F.when(~known, F.lit(415)).when(size_bytes > C.UPLOAD_BYTES, F.lit(413))


def upload_rules() -> dict[str, Column]:
    return {
        "title": F.length("title") <= C.TITLE_CHARS,
        "subject": F.col("subject").isin(*C.REQUEST_SUBJECTS),
        "grade_level": F.col("grade_level").between(*C.REQUEST_GRADES),
    }


def missing_keys(line: str) -> Column:
    """Required keys that a JSON line lacks (all of them when it is no object)."""
    required = F.array(*[F.lit(k) for k in C.REQUIRED_KEYS])
    present = F.coalesce(F.json_object_keys(line), F.array().cast("array<string>"))
    return F.array_except(required, present)


def contract_violations(lines: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """Check raw JSON lines against the record contract; `detail` names missing keys."""
    body = F.try_parse_json(line)

    def kind(key):
        return F.schema_of_variant(F.try_variant_get(body, f"$.{key}", "variant"))

    def text(key):
        return F.when(kind(key) == "STRING", F.try_variant_get(body, f"$.{key}", "string"))

    parsed = lines.select(
        *keep,
        F.array_join(missing_keys(line), ",").alias("__missing"),
        text("instruction").alias("__instruction"),
        text("output").alias("__output"),
        text("subject").alias("__subject"),
        (kind("input") == "STRING").alias("__input_text"),
        F.when(kind("grade") == "BIGINT", F.try_variant_get(body, "$.grade", "bigint")).alias("__grade"),
    )
    complete = F.col("__missing") == ""
    rules = {
        "missing_keys": complete,
        "subject": ~complete | F.col("__subject").isin(*C.REQUEST_SUBJECTS),
        "grade": ~complete | F.col("__grade").between(*C.RECORD_GRADES),
        "output_length": ~complete | F.length("__output").between(*C.OUTPUT_CHARS),
        "instruction_blank": ~complete | ~is_blank("__instruction"),
        "output_blank": ~complete | ~is_blank("__output"),
        "input_type": ~complete | F.col("__input_text"),
    }
    return parsed.select(*keep, F.col("__missing").alias("detail"), F.explode(broken_rules(rules)).alias("rule"))
