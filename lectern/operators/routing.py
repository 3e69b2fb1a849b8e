"""Question routing, exam questions and page quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import _col, strip


def route_question(question: Column | str, pattern: str = C.MATH_PATTERN) -> Column:
    """`math` when the pattern occurs, else `theory`."""
    return F.when(_col(question).rlike(pattern), F.lit("math")).otherwise(F.lit("theory"))


def clean_page(text: Column | str, noise: str = r"\A\s*(?:\d+|[-_=*.]+)?\s*\z") -> Column:
    """Lines kept after blank lines, bare page numbers and rules are removed."""
    kept = F.filter(F.split(_col(text), "\n"), lambda x: ~x.rlike(noise))
    return F.array_join(F.transform(kept, strip), "\n")


def page_quality(cleaned: Column | str, raw: Column | str, share: float = C.PAGE_GOOD_SHARE) -> Column:
    """`degraded` when less than the given share of the page is text."""
    ratio = F.length(_col(cleaned)) / F.greatest(F.length(_col(raw)), F.lit(1))
    return F.when(ratio < share, F.lit("degraded")).otherwise(F.lit("good"))


EXAM_SCHEMA = (
    "year int, exam_type string, subject string, question string, choices array<string>, answer_key string"
)


def exam_chunks(questions: DataFrame) -> DataFrame:
    """One chunk per exam question: question and choices as text, the rest as payload."""
    text = F.concat(F.lit("Soru: "), F.col("question"), F.lit("\n\n"), F.array_join("choices", "\n"))
    return questions.select(text.alias("text"), "answer_key", "year", "exam_type", "subject")
