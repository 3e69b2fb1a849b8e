"""Curriculum table, quotas and prompt texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern import constants as C

# wording is a parameter; the placeholders are grade, subject, count and topics
PROMPT = (
    "%1$d. sınıf %2$s dersi için %3$d soru-cevap çifti yaz.\n"
    "Konular: %4$s\n"
    'Yalnızca JSON dizisi döndür: [{"instruction": "...", "output": "..."}]'
)


def curriculum_map(spark: SparkSession, curriculum: dict | None = None) -> DataFrame:
    """The nested curriculum as one row per subject with a grade -> topics map."""
    rows = [(s, dict(g)) for s, g in (curriculum or C.CURRICULUM).items()]
    return spark.createDataFrame(rows, "subject string, grades map<int,array<string>>")


def explode_curriculum(nested: DataFrame) -> DataFrame:
    return nested.select("subject", F.explode("grades").alias("grade", "topics"))


def with_quota(plan: DataFrame, target: int) -> DataFrame:
    """Rows wanted per (subject, grade): the target shared by the subject's grades, at least 5."""
    grades = F.count("*").over(Window.partitionBy("subject"))
    share = F.floor(F.lit(target) / grades).cast("bigint")
    return plan.withColumn("quota", F.greatest(F.lit(C.MIN_QUOTA).cast("bigint"), share))


def prompts(plan: DataFrame, template: str = PROMPT) -> DataFrame:
    """Add `prompt`; a (subject, grade) without topics is skipped."""
    text = F.format_string(
        template, F.col("grade").cast("int"), F.col("subject"), F.col("quota"), F.array_join("topics", ", ")
    )
    return plan.where(F.size("topics") > 0).withColumn("prompt", text)


def mock_records(plan: DataFrame, per_cell: int = 6) -> DataFrame:
    """Numbered stand-in records for every (subject, grade) of a plan."""
    numbered = plan.select("subject", "grade", F.explode(F.sequence(F.lit(0), F.lit(per_cell - 1))).alias("i"))
    return numbered.select(
        F.format_string("%s, %d. sınıf için deneme sorusu no. %d", "subject", "grade", "i").alias("instruction"),
        F.lit("").alias("input"),
        F.format_string("%s, %d. sınıf: bu metin yalnızca akışı denemek içindir.", "subject", "grade").alias("output"),
        "subject",
        "grade",
    )
