"""The test tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.ordered import running_totals
from lectern.operators.sessions import conversation_pairs

SUBJECTS = ("matematik", "fizik", "kimya", "biyoloji", "tarih", "cografya", "felsefe", "edebiyat", "ingilizce")
KEYWORDS = (
    "the", "and", "tion", "eau", "sch", "ung", "que", "ent",
    "ing", "los", "der", "con", "est", "ier", "ich", "than",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("rec_id"), "text", "lang", "source")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a one-page text file named by its source."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.concat("source", F.lit(".txt")).alias("source"),
        F.lit(0).alias("page_num"), "text", F.col("lang").alias("subject"),
    )


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a document with one page per turn."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("file_id"),
        F.concat(F.lit("konusma_"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("source"),
        (F.col("turn") + 1).cast("int").alias("page_num"), "text",
        F.when(F.col("conv_id") % 2 == 0, F.lit("tarih")).otherwise(F.lit("fizik")).alias("subject"),
    )


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = conversation_pairs(table(spark, sf_dir, "conversations"))
    subject = F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), (F.col("conv_id") % 9 + 1).cast("int"))
    return pairs.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rec_id"),
        F.col("question").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("output"),
        subject.alias("subject"),
        (9 + F.floor(F.col("conv_id") / 9) % 4).cast("int").alias("grade"),
    )


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: language for subject, four grades; their exact copies repeat keys."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("rec_id"), F.col("text").alias("instruction"), F.col("text").alias("output"),
        F.col("lang").alias("subject"), (9 + F.col("doc_id") % 4).cast("int").alias("grade"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of a conversation as numbered answer attempts."""
    users = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    numbered = running_totals(users, "turn", {"attempt": F.lit(1).cast("bigint")}, group=["conv_id"])
    return numbered.select(F.col("conv_id").alias("question_id"), "attempt", F.col("text").alias("answer"))


def question_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("session_id"), F.col("event_type").alias("subject"), "ts"
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"),
        F.concat(F.lit("s"), F.col("label").cast("string")).alias("subject"),
    )


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector per label; a label's rows are reduced map-side per dimension."""
    cells = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda c: c["m"]).alias("vector")).select(
        F.col("label").cast("bigint").alias("query_id"), "vector",
        F.concat(F.lit("s"), F.col("label").cast("string")).alias("subject"),
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.when(F.col("page_id") % 10 == 0, F.lit(".exe")).when(F.col("page_id") % 10 == 1, F.lit(".PDF")).otherwise(F.lit(".txt"))
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("file_id"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), suffix).alias("source"),
        F.col("html").alias("text"), F.lit("genel").alias("subject"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    subject = F.element_at(
        F.array(*[F.lit(s) for s in ("tarih", "fizik", "genel", "coğrafya")]), (F.col("conv_id") % 4 + 1).cast("int")
    )
    return users.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rec_id"), F.col("text").alias("question"),
        subject.alias("subject"), (F.col("conv_id") % 14).cast("int").alias("grade_level"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as search queries; `it` has no material, every fifth asks everywhere."""
    choice = F.element_at(
        F.array(*[F.lit(s) for s in ("", "en", "fr", "it", "de")]), (F.col("item_id") % 5 + 1).cast("int")
    )
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text", choice.alias("subject"))


def cited_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("doc_id") % 3
    extra = F.when(third == 0, F.lit("- uydurma.txt")).when(third == 1, F.lit("- Ekinci, A. (2001). Göçmen kuşlar")).otherwise(F.lit(""))
    own = F.concat("source", F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("rec_id"),
        F.concat("text", F.lit("\n\n## Kaynaklar:\n- "), own, F.lit("\n"), extra).alias("answer"),
        F.array(own).alias("allowed"),
    )


def answer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold answers with two arms over whole texts: its halves swapped, and the question with two of three of its words."""
    # scores cost far more than the bytes of their texts, by which adaptive plans would fold rows into few tasks
    rows = qa(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "rec_id")
    n = F.col("rec_id")
    words = F.split("output", " ")
    half = F.floor(F.size(words) / 2).cast("int")
    swapped = F.concat(F.slice(words, half + 1, F.size(words)), F.slice(words, F.lit(1), half))
    return rows.select(
        "rec_id", "subject", "grade", F.col("instruction").alias("question"), F.col("output").alias("gold"),
        F.array_join(swapped, " ").alias("a_answer"),
        F.concat("instruction", F.lit(" "), F.array_join(F.filter(words, lambda _, i: i % 3 != 2), " ")).alias("b_answer"),
        F.when(n % 17 == 0, F.lit("timeout")).otherwise(F.lit("")).alias("a_error"),
        F.length("instruction").cast("bigint").alias("a_input_tokens"),
        F.length("output").cast("bigint").alias("a_output_tokens"),
        ((n % 100) / 100).alias("b_confidence"), (n % 3 + 1).cast("bigint").alias("b_attempts"),
    )
