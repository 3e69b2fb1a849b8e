"""Answer checks: weak answers, retries, sources, cited references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import _col, strip, weak_answer
from lectern.functions.vectors import bind


def is_weak(answer: Column | str, phrases: Sequence[str] = C.WEAK_PHRASES) -> Column:
    return weak_answer(answer, C.WEAK_ANSWER_CHARS, phrases)


def needs_retry(
    answer: Column | str,
    attempts: Column | str,
    phrases: Sequence[str] = C.WEAK_PHRASES,
    top_score: Column | None = None,
    low_score: float = C.LOW_SCORE,
) -> Column:
    """Weak and attempts left. With `top_score`, a best hit below `low_score` is accepted without retry."""
    retry = (_col(attempts) < C.MAX_ATTEMPTS) & is_weak(answer, phrases)
    return retry if top_score is None else retry & ~(F.coalesce(top_score, F.lit(0.0)) < low_score)


def fold_attempts(
    df: DataFrame, question: str = "question_id", attempt: str = "attempt", answer: str = "answer",
    phrases: Sequence[str] = C.WEAK_PHRASES,
) -> DataFrame:
    """Final answer per question: the first attempt that needs no retry, attempts counted from 1.

    A question whose attempts so far are all weak and fewer than the maximum has no
    final answer yet: its last attempt is returned with `needs_retry` true.
    """
    return picked(folded_attempts(df, question, attempt, answer, phrases), question)


def folded_attempts(
    df: DataFrame, question: str = "question_id", attempt: str = "attempt", answer: str = "answer",
    phrases: Sequence[str] = C.WEAK_PHRASES,
) -> DataFrame:
    """Batch or streaming: (question, done, last), the first attempt that ends the question and the last one so far."""
    ends = ~needs_retry(answer, attempt, phrases)
    final = F.struct(F.col(attempt).alias("attempts"), F.col(answer).alias("answer"))
    return df.groupBy(question).agg(F.min(F.when(ends, final)).alias("done"), F.max(final).alias("last"))


def picked(folded: DataFrame, question: str) -> DataFrame:
    """Final answers of rows (question, done, last): the ending attempt, else the last one."""
    pick = F.coalesce("done", "last")
    return folded.select(
        question, pick["attempts"].alias("attempts"), pick["answer"].alias("answer"),
        F.col("done").isNull().alias("needs_retry"),
    )


def distinct_sources(sources: Column | str) -> Column:
    """Sorted distinct non-empty sources of an ARRAY<STRING>."""
    kept = F.filter(_col(sources), lambda s: F.coalesce(s, F.lit("")) != "")
    return F.array_sort(F.array_distinct(kept))


def answer_sources(documents: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Per query: sorted distinct sources of its hits; distinct before they meet."""
    pairs = documents.where(F.coalesce(F.col("source"), F.lit("")) != "").select(query_id, "source").distinct()
    return pairs.groupBy(query_id).agg(F.array_sort(F.collect_list("source")).alias("sources"))


def step_preview(documents: Column | str) -> Column:
    """Count and first three sources in place of the documents themselves."""
    docs = _col(documents)
    return F.struct(
        F.coalesce(F.size(docs), F.lit(0)).alias("count"),
        F.coalesce(F.transform(F.slice(docs, 1, 3), lambda d: d["source"]), F.array().cast("array<string>")).alias("preview"),
    )


# --- cited sources -------------------------------------------------------------------


def _source_lines(answer: Column, header: str) -> Column:
    """Stripped, non-empty lines of the sources section, bullets removed."""

    def section(tail: Column) -> Column:
        stop = F.regexp_instr(tail, F.lit(C.NEXT_HEADER))
        return F.when(stop > 0, F.substring(tail, F.lit(1), stop - 1)).otherwise(tail)

    def after(begin: Column) -> Column:
        # the header's own length is read at its place, not searched again
        return F.regexp_replace(F.substring(answer, begin, F.length(answer)), rf"\A(?:{header})", "")

    def lines(begin: Column) -> Column:
        parts = F.split(bind(after(begin), section), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]")
        clean = F.transform(parts, lambda x: strip(F.regexp_replace(strip(x), r"\A[-*•]+", "")))
        return F.when(begin > 0, F.filter(clean, lambda x: x != "")).otherwise(F.array().cast("array<string>"))

    return bind(F.regexp_instr(answer, F.lit(header)), lines)


def _file_names(line: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(C.FILE_NAME_PATTERN), F.lit(1)), F.lower))


def _unlisted_title(line: Column) -> Column:
    """A line without file name, three or more words, a capital in the first one."""
    words = F.split(line, r"(?U)[\s\x1c-\x1f]+")
    return (F.size(words) >= 3) & F.element_at(words, 1).rlike(r"\p{IsUppercase}")


def check_cited_sources(
    df: DataFrame, answer: str = "answer", allowed: str = "allowed", strict_header: bool = False
) -> DataFrame:
    """Add is_clean, academic_refs, unknown_sources and warnings. `allowed` is an ARRAY<STRING>.

    Any author-year reference is suspect; under the sources header, file names outside
    the allowed ones and lines that look like a title are unknown sources.
    """
    header = C.SOURCES_HEADER_STRICT if strict_header else C.SOURCES_HEADER
    text = F.coalesce(F.col(answer), F.lit(""))
    listed = F.transform(F.coalesce(F.col(allowed), F.array().cast("array<string>")), F.lower)
    academic = F.regexp_extract_all(text, F.lit(C.ACADEMIC_PATTERN), F.lit(0))

    def unknown_of(line):
        title = F.when(_unlisted_title(line), F.array(F.substring(line, 1, 80))).otherwise(F.array().cast("array<string>"))
        return bind(
            _file_names(line),
            lambda names: F.when(F.size(names) == 0, title).otherwise(F.array_except(names, F.col("__allowed"))),
        )

    def warning(name, found):
        head = F.array_join(F.slice(found, 1, 3), ", ")
        more = F.when(F.size(found) > 3, F.lit(" ...")).otherwise(F.lit(""))
        return F.when(F.size(found) > 0, F.concat(F.lit(f"{name} ("), F.size(found).cast("string"), F.lit("): "), head, more))

    marked = (
        df.withColumn("__allowed", F.array_distinct(listed))
        .withColumn("academic_refs", academic)
        .withColumn("__lines", _source_lines(text, header))
        .withColumn("unknown_sources", F.flatten(F.transform("__lines", unknown_of)))
    )
    notes = F.array(warning("academic references", F.col("academic_refs")), warning("unknown sources", F.col("unknown_sources")))
    return (
        marked.withColumn("warnings", F.filter(notes, lambda w: w.isNotNull()))
        .withColumn("is_clean", F.size("warnings") == 0)
        .drop("__allowed", "__lines")
    )


def unknown_citations(citations: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """The same rule as a join: cited (key, name) rows without an allowed (key, name) row, case-folded."""
    cited = citations.withColumn("__name", F.lower("name"))
    known = allowed.select(key, F.lower("name").alias("__name")).distinct()
    return cited.join(known, [key, "__name"], "left_anti").drop("__name")
