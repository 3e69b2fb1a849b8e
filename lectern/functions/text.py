"""Text expressions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.constants import (
    CONTEXT_LABEL, NO_CONTEXT_NOTE, POINT_NAMESPACE, QUESTION_LABEL, RECORD_ANSWER_LABEL, RECORD_QUESTION_LABEL, WEAK_PHRASES,
)

# Unicode white space plus the four separators U+001C..U+001F
_SPACE = r"[\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c: Column | str) -> Column:
    """Lowercase, white-space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), rf"(?U){_SPACE}+", " "))


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(_col(c), rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def is_blank(c: Column | str) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_col(path), r"([^/]*)\z", 1)


def file_stem(path: Column | str) -> Column:
    name = base_name(path)
    return F.when(name.rlike(r"(?s)\A.+\.[^.]+\z"), F.regexp_extract(name, r"(?s)\A(.+)\.[^.]+\z", 1)).otherwise(name)


def file_suffix(path: Column | str) -> Column:
    """Last suffix with its dot, lowercased; empty when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"(?s)\A.+(\.[^.]+)\z", 1))


def preview(c: Column | str, n: int) -> Column:
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def query_prefix(model: Column | str) -> Column:
    return F.when(F.lower(_col(model)).contains("e5"), F.lit("query: ")).otherwise(F.lit(""))


def passage_prefix(model: Column | str) -> Column:
    return F.when(F.lower(_col(model)).contains("e5"), F.lit("passage: ")).otherwise(F.lit(""))


def user_message(question: Column | str, context: Column | str) -> Column:
    question, context = _col(question), _col(context)
    asked = F.concat(F.lit(QUESTION_LABEL), question)
    bare = F.concat(asked, F.lit("\n\n" + NO_CONTEXT_NOTE))
    full = F.concat(F.lit(CONTEXT_LABEL), context, F.lit("\n\n"), asked)
    return F.when(F.coalesce(context, F.lit("")) != "", full).otherwise(bare)


def chat_messages(instruction: Column | str, output: Column | str) -> Column:
    def turn(role, text):
        return F.struct(F.lit(role).alias("role"), _col(text).alias("content"))

    return F.array(turn("user", instruction), turn("assistant", output))


def retrieval_text(instruction: Column | str, output: Column | str) -> Column:
    return F.concat(F.lit(RECORD_QUESTION_LABEL), _col(instruction), F.lit("\n\n" + RECORD_ANSWER_LABEL), _col(output))


def document_id(stem: Column | str, content: Column | str) -> Column:
    return F.concat(_col(stem), F.lit("_"), F.substring(F.sha2(_col(content), 256), 1, 16))


def point_id(doc_id: Column | str, chunk_index: Column | str) -> Column:
    """Version-5 UUID of `doc_id:chunk_index` in the fixed namespace."""
    name = F.concat(_col(doc_id), F.lit(":"), _col(chunk_index).cast("string"))
    digest = F.sha1(F.concat(F.unhex(F.lit(POINT_NAMESPACE.replace("-", ""))), F.encode(name, "utf-8")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(nibble)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def weak_answer(answer: Column | str, min_chars: int, phrases=WEAK_PHRASES) -> Column:
    answer = F.coalesce(_col(answer), F.lit(""))
    lowered = F.lower(answer)
    weak = F.length(answer) < min_chars
    for phrase in phrases:
        weak = weak | lowered.contains(phrase)
    return weak


def estimated_tokens(c: Column | str) -> Column:
    """Word pieces: letter runs cut at four letters, digit runs, single other marks."""
    return F.size(F.regexp_extract_all(_col(c), F.lit(r"(\p{L}{1,4}|\p{N}+|[^\p{L}\p{N}\s])"), F.lit(1)))


def whole_millis(seconds: Column | str) -> Column:
    """Seconds to whole milliseconds, the rest cut off."""
    return (_col(seconds) * 1000).cast("bigint")


def seeded_hash(seed: int, row_id: Column | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(row_id).cast("string")))
