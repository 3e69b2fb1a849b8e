"""Line dedup by overlapping windows of three lines.

Method: every three consecutive lines are hashed to a 128-bit key; a key that stands in more than one place keeps its first
occurrence, by (doc_id, line number); of every later one, the three lines go. Overlapping windows merge: a line goes if any
later occurrence covers it. Windows are judged on the input, not on what is left. Only keys and line numbers are shuffled;
counting and the first place combine before the shuffle, so a window that a third of the rows hold stays cheap.

Odd input: lines are what stands between line feeds, so a null or empty text has one empty line and loses none; texts with
fewer than three lines lose none; a row without doc_id takes no part and is returned as it is; rows that share a doc_id count
as one document, whose windows stand in the same place if their texts are equal; an empty table gives no rows; further columns pass through under any
name that does not begin with two underscores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.tables import read_table
from lectern.llm.words import slices

WINDOW = 3


def window_keys(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, __v, pos, key) of every window; pos counts lines from 0."""
    lines = docs.select("doc_id", "__v", F.transform(F.split("text", "\n"), F.md5).alias("h")).filter(F.size("h") >= window)
    keys = F.transform(F.sequence(F.lit(1), F.size("h") - window + 1), lambda i: F.unhex(F.md5(F.array_join(F.slice("h", i, window), ""))))
    return lines.select("doc_id", "__v", F.posexplode(keys).alias("pos", "key"))


def later_places(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, __v, __later): first lines of the windows that an earlier place also has."""
    keys = window_keys(docs.filter(F.col("doc_id").isNotNull()), window)
    first = keys.groupBy("key").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    later = keys.join(first.filter("n > 1").select("key", "first"), "key").filter(F.struct("doc_id", "pos") > F.col("first"))
    return later.groupBy("doc_id", "__v").agg(F.collect_set("pos").alias("__later"))


def _cut(names: list[str], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out, count, removed, digest = [], [], [], []
            for text, later in zip(batch.column("text").to_pylist(), batch.column("__later").to_pylist()):
                lines = (text or "").split("\n")
                gone = {p + k for p in later for k in range(window)}
                kept = "\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else text
                out.append(kept)
                count.append(len(lines))
                removed.append(len(gone))
                digest.append(hashlib.sha256((kept or "").encode()).hexdigest())
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(out, pa.string()), "__lines": pa.array(count, pa.int64()), "__removed": pa.array(removed, pa.int64()), "__sha": pa.array(digest, pa.string())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the covered lines gone from `text`, and __lines, __removed, __sha (of the new text)."""
    marked = docs.withColumn("__v", F.hash("text"))
    later = later_places(marked.select("doc_id", "text", "__v"), window)
    joined = marked.join(later.hint("shuffle_hash"), ["doc_id", "__v"], "left").select(*docs.columns, F.coalesce("__later", F.array().cast("array<int>")).alias("__later"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", __lines long, __removed long, __sha string"
    return joined.mapInArrow(_cut(docs.columns, window), schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, without its repeated lines; n_chars follows the text."""
    out = remove_repeated_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs).select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.col("__sha").alias("kept_sha256"))


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
numbered AS (
  SELECT doc_id, pos, line, lead(line, 1) OVER w AS second, lead(line, 2) OVER w AS third, lead(pos, 2) OVER w AS last
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, pos) AS place FROM numbered WHERE last IS NOT NULL),
covered AS (SELECT DISTINCT doc_id, pos + k AS pos FROM windows, (SELECT unnest([0, 1, 2]) AS k) AS step WHERE place > 1)
SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN c.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '')) AS kept_sha256
FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
"""
