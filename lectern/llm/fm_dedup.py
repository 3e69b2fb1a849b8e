"""Substring dedup: words covered by a window of 50 words that also starts in a document with a smaller doc_id go.

Method: a compressed full-text index per shard (`fm_index.FmIndex`); texts are streamed past it by backward search over its
wavelet tree, and places whose match reaches the window length are reported with the smallest document that holds it.

So that a shard need not meet every document, text is routed by content. Every window names one of its 10-word runs, the one
with the smallest hash, as its anchor: equal windows name equal anchors at equal places. The windows of a document that share
an anchor form one segment (50 to 90 words). Anchors that only one document has are dropped; of equal segments, one is kept
with its smallest doc_id. All segments of an anchor go to one shard, so equal windows always meet. An anchor with more than
`CAP` different segments would make a shard too large; its windows are compared exactly by their own keys instead
(an aggregation that combines before the shuffle), which loses none.

Results for odd input: a null or empty text has no words and loses none; a row without doc_id takes no part and is returned as
it is; rows with one doc_id and one text are treated alike, rows with one doc_id and different texts each by its own text; a
table without rows gives none; further columns pass through under any name that does not begin with two underscores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.fm_index import FmIndex
from lectern.llm.tables import read_table, saved
from lectern.llm.words import mix, run_hashes, slices, words_of

WINDOW = 50
ANCHOR = 10
#: Different segments of one anchor that go to a full-text index; beyond, windows are grouped by key.
CAP = 2000
#: Segments in a shard on average.
SHARD = 4000
RUNS = "array<struct<a:int,b:int,m:bigint>>"


def _smallest_at(values: np.ndarray, width: int) -> np.ndarray:
    """For every i the leftmost place of the smallest of values[i:i + width]."""

    def merge(best: np.ndarray, shift: int) -> np.ndarray:
        left, right = best[: len(best) - shift], best[shift:]
        return np.where(values[left] <= values[right], left, right)

    best, covered = np.arange(len(values)), 1
    while covered * 2 <= width:
        best, covered = merge(best, covered), covered * 2
    return merge(best, width - covered) if covered < width else best


def segments_of(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """(row, anchor hash, segment hash, first window's start, number of windows) of every segment."""
    size = np.diff(first)
    if len(hashes) < window or not (size >= window).any():
        return None
    grams = run_hashes(hashes, np.arange(len(hashes) - anchor + 1), np.arange(anchor, len(hashes) + 1))
    best = _smallest_at(grams, window - anchor + 1)
    row = np.repeat(np.arange(len(size)), np.maximum(size - window + 1, 0))
    count = np.maximum(size - window + 1, 0)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    chosen = best[start]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    many = np.diff(np.append(at, len(row)))
    begin, place = start[at], chosen[at]
    content = run_hashes(hashes, begin, begin + many + window - 1) ^ mix((place - begin).astype(np.uint64))
    return row[at], grams[place], content, begin - first[row[at]], many


def _segment_rows(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            found = segments_of(words.hashes(), words.first, window, anchor)
            if found is None:
                continue
            row, key, content, begin, many = found
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), batch.column("doc_id").take(pick), batch.column("__v").take(pick), pa.array(begin.astype(np.int32)), pa.array(many.astype(np.int32))],
                ["anchor", "seg", "doc_id", "__v", "at", "n"],
            )

    return run


def _bodies(window: int):
    """The words of the wanted segments, cut from their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            wanted = batch.column("__wanted")
            flat = wanted.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            begin = words.first[row] + flat.field("at").to_numpy()
            last = begin + flat.field("n").to_numpy() + window - 2
            body = [words.data[s:e].tobytes() for s, e in zip(words.start[begin], words.end[last])]
            yield pa.RecordBatch.from_arrays(
                [flat.field("anchor"), flat.field("seg"), flat.field("n"), flat.field("kinds"), batch.column("doc_id").take(pa.array(row)), pa.array(body, pa.binary()).cast(pa.string())],
                ["anchor", "seg", "n", "kinds", "doc_id", "body"],
            )

    return run


def _runs(holder: np.ndarray, first: np.ndarray, count: np.ndarray) -> pa.Array:
    """Per segment the stretches of windows with one smallest holder."""
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    value = holder[first[row] + offset]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(row))
    item = pa.StructArray.from_arrays([pa.array(offset[at].astype(np.int32)), pa.array(offset[end - 1].astype(np.int32)), pa.array(value[at])], ["a", "b", "m"])
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[at], minlength=len(count)))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), item)


def _search_shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        words = words_of(table.column("body").combine_chunks())
        codes = words.hashes()
        holder = table.column("doc_id").to_numpy().astype(np.int64)
        index = FmIndex(codes, words.first, holder, window)
        _, smallest = index.matches(codes, words.first)
        runs = _runs(smallest, words.first[:-1], table.column("n").to_numpy().astype(np.int64))
        return pa.Table.from_arrays([table.column("anchor"), table.column("seg"), pa.chunked_array([runs])], ["anchor", "seg", "runs"])

    return run


def _window_keys(window: int):
    """Every window of a segment with a 128-bit key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            words = words_of(batch.column("body"))
            codes, count = words.hashes(), batch.column("n").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), count)
            j = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = words.first[row] + j
            keys = [run_hashes(c, start, start + window).view(np.int64) for c in (codes, mix(~codes))]
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor").take(pick), batch.column("seg").take(pick), pa.array(j.astype(np.int32)), pa.array(keys[0]), pa.array(keys[1]), batch.column("doc_id").take(pick)],
                ["anchor", "seg", "j", "k1", "k2", "doc_id"],
            )

    return run


def _crowded(bodies: DataFrame, window: int) -> DataFrame:
    """Runs of the segments of crowded anchors: windows grouped by key."""
    windows = bodies.mapInArrow(_window_keys(window), "anchor long, seg long, j int, k1 long, k2 long, doc_id long")
    keys = ["anchor", "k1", "k2"]
    least = windows.groupBy(*keys).agg(F.min("doc_id").alias("m"))
    runs = F.transform(F.array_sort(F.collect_set(F.struct("j", "m"))), lambda x: F.struct(x["j"].alias("a"), x["j"].alias("b"), x["m"].alias("m")))
    return windows.drop("doc_id").join(least, keys).groupBy("anchor", "seg").agg(runs.alias("runs"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, cap: int = CAP, shard: int = SHARD) -> DataFrame:
    """(doc_id, __v, __spans): word ranges of each text that a document with a smaller doc_id also has.

    docs: doc_id, text, __v (a hash of the text, which tells rows with one doc_id apart).
    """
    found = docs.filter(F.col("doc_id").isNotNull()).mapInArrow(_segment_rows(window, anchor), "anchor long, seg long, doc_id long, __v int, at int, n int")
    found = saved(found, "segments")
    kinds = found.groupBy("anchor", "seg").agg(F.min(F.struct("doc_id", "at", "n", "__v")).alias("f"), F.max("doc_id").alias("last"))
    anchors = kinds.groupBy("anchor").agg(F.min("f.doc_id").alias("lo"), F.max("last").alias("hi"), F.count(F.lit(1)).alias("kinds"))
    shared = saved(kinds.join(anchors.filter("lo < hi").select("anchor", "kinds"), "anchor").select("anchor", "seg", "kinds", "f.*"), "shared")
    alone = shared.filter("kinds = 1").select("anchor", "seg", F.array(F.struct(F.lit(0).alias("a"), (F.col("n") - 1).alias("b"), F.col("doc_id").alias("m"))).alias("runs"))
    several = shared.filter("kinds > 1")
    wanted = several.groupBy("doc_id", "__v").agg(F.collect_list(F.struct("anchor", "seg", "at", "n", "kinds")).alias("__wanted"))
    bodies = docs.join(wanted.hint("shuffle_hash"), ["doc_id", "__v"]).mapInArrow(_bodies(window), "anchor long, seg long, n int, kinds long, doc_id long, body string")
    bodies = saved(bodies.dropDuplicates(["anchor", "seg"]), "bodies")
    few = bodies.filter(F.col("kinds") <= cap)
    shards = max(1, few.count() // shard)
    spread = few.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    indexed = spread.groupBy("shard").applyInArrow(_search_shard(window), f"anchor long, seg long, runs {RUNS}")
    runs = alone.unionByName(indexed).unionByName(_crowded(bodies.filter(F.col("kinds") > cap), window))
    hits = found.join(runs, ["anchor", "seg"]).select("doc_id", "__v", "at", F.explode(F.filter("runs", lambda r: r["m"] < F.col("doc_id"))).alias("r"))
    span = F.struct((F.col("at") + F.col("r.a")).alias("s"), (F.col("at") + F.col("r.b") + window).alias("e"))
    return hits.groupBy("doc_id", "__v").agg(F.collect_set(span).alias("__spans"))


def _cut(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, spans = batch.column("text").to_pylist(), batch.column("__spans")
            bounds = spans.offsets.to_numpy()
            flat = spans.flatten()
            starts, ends = flat.field("s").to_numpy() if len(flat) else np.empty(0, int), flat.field("e").to_numpy() if len(flat) else np.empty(0, int)
            bounds = bounds - bounds[0]
            out, words, removed, digest = [], [], [], []
            for k, text in enumerate(texts):
                parts = (text or "").encode().split()
                lo, hi = bounds[k], bounds[k + 1]
                gone = 0
                if hi > lo:
                    step = np.zeros(len(parts) + 1, dtype=np.int64)
                    np.add.at(step, starts[lo:hi], 1)
                    np.add.at(step, ends[lo:hi], -1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone = len(parts) - int(keep.sum())
                words.append(len(parts))
                removed.append(gone)
                kept = b" ".join(compress(parts, keep) if gone else parts)
                digest.append(hashlib.sha256(kept).hexdigest())
                out.append(kept.decode() if gone else text)
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(out, pa.string()), "__words": pa.array(words, pa.int64()), "__removed": pa.array(removed, pa.int64()), "__sha": pa.array(digest, pa.string())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, cap: int = CAP, shard: int = SHARD) -> DataFrame:
    """docs with the repeated words gone from `text`, and __words, __removed, __sha (of the kept words joined by one space).

    A text that loses words becomes its kept words joined by one space; any other text stays as it is.
    """
    marked = docs.withColumn("__v", F.hash("text"))
    spans = repeated_spans(marked.select("doc_id", "text", "__v"), window, anchor, cap, shard)
    joined = marked.join(spans.hint("shuffle_hash"), ["doc_id", "__v"], "left").select(*docs.columns, F.coalesce("__spans", F.array().cast("array<struct<s:int,e:int>>")).alias("__spans"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", __words long, __removed long, __sha string"
    return joined.mapInArrow(_cut(docs.columns), schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, without its repeated words; n_chars follows the text."""
    out = remove_repeats(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", F.col("__words").alias("n_words"), F.col("__removed").alias("n_removed"), F.col("__sha").alias("kept_sha256"))
