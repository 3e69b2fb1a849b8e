"""Packing tokenised documents into few sequences of bounded length: best-two-fit.

Method: sequences are filled one at a time, longest fitting piece first; then the smallest piece of the sequence is replaced by
two unpacked pieces if those fill the gap it leaves more tightly. Which piece is taken depends on its length only, so the
fill is planned on the count of pieces per length (at most `capacity` numbers, whatever the input). A sequence that is
filled once is filled alike as long as its lengths last: such repeats are planned at once. Every step leaves some length with
fewer pieces than the step used of it, which bounds the steps by the sum of capacity / length, and with it the plan that is
broadcast. Spark ranks the pieces of each length, in buckets so that no length meets in one task, and each piece finds its
sequence and offset from its rank.

Odd input: a null or empty text is one piece that holds only the end id; repeated rows are packed each; rows without doc_id are
packed too; only documents longer than the capacity are cut, the last piece of one may be shorter; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.tables import read_table, saved
from lectern.llm.word_ids import WordTable, units
from lectern.llm.words import slices, words_of

CAPACITY = 2048
END_ID = 0
#: Pieces ranked together.
BUCKET_ROWS = 200_000


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, pieces per length) of every kind of sequence; counts: pieces per length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = []
    while left.any():
        free, used = capacity, {}
        here = left.copy()
        while free > 0 and len(fits := np.flatnonzero(here[: free + 1])):
            length = int(fits[-1])
            take = int(min(here[length], free // length))
            used[length] = used.get(length, 0) + take
            here[length] -= take
            free -= take * length
        if free and sum(used.values()) > 1:
            least = min(used)
            here[least] += 1
            pair = _pair(here, free + least)
            if sum(pair) > least:
                for length, change in ((least, -1), (pair[0], 1), (pair[1], 1)):
                    used[length] = used.get(length, 0) + change
        used = {length: n for length, n in used.items() if n}
        repeats = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= repeats * n
        plan.append((repeats, used))
    return plan


def _pair(here: np.ndarray, gap: int) -> tuple[int, int]:
    """Two available lengths with the largest sum of at most gap; (0, 0) if there is no pair."""
    present = here[: gap + 1] > 0
    below = np.maximum.accumulate(np.where(present, np.arange(gap + 1), 0))
    longer = np.flatnonzero(present)
    if not len(longer):
        return 0, 0
    limit = np.minimum(gap - longer, np.where(here[longer] > 1, longer, longer - 1))
    shorter = np.where(limit > 0, below[np.maximum(limit, 0)], 0)
    total = np.where(shorter > 0, shorter + longer, 0)
    best = int(total.argmax())
    return (int(shorter[best]), int(longer[best])) if total[best] else (0, 0)


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Per length rows of (first rank, pieces in a sequence, first sequence, offset), by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranked: dict[int, int] = {}
    sequence = 0
    for repeats, used in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.setdefault(length, []).append((ranked.get(length, 0), used[length], sequence, offset))
            ranked[length] = ranked.get(length, 0) + repeats * used[length]
            offset += length * used[length]
        sequence += repeats
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def _tokenized(path: str | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(path)
        for batch in slices(batches):
            words = units(words_of(batch.column("text")))
            packed = words.packed().dictionary_encode()
            known = table.slots(packed.dictionary.to_pylist())
            slot = known[packed.indices.to_numpy(zero_copy_only=False)] if len(words.start) else np.empty(0, np.int64)
            size = table.size[slot] if len(slot) else np.empty(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(size)])
            first = ends[words.first] + np.arange(len(words.first))
            out = np.full(int(first[-1]), END_ID, dtype="<u4")
            if len(slot):
                where = np.arange(ends[-1])
                source = np.repeat(table.begin[slot] - ends[:-1], size) + where
                out[where + np.repeat(words.row_of(), size)] = table.flat[source]
            rows = [(k, p, at - lo, min(capacity, hi - at), zlib.crc32(out[at : min(at + capacity, hi)])) for k, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())) for p, at in enumerate(range(lo, hi, capacity))]
            row, piece, start, length, crc = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def tokenized_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, cut only where it is longer than the capacity."""
    return docs.select("doc_id", "text").mapInArrow(_tokenized(path, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """pieces with __rank: 0, 1, ... within each length."""
    buckets = max(1, rows // BUCKET_ROWS)
    spread = pieces.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = spread.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    within = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = spread.withColumn("__row", F.row_number().over(within).cast("long"))
    return ranked.join(counts, ["length", "__bucket"]).withColumn("__rank", F.col("__before") + F.col("__row") - 1).drop("__bucket", "__before", "__row")


def _assigned(places, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("__rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                rows = places.value[int(value)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                past = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + past // row[:, 1]
                offset[at] = row[:, 3] + past % row[:, 1] * value
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset; pieces must be a written table."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_two_fit(counts, capacity)
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan))
    names = pieces.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return _ranked(pieces, sum(counts.values())).select(*names, "__rank").mapInArrow(_assigned(places, names), schema)


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(saved(tokenized_pieces(docs, path, capacity), "pieces"), capacity)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packing plan of every document."""
    return packed_documents(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read_table(spark, sf_dir, "documents"))
