"""Exact ranked lexical search: sparse ball trees over document vectors, searched best-first by inner-product bounds.

Score of a document for an item: the sum over the item's terms of w * ((1000000000 * tf) div (1000 * tf + 8 * m)), all whole
numbers. With y[t] = w[t] * (...) as a document's vector, the score is the inner product of y with the 0/1 vector q of the item.

Method: one pass turns texts into sparse counts of the items' terms and document lengths; a second aggregates the statistics.
Each task gathers documents into trees of at most `TREE` documents: a node holds a whole-number centroid c, a radius r that no
document's distance exceeds, and a radius per term, and is halved between its two far ends. <q, y> is at most <q, c> + |q| * r, and
at most the sum of c[t] + r[t] over the item's terms; the search takes the smaller. Sums of whole numbers below 2**53 are exact, and r and
its product are rounded up, so both bounds are safe. A search opens nodes by descending bound and stops when the best bound
is below the k-th score; leaves are scored in 64-bit whole numbers. The trees are searched twice: first two
leaves per item and tree, whose scores give every item a proven k-th score over the whole table; then all trees against it.

Bounds: the sparse counts are written once. A tree is several times as large as its documents' counts, so each search grows its
trees anew and no tree is ever a row: it lives in the Python worker of one task, one tree at a time. Items pass in
blocks of at most `BLOCK` terms, which bounds what is broadcast. What leaves a task is at most k rows an item.

Odd input: null and empty texts, and texts without a term, count nowhere and are never found; an item without terms finds
nothing; rows with one item_id (null is one too) are one item with the terms of all; every row of documents is a document of its
own, repeated ones too; equal scores rank by doc_id, null last; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.lexicon import expanded
from lectern.llm.tables import read_table, saved
from lectern.llm.words import BYTE_CODE, run_hashes, slices, words_of

#: A term: ASCII letters and digits, and every character beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_TERM = np.ones(256, dtype=bool)
NO_TERM[128:] = NO_TERM[48:58] = NO_TERM[65:91] = NO_TERM[97:123] = False
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 10
#: Documents of a tree, and of a leaf.
TREE = 2048
LEAF = 16
#: (item, term) pairs handled together.
BLOCK = 20_000
#: Leaves that the first search opens per item and tree.
FIRST_LEAVES = 2
#: Relative slack of radii and bounds, far above the error of sums of this length in doubles.
SLACK = 1e-9
VECTORS = "doc_id long, n long, term array<int>, tf array<int>"
FOUND = "item int, doc_id long, score long"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item."""
    text = F.translate("text", UPPER, LOWER)
    return items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term")).distinct()


class Vocabulary:
    """Terms by hash; a hit is confirmed on the bytes."""

    def __init__(self, terms: list[bytes]):
        packed = words_of(pa.array([t.decode() for t in terms], pa.large_string()), apart=NO_TERM)
        hashes = packed.hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms share a hash")
        self.terms = pa.array(terms, pa.large_binary())

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words per text, text of every hit, its term)."""
        words = words_of(texts, lower=True, apart=NO_TERM)
        count = np.diff(words.first)
        if not len(self.hashes) or not len(words.start):
            return count, np.empty(0, np.int64), np.empty(0, np.int64)
        hashes = run_hashes(BYTE_CODE[words.data], words.start, words.end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        term = self.order[at[hit]]
        size = words.end[hit] - words.start[hit]
        ends = np.concatenate([[0], np.cumsum(size)])
        body = words.data[expanded(words.start[hit], size)]
        seen = pa.Array.from_buffers(pa.large_binary(), len(hit), [None, pa.py_buffer(ends), pa.py_buffer(body)])
        same = pc.equal(seen, self.terms.take(pa.array(term))).to_numpy(zero_copy_only=False)
        return count, words.row_of()[hit[same]], term[same]


def _vectors(terms: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        for batch in slices(batches):
            count, row, term = vocabulary.places(batch.column("text"))
            pair, tf = np.unique(row * max(len(terms), 1) + term, return_counts=True)
            row, term = np.divmod(pair, max(len(terms), 1))
            first = pa.array(np.searchsorted(row, np.arange(len(count) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(first, pa.array(x, pa.int32())) for x in (term, tf)]
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), *lists], ["doc_id", "n", "term", "tf"])
            yield out.filter(pa.array(count > 0))

    return run


def weights(vectors: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their words, weight of each term)."""
    docs, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(terms, dtype=np.int64)
    for r in vectors.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    w = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df]
    return docs, total, np.array(w, dtype=np.int64)


class Tree:
    """Sparse rows (row i has the entries first[i] .. first[i + 1]) and the balls around them, in preorder.

    Node i covers the rows lo[i] .. hi[i]; its first child is i + 1 and its second child[i]; leaves have child -1. Centroids lie
    by term: c is that of c_node at c_term, and no row there is above c + reach.
    """

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)

    @classmethod
    def grown(cls, doc_id: np.ndarray, first: np.ndarray, term: np.ndarray, y: np.ndarray, terms: int, leaf: int = LEAF) -> Tree:
        size = np.diff(first)
        value = y.astype(np.float64)
        norm = np.bincount(np.repeat(np.arange(len(size)), size), value * value, len(size))
        order = np.arange(len(size))
        lo, hi, child, radius, centre = [], [], [], [], []

        def dots(rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
            at = expanded(first[rows], size[rows])
            return np.bincount(np.repeat(np.arange(len(rows)), size[rows]), value[at] * dense[term[at]], len(rows))

        def dense_row(row: int) -> np.ndarray:
            dense = np.zeros(terms)
            dense[term[first[row] : first[row + 1]]] = value[first[row] : first[row + 1]]
            return dense

        def grow(a: int, b: int) -> None:
            me, rows = len(lo), order[a:b]
            at = expanded(first[rows], size[rows])
            by_term = at[np.argsort(term[at], kind="stable")]
            begin = np.flatnonzero(np.diff(term[by_term], prepend=-1))
            held = term[by_term[begin]]
            mean = np.rint(np.add.reduceat(value[by_term], begin) / len(rows))
            most = np.maximum.reduceat(value[by_term], begin)
            c = np.zeros(terms)
            c[held] = mean
            square = float(mean @ mean)
            apart = np.maximum(norm[rows] - 2 * dots(rows, c) + square, 0.0)
            # the difference may lose digits of its parts, so the slack is relative to them
            far_off = float((apart + SLACK * (norm[rows] + square)).max())
            for column, x in zip((lo, hi, child, radius, centre), (a, b, -1, math.sqrt(far_off) * (1 + SLACK), (held, mean, most - mean))):
                column.append(x)
            if b - a > leaf:
                far = dense_row(rows[int(apart.argmax())])
                other = dense_row(rows[int((norm[rows] - 2 * dots(rows, far)).argmax())])
                order[a:b] = rows[np.argsort(dots(rows, far - other), kind="stable")]
                grow(a, (a + b) // 2)
                child[me] = len(lo)
                grow((a + b) // 2, b)

        if len(size):
            grow(0, len(size))
        held, mean, reach = (np.concatenate([x[i] for x in centre] or [np.empty(0)]) for i in range(3))
        by_term = np.argsort(held, kind="stable")
        at = expanded(first[order], size[order])
        return cls(
            doc_id=doc_id[order],
            first=np.concatenate([[0], np.cumsum(size[order])]),
            term=term[at],
            y=y[at],
            lo=np.array(lo, np.int64),
            hi=np.array(hi, np.int64),
            child=np.array(child, np.int64),
            radius=np.array(radius, np.float64),
            c_term=held[by_term].astype(np.int64),
            c_node=np.repeat(np.arange(len(centre)), [len(t) for t, _, _ in centre])[by_term],
            c=mean[by_term],
            reach=reach[by_term],
        )

    def bounds(self, item: np.ndarray) -> np.ndarray:
        """For every node a number that no row's score exceeds."""
        begin = np.searchsorted(self.c_term, item)
        at = expanded(begin, np.searchsorted(self.c_term, item, side="right") - begin)
        node, c = self.c_node[at], self.c[at]
        ball = np.bincount(node, c, len(self.lo)) + math.sqrt(len(item)) * self.radius * (1 + SLACK)
        return np.minimum(ball * (1 + SLACK) + 1, np.bincount(node, c + self.reach[at], len(self.lo)))

    def search(self, item: np.ndarray, best: list[tuple[int, int]], least: int, most_leaves: int | None = None, k: int = TOP) -> int:
        """Add the rows that beat `least`, and the worst of `best` once it is full, to the heap `best`; returns the leaves opened.

        best: (score, -rank of the row among equal scores, doc_id) with the worst first; a score equal to the k-th is kept for its id.
        """
        if not len(self.lo) or not len(item):
            return 0
        bound = self.bounds(item)
        asked = np.zeros(int(max(self.term.max(initial=0), item.max())) + 1, dtype=bool)
        asked[item] = True
        opened = 0
        queue = [(-float(bound[0]), 0)]
        while queue and opened != most_leaves:
            high, node = heapq.heappop(queue)
            if -high < max(least, best[0][0] if len(best) == k else 1):
                break
            if self.child[node] >= 0:
                for to in (node + 1, int(self.child[node])):
                    heapq.heappush(queue, (-float(bound[to]), to))
                continue
            opened += 1
            a, b = int(self.lo[node]), int(self.hi[node])
            entry = slice(int(self.first[a]), int(self.first[b]))
            sums = np.concatenate([[0], np.cumsum(np.where(asked[self.term[entry]], self.y[entry], 0))])
            at = self.first[a : b + 1] - self.first[a]
            score = sums[at[1:]] - sums[at[:-1]]
            for row in np.flatnonzero(score >= max(least, best[0][0] if len(best) == k else 1)):
                # equal scores: the smaller id is better, null (kept as the largest number) the worst
                entry_of = (int(score[row]), -int(self.doc_id[a + row]))
                if len(best) < k:
                    heapq.heappush(best, entry_of)
                elif entry_of > best[0]:
                    heapq.heapreplace(best, entry_of)
        return opened


NULL_ID = np.iinfo(np.int64).max


def _trees(w: np.ndarray, docs: int, total: int, size: int):
    def grown(rows: pa.Table) -> Tree:
        batch = rows.combine_chunks().to_batches()[0]
        doc_id = batch.column("doc_id").fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)
        lists, tfs = batch.column("term"), batch.column("tf")
        first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        term, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (lists, tfs))
        n = batch.column("n").to_numpy(zero_copy_only=False)
        m = 10 + 90 * n * docs // total
        y = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(first))))
        return Tree.grown(doc_id, first, term, y, len(w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            rows = pa.Table.from_batches([*waiting, batch])
            whole = rows.num_rows - rows.num_rows % size
            for at in range(0, whole, size):
                yield grown(rows.slice(at, size))
            waiting = rows.slice(whole).to_batches()
        if sum(b.num_rows for b in waiting):
            yield grown(pa.Table.from_batches(waiting))

    return run


def _search(trees: Callable[[Iterator[pa.RecordBatch]], Iterator[Tree]], items: list[np.ndarray], least: list[int], most_leaves: int | None, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        for tree in trees(batches):
            for item, heap, floor in zip(items, best, least):
                tree.search(item, heap, floor, most_leaves, k)
        rows = [(i, -d, s) for i, heap in enumerate(best) for s, d in heap]
        item, doc, score = zip(*rows) if rows else ((), (), ())
        doc = [None if d == NULL_ID else d for d in doc]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return run


def search_trees(
    vectors: DataFrame, w: np.ndarray, docs: int, total: int, items: list[np.ndarray], k: int = TOP, tree: int = TREE, first_leaves: int = FIRST_LEAVES
) -> DataFrame:
    """(item, rank, doc_id, score) of the k best documents of every item; items: the term numbers of each.

    The trees are over the documents that hold any of the terms; a task grows and searches one at a time.
    """
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    held = vectors.filter(F.size("term") > 0)

    def ranked(least: list[int], most_leaves: int | None) -> DataFrame:
        found = held.mapInArrow(_search(_trees(w, docs, total, tree), items, least, most_leaves, k), FOUND)
        return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)

    proven = {r["item"]: r["score"] for r in ranked([1] * len(items), first_leaves).filter(F.col("rank") == k).select("item", "score").collect()}
    return ranked([proven.get(i, 1) for i in range(len(items))], None)


def top_documents(docs: DataFrame, items: DataFrame, k: int = TOP, tree: int = TREE, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    pairs = saved(item_terms(items), "item-terms")
    blocks = -(-pairs.count() // block)
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        here = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        terms = sorted({r["term"].encode() for r in here})
        number = {t: i for i, t in enumerate(terms)}
        listed: dict[int | None, list[int]] = {}
        for r in here:
            listed.setdefault(r["item_id"], []).append(number[r["term"].encode()])
        vectors = saved(docs.select("doc_id", "text").mapInArrow(_vectors(terms), VECTORS), "vectors")
        docs_n, total, w = weights(vectors, len(terms))
        if not docs_n:
            continue
        found = search_trees(vectors, w, docs_n, total, [np.array(sorted(t), np.int64) for t in listed.values()], k, tree)
        names = spark.createDataFrame([(i, item) for i, item in enumerate(listed)], f"item int, {schema.split(',')[0]}")
        out = out.unionByName(found.join(names, "item").select("item_id", "rank", F.col("doc_id"), "score"))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL = rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents
), sized AS (SELECT doc_id, t, len(t) AS n FROM words WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
), counts AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM sized)
    WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term
), heavy AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM counts, total GROUP BY term
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * docs) // words))))) AS BIGINT) AS score
    FROM counts JOIN heavy USING (term) JOIN asked USING (term), total GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
