"""SimHash near-dedup: fingerprints within a few bits are linked, groups are the connected ones.

Method: a hierarchical index over fingerprints in Gray-rank order. Neighbours in that order share most bits, so a node of the
index stands for some neighbours and keeps the bits that they all share and that its parent doesn't hold yet (a masked
pattern). A search goes down level by level and carries the differences found so far: a node adds those on its own bits; if
there are too many, everything below it is pruned, if there can't be too many, it is linked as a whole, and a node whose
fingerprints are known to belong to the searcher's group is left out.

So that no search meets all fingerprints, they are dealt out by content first: of five blocks of bits, two fingerprints that
differ in at most four bits agree in one, and in every part of it. Of each block only as many bits are used as leave about
`FILL` fingerprints for a bucket, so the index of a bucket is deep enough to prune; the rest of the search is its work. A
bucket over `CAP` fingerprints is dealt again by five blocks of its remaining bits, and if that does not split it, by pairs of
parts. A bucket sends on one link per fingerprint, not its pairs. Equal fingerprints are one row throughout.

Odd input: texts without words have fingerprint zero and are linked like others; a row without doc_id gets its fingerprint and
the component of that fingerprint, null if no row with an id is linked; repeated rows get equal results; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.components import components
from lectern.llm.tables import read_table, saved
from lectern.llm.words import slices

SHINGLE = 4
SEED = 42
BITS = 4
#: Fingerprints of one bucket on average, and that are indexed together at most.
FILL, CAP = 4096, 20_000
#: Fingerprints of a shard (many buckets) on average.
SHARD = 40_000
LEVELS = 3
FAN = 4
#: (searcher, node) pairs looked at together.
PAIRS = 2_000_000


def fingerprints(texts: list[str | None], size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit fingerprints (as signed numbers): a bit is set if more than half of the shingle hashes have it."""
    from xxhash import xxh64_intdigest

    hashes, counts = [], []
    for text in texts:
        words = (text or "").encode().lower().split()
        body = b" ".join(words)
        if len(words) < size:
            found = [xxh64_intdigest(body, seed)] if words else []
        else:
            length = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(length + 1) - 1
            found = [xxh64_intdigest(body[s:e], seed) for s, e in zip((end - length).tolist(), end[size - 1 :].tolist())]
        hashes += found
        counts.append(len(found))
    count = np.array(counts, dtype=np.int64)
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(count), 64), dtype=np.uint8)
    full = np.flatnonzero(count)
    if len(full):
        ones = np.add.reduceat(bits, (np.cumsum(count) - count)[full], axis=0, dtype=np.int32)
        out[full] = ones * 2 > count[full, None]
    return np.packbits(out, axis=1, bitorder="little").view("<i8").reshape(-1).astype(np.int64)


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints(batch.column("text").to_pylist()))], ["doc_id", "fp"])


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order, where neighbours differ in one bit."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _unite(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the groups of a[i] and b[i]; group[x] is the least member of x's group."""
    while True:
        left, right = group[a], group[b]
        open_ = left != right
        if not open_.any():
            return
        a, b, left, right = a[open_], b[open_], left[open_], right[open_]
        np.minimum.at(group, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := group[group], group):
            group[:] = up


class GrayIndex:
    """Index of fingerprints by bucket; `groups` finds the linked ones of every bucket."""

    def __init__(self, bucket: np.ndarray, code: np.ndarray, fan: int = FAN):
        self.order = np.lexsort((gray_rank(code), bucket))
        bucket, self.code = bucket[self.order], code[self.order]
        n = len(code)
        new = np.ones(n, dtype=bool)
        new[1:] = bucket[1:] != bucket[:-1]
        first = np.flatnonzero(new)
        self.size = np.diff(np.append(first, n))
        self.bucket = np.cumsum(new) - 1
        place = np.arange(n) - first[self.bucket]
        self.starts, span = [np.arange(n)], 1
        while len(self.starts[-1]) > len(first):
            span *= fan
            self.starts.append(np.flatnonzero(place % span == 0))
        self.both = [np.bitwise_and.reduceat(self.code, s) for s in self.starts]
        self.shared = [~(both ^ np.bitwise_or.reduceat(self.code, s)) for both, s in zip(self.both, self.starts)]
        self.child = [np.searchsorted(low, high) for low, high in zip(self.starts, self.starts[1:])]
        # bits that a node shares and its parent does not
        self.fresh = self.shared[-1:]
        for level in range(len(self.starts) - 2, -1, -1):
            parent = np.searchsorted(self.starts[level + 1], self.starts[level], side="right") - 1
            self.fresh.insert(0, self.shared[level] & ~self.shared[level + 1][parent])
        self.compared = 0

    def groups(self, bits: int) -> np.ndarray:
        """Per fingerprint (in sorted order) the first one of its group; `compared` counts single fingerprints that were met."""
        n = len(self.code)
        group = np.arange(n)
        load = np.cumsum(self.size[self.bucket])
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + PAIRS)))
            self._search(np.arange(at, min(to, n)), bits, group)
            at = to
        return group

    def _search(self, asked: np.ndarray, bits: int, group: np.ndarray) -> None:
        n = len(self.code)
        who, node = asked, self.bucket[asked]
        above = np.zeros(len(asked), dtype=np.int64)
        for level in range(len(self.starts) - 1, -1, -1):
            start = self.starts[level]
            end = np.append(start[1:], n)
            low, high = np.minimum.reduceat(group, start), np.maximum.reduceat(group, start)
            keep = (end[node] - 1 > who) & ~((low[node] == high[node]) & (low[node] == group[who]))
            who, node = who[keep], node[keep]
            differ = above[keep] + np.bitwise_count((self.code[who] ^ self.both[level][node]) & self.fresh[level][node])
            near = differ <= bits
            all_in = near & (differ + 64 - np.bitwise_count(self.shared[level])[node] <= bits)
            if all_in.any():
                _unite(group, who[all_in], start[node[all_in]])
                for whole in np.unique(node[all_in]):
                    rest = np.arange(start[whole] + 1, end[whole])
                    _unite(group, rest, np.full(len(rest), start[whole]))
            near &= ~all_in
            if level == 0:
                self.compared += len(who)
                return
            who, node, above = who[near], node[near], differ[near]
            first = self.child[level - 1][node]
            count = np.append(self.child[level - 1], len(self.starts[level - 1]))[node + 1] - first
            who, above = np.repeat(who, count), np.repeat(above, count)
            node = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(who))


def _bucket_links(bits: int):
    def run(table: pa.Table) -> pa.Table:
        code = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        index = GrayIndex(table.column("key").to_numpy().astype(np.int64), code)
        ids = table.column("id").to_numpy().astype(np.int64)[index.order]
        group = index.groups(bits)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids)
        other = least[group] != ids
        return pa.table({"a": pa.array(ids[other]), "b": pa.array(least[group][other])})

    return run


def _dealt(rows: DataFrame, blocks: int, take: int = 64) -> DataFrame:
    """Every row once per block of its remaining bits, with the bucket of the block's first `take` bits."""
    if take == 0:
        return rows
    each = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    each = each.withColumn("lo", F.expr(f"int(width * j div {blocks})")).withColumn("hi", F.expr(f"int(least(width * (j + 1) div {blocks}, lo + {take}))"))
    value = F.expr("shiftrightunsigned(rem, lo) & (shiftleft(1L, hi - lo) - 1)")
    rest = F.expr("CASE WHEN hi >= 64 THEN 0L ELSE shiftleft(shiftrightunsigned(rem, hi), lo) END | (rem & (shiftleft(1L, lo) - 1))")
    return each.select(F.xxhash64("key", "j", value).alias("key"), rest.alias("rem"), F.expr("int(width - hi + lo)").alias("width"), "fp", "id")


def links(nodes: DataFrame, bits: int = BITS, cap: int = CAP, shard: int = SHARD, fill: int = FILL) -> DataFrame:
    """(a, b) that connect all fingerprints within `bits` differing bits; nodes: distinct (fp, id)."""
    take = max(0, math.ceil(math.log2(max(1, nodes.count()) / fill)))
    rows = nodes.select(F.lit(0).cast("long").alias("key"), F.col("fp").alias("rem"), F.lit(64).alias("width"), "fp", "id")
    found, wide = [], None
    for level in range(LEVELS):
        rows = saved(_dealt(rows, bits + 1, 64 if level else take), "buckets")
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        full = saved(counts.filter(F.col("n") > cap), "full")
        if full.isEmpty():
            found.append(rows)
            break
        found.append(rows.join(full, "key", "left_anti"))
        rows = rows.join(full, "key")
        if level == LEVELS - 1:
            wide = rows
        rows = rows.drop("n")
    out = []
    for part in found:
        shards = max(1, part.count() // shard)
        out.append(part.select(F.pmod("key", F.lit(shards)).alias("s"), "key", "fp", "id").groupBy("s").applyInArrow(_bucket_links(bits), "a long, b long"))
    if wide is not None:
        # a bucket that no block splits: parts of it meet two by two
        parts = F.ceil(F.col("n") / cap).cast("int") + 1
        mine = wide.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")))
        pairs = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        pairs = pairs.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "id")
        out.append(pairs.groupBy("key", "i", "j").applyInArrow(_bucket_links(bits), "a long, b long"))
    joined = out[0]
    for part in out[1:]:
        joined = joined.union(part)
    return joined


def fingerprint_table(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_fingerprint_rows, "doc_id long, fp long")


def grouped(docs: DataFrame, bits: int = BITS, cap: int = CAP, shard: int = SHARD) -> DataFrame:
    """(doc_id, fp, component_id, links of the fingerprint's class) of every row."""
    prints = saved(fingerprint_table(docs), "fingerprints")
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("id")).filter("id IS NOT NULL"), "nodes")
    found = components(links(nodes, bits, cap, shard))
    classes = nodes.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group the document with the smallest doc_id stays (rows without doc_id stay too)."""
    gone = grouped(docs).filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grouped(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
