"""Semantic dedup: greedy in id order, a kept row removes every later row with cosine > t.

The reference loop is sequential: row j goes exactly when some *kept* row i < j is
similar to it. Two facts make it distributable without ever listing the pairs:

* a row with no undecided similar row before it is kept;
* every later row similar to a kept row is removed.

So only existence questions are asked ("does j have such a row before it?"), one flag
per row and task leaves the workers, and the work is done in three exact stages:

1. equal vectors collapse to their first row in a map-side aggregate;
2. sweeps, in linear passes: the first rows by id, a bounded number, decide each other,
   since every row before them is among them, and the kept ones remove all similar rows
   of the table. While that removes much it goes on with the first rows of the rest; then
   the first rows around a few sampled pivots are decided against the whole table and
   remove their groups. A near-copy group that holds a third of all rows is gone after
   one sweep;
3. rounds of the two facts over the rest. Similar rows meet in the leaves of a pivot
   tree: a cell larger than a block is split among pivots of its own, level by level, so
   the leaves follow the number of rows. A row is also copied to a neighbouring cell
   when the plane between the two pivots is within reach, which misses nothing. A cell
   that a split wouldn't make cheaper (most of its rows lie near every border) stays
   whole; leaves larger than a block are cut into sub-blocks that meet pairwise, as few
   as memory and cores allow, because every row is copied once per sub-block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.vectors import norm
from lectern.operators.blocks import TILE, unit_rows
from lectern.session import cut_lineage

PIVOTS = 256
BLOCK_BYTES = 16 * 1024 * 1024
#: Pivots of one cell at most, and bytes of pivots that are broadcast together.
FAN = 64
PIVOT_BYTES = 32 * 1024 * 1024
#: A split must save this share of a cell's comparisons.
SAVES = 0.25
SWEEP_SHARE = 0.05
#: Bytes of the first rows that decide each other, and the part of all rows that they are at most.
HEAD_BYTES = 2 * 1024 * 1024
HEAD_SHARE = 16
#: Sub-blocks of a large leaf, unless they would be larger than BLOCK_BYTES: enough pairs of them for some dozen cores.
FEW = 8
LEAST_BLOCK = 2
#: Leaves larger than a block whose number of sub-blocks is broadcast.
BROADCAST_LEAVES = 100_000
_MARGIN = 1e-9
NO_ID = np.iinfo(np.int64).max


def _matrix(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(ids, unit rows) of a table whose size the caller has bounded."""
    table = df.select("id", "v").toArrow()
    return table.column(0).to_numpy().astype(np.int64), unit_rows(table.column(1))


def _tiles(n_left: int, n_right: int) -> Iterator[slice]:
    step = max(1, TILE // max(n_right, 1))
    return (slice(at, at + step) for at in range(0, n_left, step))


def _hit(src_ids, src, tgt_ids, tgt, t: float) -> np.ndarray:
    """Flag per target: some source with a lower id has cosine > t."""
    hit = np.zeros(len(tgt_ids), dtype=bool)
    if not len(src_ids) or not len(tgt_ids):
        return hit
    for part in _tiles(len(tgt_ids), len(src_ids)):
        near = tgt[part] @ src.T > t
        hit[part] = (near & (src_ids[None, :] < tgt_ids[part][:, None])).any(axis=1)
    return hit


# --- stage 2: sweeps -------------------------------------------------------------


def _head_rows(n: int, dim: int, least: int) -> int:
    return min(max(1, HEAD_BYTES // (8 * max(dim, 1))), max(least, n // HEAD_SHARE))


def _greedy(matrix: np.ndarray, t: float) -> np.ndarray:
    """Whether each row, in order, is similar to no kept row before it."""
    kept = np.ones(len(matrix), dtype=bool)
    for i in range(len(matrix)):
        if kept[i]:
            kept[i + 1 :] &= ~(matrix[i + 1 :] @ matrix[i] > t)
    return kept


def _head_sweep(rows: DataFrame, t: float, size: int) -> tuple[DataFrame, DataFrame, int]:
    """(kept ids among the first `size` rows, later rows that those don't remove, number of first rows)."""
    head_ids, matrix = _matrix(rows.orderBy("id").limit(size))
    sure = _greedy(matrix, t)
    shared = rows.sparkSession.sparkContext.broadcast((head_ids, head_ids[sure], matrix[sure]))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, kept_ids, kept_rows = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy().astype(np.int64)
            gone = _hit(kept_ids, kept_rows, ids, unit_rows(batch.column(1)), t) | np.isin(ids, first)
            yield batch.filter(pa.array(~gone))

    slim = rows.select("id", "v")
    kept = rows.sparkSession.createDataFrame([(int(i),) for i in head_ids[sure]], "id long")
    left = cut_lineage(slim.mapInArrow(rest, slim.schema))
    shared.unpersist()
    return kept, left, len(head_ids)


def _sweep(rows: DataFrame, t: float, pivots: int) -> tuple[DataFrame, DataFrame]:
    """(surely kept ids, rows without those and without what they remove)."""
    sc = rows.sparkSession.sparkContext
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(pivots)
    around = sc.broadcast(_matrix(sample))

    def first_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per pivot the first row near it, with its vector."""
        pivot_ids, matrix = around.value
        first, own = pivot_ids.copy(), matrix.copy()
        for batch in batches:
            ids, v = batch.column(0).to_numpy().astype(np.int64), unit_rows(batch.column(1))
            for part in _tiles(len(ids), len(matrix)):
                near = np.where(v[part] @ matrix.T > t, ids[part][:, None], NO_ID)
                best = near.argmin(axis=0) if len(near) else np.empty(0, np.int64)
                least = near[best, np.arange(len(best))] if len(near) else np.full(len(first), NO_ID)
                earlier = least < first
                first[earlier], own[earlier] = least[earlier], v[part][best[earlier]]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(first))), pa.array(first), pa.array(list(own))], names=["pivot", "id", "v"])

    slim = rows.select("id", "v")
    found = slim.mapInArrow(first_near, "pivot long, id long, v array<double>")
    # at most one row per pivot
    leaders = found.groupBy("pivot").agg(F.min("id").alias("id"), F.min_by("v", "id").alias("v")).dropDuplicates(["id"])
    led = sc.broadcast(_matrix(leaders))

    def preceded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead_ids, matrix = led.value
        hit = np.zeros(len(lead_ids), dtype=bool)
        for batch in batches:
            ids, v = batch.column(0).to_numpy().astype(np.int64), unit_rows(batch.column(1))
            hit |= _hit(ids, v, lead_ids, matrix, t)
        yield pa.RecordBatch.from_arrays([pa.array(lead_ids[hit])], names=["id"])

    waiting = {r["id"] for r in slim.mapInArrow(preceded, "id long").distinct().collect()}
    lead_ids, matrix = led.value
    sure = np.array([i not in waiting for i in lead_ids], dtype=bool)
    kept = sc.broadcast((lead_ids[sure], matrix[sure]))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_ids, kept_rows = kept.value
        for batch in batches:
            ids = batch.column(0).to_numpy().astype(np.int64)
            gone = _hit(kept_ids, kept_rows, ids, unit_rows(batch.column(1)), t) | np.isin(ids, kept_ids)
            yield batch.filter(pa.array(~gone))

    kept_df = rows.sparkSession.createDataFrame([(int(i),) for i in lead_ids[sure]], "id long")
    left = cut_lineage(slim.mapInArrow(rest, slim.schema))
    for sent in (around, led, kept):
        sent.unpersist()
    return kept_df, left


# --- stage 3: rounds --------------------------------------------------------------

PLACED = "id long, v array<double>, cell long, copied long"


class _Splits:
    """Pivots of some cells: rows of such a cell are dealt to its children, numbered from first[cell] on."""

    def __init__(self, cells: list[int], pivots: list[np.ndarray], first: list[int], t: float):
        self.at = {cell: i for i, cell in enumerate(cells)}
        self.pivots, self.first = pivots, first
        self.reach = math.sqrt(max(0.0, 2.0 - 2.0 * t))

    def dealt(self, cell: int, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, child, whether the child is another than the row's own), each pair of similar rows sharing a child.

        A row is copied to the cells of lower number that a similar row may lie in: those behind a plane within reach.
        """
        centers, first = self.pivots[self.at[cell]], self.first[self.at[cell]]
        gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (centers @ centers.T)))
        number = np.arange(len(centers))
        out = []
        for part in _tiles(len(v), len(centers)):
            closeness = v[part] @ centers.T
            home = closeness.argmax(axis=1)
            lead = closeness[np.arange(len(home)), home][:, None] - closeness
            near = (lead <= gap[home] * self.reach + _MARGIN) & (number[None, :] < home[:, None])
            near[np.arange(len(home)), home] = True
            row, child = np.nonzero(near)
            out.append((row + part.start, child + first, child != home[row]))
        return tuple(np.concatenate(x) for x in zip(*out))


def _by_cell(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    cell = batch.column("cell").to_numpy()
    order = np.argsort(cell, kind="stable")
    edges = np.flatnonzero(np.diff(cell[order], prepend=-1))
    for rows in np.split(order, edges[1:]):
        if len(rows):
            yield int(cell[rows[0]]), batch.take(pa.array(rows))


def _sizes(shared):
    """Rows per (cell, child) of the split cells, without moving a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = _Splits(*shared.value)
        for batch in batches:
            for cell, part in _by_cell(batch):
                child, n = np.unique(splits.dealt(cell, unit_rows(part.column("v")))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), cell)), pa.array(child), pa.array(n)], names=["cell", "child", "n"])

    return run


def _moves(shared, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = _Splits(*shared.value)
        for batch in batches:
            for cell, part in _by_cell(batch):
                if cell not in splits.at:
                    yield part
                    continue
                row, child, away = splits.dealt(cell, unit_rows(part.column("v")))
                part = part.take(pa.array(row))
                copied = part.column("copied").to_numpy() | (away.astype(np.int64) << level)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array(child), pa.array(copied)], names=part.schema.names)

    return run


def _chosen(placed: DataFrame, cells: list[tuple[int, int]], dim: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Pivots of each (cell, number of them), in groups of at most PIVOT_BYTES: the cell's rows of least hash."""
    spark, group, held = placed.sparkSession, [], 0
    groups = []
    for cell, fan in cells:
        if group and held + fan * dim * 8 > PIVOT_BYTES:
            groups.append(group)
            group, held = [], 0
        group.append((cell, fan))
        held += fan * dim * 8
    for group in [*groups, group]:
        wanted = spark.createDataFrame(group, "cell long, fan int")
        drawn = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("id"), "id"))
        # an id has at most one copy in a cell; the limit applies before the shuffle
        rows = placed.withColumn("n", drawn).where(F.col("n") <= FAN).join(F.broadcast(wanted), "cell").where("n <= fan")
        table = rows.select("cell", "v").toArrow()
        cell, v = table.column("cell").to_numpy(), unit_rows(table.column("v"))
        yield [c for c, _ in group], [v[cell == c] for c, _ in group]


def _placed(rows: DataFrame, t: float, n: int, dim: int, block: int) -> tuple[DataFrame, dict[int, int]]:
    """(rows and copies with the leaf of the pivot tree they stand in, rows per leaf).

    `copied` has a bit for every level on which the row was copied to a cell not its own.
    """
    spark = rows.sparkSession
    placed = rows.select("id", "v", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("copied"))
    sizes, final, new, level = {0: n}, set(), 1, 0
    while big := [c for c, size in sorted(sizes.items()) if size > block and c not in final]:
        changed = False
        fans = [(c, min(FAN, math.ceil(sizes[c] / block))) for c in big]
        for cells, pivots in _chosen(placed, fans, dim):
            first = []
            for p in pivots:
                first.append(new)
                new += len(p)
            asked = spark.sparkContext.broadcast((cells, pivots, first, t))
            wanted = F.broadcast(spark.createDataFrame([(c,) for c in cells], "cell long"))
            found = placed.join(wanted, "cell", "left_semi").select("id", "v", "cell", "copied")
            counted = found.mapInArrow(_sizes(asked), "cell long, child long, n long").groupBy("cell", "child").agg(F.sum("n").alias("n"))
            children: dict[int, dict[int, int]] = {c: {} for c in cells}
            for r in counted.collect():
                children[r["cell"]][r["child"]] = r["n"]
            good = [i for i, c in enumerate(cells) if sum(s * s for s in children[c].values()) <= (1 - SAVES) * sizes[c] ** 2]
            final |= set(cells) - {cells[i] for i in good}
            if good:
                kept = spark.sparkContext.broadcast(([cells[i] for i in good], [pivots[i] for i in good], [first[i] for i in good], t))
                placed = cut_lineage(placed.mapInArrow(_moves(kept, level), PLACED))
                changed = True
                for i in good:
                    del sizes[cells[i]]
                    sizes |= children[cells[i]]
        level += changed
    return placed, sizes


def _subs(size: int, block: int, most: int) -> int:
    """Sub-blocks of a leaf: of a block each, but no more than `FEW` unless they would hold more than `most` rows."""
    return min(math.ceil(size / block), max(FEW, math.ceil(size / most)))


def _gridded(placed: DataFrame, sizes: dict[int, int], block: int, most: int) -> DataFrame:
    """Every row once per sub-block pair (a, b) of its leaf that it belongs to."""
    large = {c: _subs(s, block, most) for c, s in sizes.items() if s > block}
    subs = F.lit(1)
    if large:
        counts = placed.sparkSession.createDataFrame(list(large.items()), "cell long, subs int")
        placed = placed.join(F.broadcast(counts) if len(large) <= BROADCAST_LEAVES else counts, "cell", "left")
        subs = F.coalesce("subs", F.lit(1))
    grid = placed.withColumn("subs", subs).withColumn("sub", F.pmod(F.xxhash64("id"), "subs").cast("int"))
    return grid.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).select(
        "id", "v", "src", "tgt", "copied", "cell", "sub", F.least("sub", "other").alias("a"), F.greatest("sub", "other").alias("b")
    )


def _meeting(t: float):
    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, a, b = (k.as_py() for k in key)
        ids = table.column("id").to_numpy().astype(np.int64)
        v = unit_rows(table.column("v"))
        src, tgt = (np.asarray(table.column(c)) for c in ("src", "tgt"))
        sub, copied = table.column("sub").to_numpy(), table.column("copied").to_numpy()
        hit = np.zeros(len(ids), dtype=bool)
        sides = [(sub == a, sub == b)] if a == b else [(sub == a, sub == b), (sub == b, sub == a)]
        kinds = np.unique(copied)
        for left, right in sides:
            for one in kinds:
                s = np.flatnonzero(left & src & (copied == one))
                # two rows copied on one level meet in a lower cell of that level
                g = np.flatnonzero(right & tgt & ((copied & one) == 0) & ~hit)
                hit[g] |= _hit(ids[s], v[s], ids[g], v[g], t)
        return pa.table({"id": ids[hit]})

    return meet


def _lower_hits(placed: DataFrame, sizes: dict[int, int], t: float, block: int, dim: int) -> DataFrame:
    """Ids of target rows that have a similar source row with a lower id; `placed` has src and tgt."""
    grid = _gridded(placed, sizes, block, _block(dim, max(BLOCK_BYTES, block * 8 * dim)))
    return grid.groupBy("cell", "a", "b").applyInArrow(_meeting(t), "id long").distinct()


def _block(dim: int, block_bytes: int) -> int:
    return max(LEAST_BLOCK, block_bytes // (8 * max(dim, 1)))


def semantic_dedup(
    df: DataFrame,
    row_id: str,
    vector: str,
    threshold: float = C.NEAR_DUPLICATE_COSINE,
    pivots: int = PIVOTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Kept row ids (one column, named like `row_id`, a unique integer giving the scan order)."""
    t = float(threshold)
    rows = df.select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    directed = norm("v") > 0
    # a zero vector is similar to nothing
    kept = [rows.where(~F.coalesce(directed, F.lit(False))).select("id")]
    merged = rows.where(directed)
    if t < 1 - 1e-6:
        merged = merged.groupBy("v").agg(F.min("id").alias("id")).select("id", "v")
    open_rows = cut_lineage(merged)
    facts = open_rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    n, dim = facts["n"], facts["dim"] or 0

    block = _block(dim, block_bytes)
    shrinking = True
    while shrinking and n:
        sure, open_rows, first = _head_sweep(open_rows, t, _head_rows(n, dim, pivots))
        kept.append(sure)
        left = open_rows.count()
        shrinking = n - left - first > SWEEP_SHARE * n
        n = left
    shrinking = True
    while shrinking and n:
        sure, open_rows = _sweep(open_rows, t, pivots)
        kept.append(sure)
        left = open_rows.count()
        shrinking = n - left > max(pivots, SWEEP_SHARE * n)
        n = left

    placed, sizes = _placed(open_rows, t, n, dim, block) if n else (None, {})
    while n:
        flags = F.lit(True)
        waiting = cut_lineage(_lower_hits(placed.withColumns({"src": flags, "tgt": flags}), sizes, t, block, dim))
        marked = placed.join(waiting.withColumn("tgt", flags), "id", "left").withColumn("tgt", F.coalesce("tgt", F.lit(False)))
        marked = marked.withColumn("src", ~F.col("tgt"))
        # every row stands once in a cell of its own on all levels
        kept.append(marked.where("src AND copied = 0").select("id"))
        removed = _lower_hits(marked, sizes, t, block, dim)
        placed = cut_lineage(marked.where("tgt").drop("src", "tgt").join(removed, "id", "left_anti"))
        left = {r["cell"]: (r["count"], r["own"]) for r in placed.groupBy("cell").agg(F.count("*").alias("count"), F.count_if(F.col("copied") == 0).alias("own")).collect()}
        sizes, n = {c: size for c, (size, _) in left.items()}, sum(own for _, own in left.values())
    result = kept[0]
    for part in kept[1:]:
        result = result.unionByName(part)
    return result.withColumnRenamed("id", row_id)


def _head_flags(rows: DataFrame, targets: DataFrame, t: float, after: int | None, size: int) -> tuple[DataFrame, DataFrame, int | None]:
    """(targets similar to one of the `size` rows that follow `after`, targets left open, last of those rows).

    Targets up to the last of them have met every row before them and are decided.
    """
    around = rows if after is None else rows.where(F.col("id") > after)
    head = _matrix(around.orderBy("id").limit(size))
    last = int(head[0].max()) if len(head[0]) else after
    shared = rows.sparkSession.sparkContext.broadcast((*head, last))

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that are flagged, without their vector, and rows that stay open."""
        head_ids, matrix, last = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy().astype(np.int64)
            hit = _hit(head_ids, matrix, ids, unit_rows(batch.column(1)), t)
            stays = hit | (ids > last)
            v = pc.if_else(pa.array(hit), pa.scalar(None, batch.column(1).type), batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), v], schema=batch.schema).filter(pa.array(stays))

    slim = targets.select("id", "v")
    done = cut_lineage(slim.mapInArrow(flagged, slim.schema))
    shared.unpersist()
    return done.where("v IS NULL").select("id"), done.where("v IS NOT NULL"), last


def _met_by_all(rows: DataFrame, targets: DataFrame, t: float) -> DataFrame:
    """Targets, a bounded number, that have a similar row before them: one pass over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(_matrix(targets))

    def preceded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        hit = np.zeros(len(ids), dtype=bool)
        for batch in batches:
            left = np.flatnonzero(~hit)
            hit[left] = _hit(batch.column(0).to_numpy().astype(np.int64), unit_rows(batch.column(1)), ids[left], matrix[left], t)
        yield pa.RecordBatch.from_arrays([pa.array(ids[hit])], names=["id"])

    return rows.select("id", "v").mapInArrow(preceded, "id long").distinct()


def first_neighbours(rows: DataFrame, row_id: str, vector: str, threshold: float, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows that have a similar row before them (the flag the rounds are built on).

    While the first rows by id flag much of what is open, they do so in linear passes; the rest meets in the pivot tree.
    """
    t = float(threshold)
    ready = rows.select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    facts = ready.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    n, dim = facts["n"], facts["dim"] or 0
    block = _block(dim, block_bytes)
    found, targets, open_, last, shrinking = [], ready, n, None, True
    head = _head_rows(n, dim, LEAST_BLOCK)
    while shrinking and open_ > head:
        hit, targets, last = _head_flags(ready, targets, t, last, head)
        found.append(hit)
        left = targets.count()
        shrinking = open_ - left - head > SWEEP_SHARE * open_
        open_ = left
    if 0 < open_ <= head:
        found.append(_met_by_all(ready, targets, t))
    elif open_:
        placed, sizes = _placed(ready, t, n, dim, block)
        flags = F.lit(True)
        wanted = targets.select("id").distinct().withColumn("tgt", flags)
        placed = placed.join(wanted, "id", "left").withColumns({"src": flags, "tgt": F.coalesce("tgt", F.lit(False))})
        found.append(_lower_hits(placed, sizes, t, block, dim))
    result = found[0] if found else ready.select("id").where(F.lit(False))
    for part in found[1:]:
        result = result.unionByName(part)
    return result.distinct().withColumnRenamed("id", row_id)
