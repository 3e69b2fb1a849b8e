"""Arrow and numpy helpers shared by the vector operators (run inside Spark tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCORE_DIGITS = 9
TILE = 2_000_000


def unit_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column to a float64 matrix of unit rows (zero rows stay zero)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    n = len(column)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if n == 0:
        return flat.reshape(0, 0)
    if len(flat) % n or column.null_count:
        raise ValueError("vectors of one collection must all have the same size")
    rows = flat.reshape(n, len(flat) // n)
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def values(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Id column as a sortable numpy array (integers, or fixed-width text)."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    return np.array(column.to_pylist(), dtype=str)


class LocalTopK:
    """Best k points per query over the batches of one task, ties by id."""

    def __init__(self, queries: np.ndarray, query_subject: np.ndarray | None, k: int):
        self.queries, self.subject, self.k = queries, query_subject, k
        n = len(queries)
        self.floor = np.full(n, -np.inf)
        self.scores: list[np.ndarray] = [np.empty(0)] * n
        self.ids: list[np.ndarray | None] = [None] * n

    def add(self, ids: np.ndarray, rows: np.ndarray, subject: np.ndarray | None) -> None:
        if not len(ids):
            return
        if rows.shape[1] != self.queries.shape[1]:
            raise ValueError("query and point vectors differ in size")
        step = max(1, TILE // len(ids))
        for at in range(0, len(self.queries), step):
            part = slice(at, at + step)
            scores = np.round(self.queries[part] @ rows.T, SCORE_DIGITS) + 0.0
            if self.subject is not None:
                wanted = self.subject[part][:, None]
                scores[(wanted != "") & (wanted != subject[None, :])] = -np.inf
            hot = (scores >= self.floor[part][:, None]) & (scores > -np.inf)
            for row in np.flatnonzero(hot.any(axis=1)):
                self._merge(at + row, ids, scores[row], np.flatnonzero(hot[row]))

    def _merge(self, q: int, ids: np.ndarray, scores: np.ndarray, hits: np.ndarray) -> None:
        if len(hits) > self.k:
            kth = np.partition(scores[hits], -self.k)[-self.k]
            hits = hits[scores[hits] >= kth]
        known = self.ids[q]
        all_ids = ids[hits] if known is None else np.concatenate([known, ids[hits]])
        all_scores = np.concatenate([self.scores[q], scores[hits]])
        best = np.lexsort((all_ids, -all_scores))[: self.k]
        self.ids[q], self.scores[q] = all_ids[best], all_scores[best]
        if len(best) == self.k:
            self.floor[q] = self.scores[q][-1]

    def result(self) -> tuple[np.ndarray, list, np.ndarray]:
        """(query positions, point ids, scores)."""
        found = np.array([len(s) for s in self.scores], dtype=np.int64)
        at = np.repeat(np.arange(len(self.queries)), found)
        ids = [i for found in self.ids if found is not None for i in found.tolist()]
        return at, ids, np.concatenate(self.scores) if len(self.scores) else np.empty(0)
