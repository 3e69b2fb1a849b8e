"""Words of whole text batches as numpy arrays: spans, hashes and hashes of word runs (used inside Spark tasks).

Words are runs of bytes other than space and 0x09-0x0D. Nothing is cut: a batch is only split between texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: All but letters: ASCII letters and every byte of a longer character count as letters.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[128:] = NO_LETTER[65:91] = NO_LETTER[97:123] = False
#: Bytes of text handled at once, unless one text alone is longer.
SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def run_sums(codes: np.ndarray) -> np.ndarray:
    """What all hashes of runs of these codes are taken from."""
    total = np.empty(len(codes) + 1, dtype=np.uint64)
    total[0] = 0
    np.multiply(codes, powers(BASE, len(codes)), out=total[1:])
    return np.cumsum(total, out=total)


def run_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """Hash of codes[start:end] for every pair, equal for equal runs wherever they stand; total: the `run_sums`, if at hand."""
    if total is None:
        total = run_sums(codes)
    return mix((total[end] - total[start]) * powers(BASE_INVERSE, len(codes) + 1)[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts: text r has the words first[r] .. first[r + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return run_hashes(BYTE_CODE[self.data], self.start, self.end)

    def packed(self) -> pa.Array:
        """The words themselves as one Arrow array, without copying per word."""
        size = self.end - self.start
        offsets = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=offsets[1:])
        body = self.data[~SPACE[self.data]]
        return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)])

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text in them); null texts are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, body = texts.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, lower: bool = False, apart: np.ndarray = SPACE) -> Words:
    """apart: which bytes stand between words."""
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWER[data]
    solid = np.zeros(len(data) + 1, dtype=bool)
    solid[:-1] = ~apart[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge))
    end = np.flatnonzero(before & (~solid | edge))
    return Words(data, start, end, np.searchsorted(start, offsets))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` text bytes; a longer text stands alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(batch.num_rows, max(to, at + 1))
            yield batch.slice(at, to - at)
            at = to
