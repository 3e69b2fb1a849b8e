"""A compressed full-text index of some word sequences: suffix order, its last column in a wavelet tree, backward search.

Numpy only, used inside Spark tasks on one bounded shard. All queries of a shard advance together, one word a step.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bit column with a running count per 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.pad(packed, (0, -len(packed) % 8 + 8))
        self.block = packed.view(np.uint64)
        self.before = np.zeros(len(self.block) + 1, dtype=np.uint32)
        np.cumsum(np.bitwise_count(self.block), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block = at >> 6
        low = self.block[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[block].astype(np.int64) + np.bitwise_count(low)


class Wavelet:
    """Symbols by bit, highest first; zeros go to the left half of the next level."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.levels, self.zeros, self.depth = [], [], depth
        for level in range(depth - 1, -1, -1):
            bit = (symbols >> level) & 1 == 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place of position `at` in the last level, on the way of `symbol`."""
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.depth - 1 - k)) & 1 == 1
            ones = bits.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return at


class FmIndex:
    """Index of word sequences, each with a number; the smallest number of any holder of a run is reported.

    Every sequence ends in a symbol of its own, so no match runs over an end.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, holder: np.ndarray, window: int):
        """words: 64-bit word codes; sequence s has words[first[s]:first[s + 1]]; holder: its number."""
        count, size = len(first) - 1, np.diff(first)
        self.vocabulary, symbol = np.unique(words, return_inverse=True)
        text = np.empty(len(words) + count, dtype=np.int64)
        ends = first[1:] + np.arange(count)
        inner = np.ones(len(text), dtype=bool)
        inner[ends] = False
        text[inner], text[ends] = symbol.reshape(-1) + count, np.arange(count)
        self.window, self.separators, n = window, count, len(text)
        order, near = self._sort(text, int(size.max()) + 1 if count else 1)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=count + len(self.vocabulary)))])
        self.wavelet = Wavelet(text[order - 1], max(1, int(self.start.size - 1).bit_length()))
        self.origin = self.wavelet.descend(np.arange(len(self.start) - 1), np.zeros(len(self.start) - 1, dtype=np.int64))
        same = np.zeros(n, dtype=bool)
        if n > 1:
            same[1:] = near(order[1:], order[:-1])
        self.run = np.cumsum(~same) - 1
        owner = np.repeat(holder, size + 1)[order]
        self.smallest = np.minimum.reduceat(owner, np.flatnonzero(~same)) if n else np.empty(0, np.int64)

    def _sort(self, text: np.ndarray, longest: int):
        """Suffix order by doubling, and a test whether two suffixes agree on `window` words."""
        n, width = len(text), 1
        rank, half, half_width = text.copy(), text, 1
        while width < longest:
            if width <= self.window:
                half, half_width = rank, width
            after = np.zeros(n, dtype=np.int64)
            after[: n - width] = rank[width:] + 1
            key = rank * (int(rank.max()) + 2) + after
            _, rank = np.unique(key, return_inverse=True)
            width *= 2
        if width <= self.window:
            half, half_width = rank, width
        order = np.argsort(rank, kind="stable")
        shift = self.window - half_width

        def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            fits = (a + shift < n) & (b + shift < n)
            to_a, to_b = np.minimum(a + shift, n - 1), np.minimum(b + shift, n - 1)
            return fits & (half[a] == half[b]) & (half[to_a] == half[to_b])

        return order, near

    def matches(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word: length of the match that starts there (cut to its sequence), and the smallest holder of its
        first `window` words (-1 where the match is shorter)."""
        length = np.zeros(len(words), dtype=np.int64)
        holder = np.full(len(words), -1, dtype=np.int64)
        if not len(words):
            return length, holder
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        symbol = np.where(self.vocabulary[at] == words, at + self.separators, -1)
        size = np.diff(first)
        total = len(self.run)
        live = np.flatnonzero(size > 0)
        low, high, matched = (np.zeros(len(size), dtype=np.int64) for _ in range(3))
        high[:] = total
        for step in range(1, int(size.max()) + 1):
            live = live[size[live] >= step]
            place = first[live + 1] - step
            mark = symbol[place]
            known = np.maximum(mark, 0)
            origin = self.origin[known]
            new_low = self.start[known] + self.wavelet.descend(known, low[live]) - origin
            new_high = self.start[known] + self.wavelet.descend(known, high[live]) - origin
            lost = (mark < 0) | (new_low >= new_high)
            if lost.any():
                self._restart(live, lost, low, high, matched, new_low, new_high, symbol, place)
            kept = ~lost
            low[live[kept]], high[live[kept]] = new_low[kept], new_high[kept]
            matched[live[kept]] += 1
            length[place] = matched[live]
            full = matched[live] >= self.window
            holder[place[full]] = self.smallest[self.run[low[live[full]]]]
        return length, holder

    def _restart(self, live, lost, low, high, matched, new_low, new_high, symbol, place) -> None:
        """Where a match can't grow, find the longest shorter one: search again from fewer following words."""
        for j in np.flatnonzero(lost):
            s, at = live[j], place[j]
            for keep in range(int(matched[s]), -1, -1):
                lo, hi = 0, len(self.run)
                for p in range(at + keep, at - 1, -1):
                    c = symbol[p]
                    if c < 0:
                        lo = hi
                        break
                    lo, hi = (int(self.start[c] + self.wavelet.descend(np.array([c]), np.array([x]))[0] - self.origin[c]) for x in (lo, hi))
                    if lo >= hi:
                        break
                if lo < hi:
                    low[s], high[s], matched[s] = lo, hi, keep + 1
                    break
            else:
                low[s], high[s], matched[s] = 0, len(self.run), 0
