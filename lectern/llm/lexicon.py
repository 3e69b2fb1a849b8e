"""Minimal acyclic transducer: words in, id sequences out; built from sorted words, kept in one file, looked up in batches.

Words that share an ending share its states. Outputs stand on arcs and move towards the start as far as words agree, so what is
left behind a state depends on the ending alone. The file is a header and flat arrays; readers map it into memory.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

ALIGN = 64
Ids = tuple[int, ...]


class _State:
    """A state that may still change: arcs as label -> [target, output], the output of words that end here or None."""

    __slots__ = ("arcs", "ending")

    def __init__(self):
        self.arcs: dict[int, list] = {}
        self.ending: Ids | None = None


class Builder:
    """Words must come in ascending order of their bytes, each once."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.path = [_State()]
        self.last = b""

    def _settle(self, keep: int) -> None:
        """Give every state of the last word beyond its first `keep` letters a number, the same for equal states."""
        while len(self.path) > keep + 1:
            done = self.path.pop()
            form = (done.ending, *[(label, target, out) for label, (target, out) in done.arcs.items()])
            self.path[-1].arcs[self.last[len(self.path) - 1]][0] = self.known.setdefault(form, len(self.known))

    def add(self, word: bytes, ids: Iterable[int]) -> None:
        same = 0
        while same < min(len(word), len(self.last)) and word[same] == self.last[same]:
            same += 1
        self._settle(same)
        rest = tuple(ids)
        for i in range(same):
            arc = self.path[i].arcs[word[i]]
            agreed = 0
            while agreed < min(len(arc[1]), len(rest)) and arc[1][agreed] == rest[agreed]:
                agreed += 1
            behind = arc[1][agreed:]
            if behind:
                arc[1] = arc[1][:agreed]
                after = self.path[i + 1]
                for other in after.arcs.values():
                    other[1] = behind + other[1]
                if after.ending is not None:
                    after.ending = behind + after.ending
            rest = rest[agreed:]
        for i in range(same, len(word)):
            self.path[i].arcs[word[i]] = [-1, rest if i == same else ()]
            self.path.append(_State())
        self.path[-1].ending = rest if same == len(word) else ()
        self.last = word

    def file(self) -> bytes:
        """Header and arrays; arcs are sorted by state and label."""
        self._settle(0)
        root = self.path[0]
        forms = [*self.known, (root.ending, *[(label, target, out) for label, (target, out) in root.arcs.items()])]
        key, target, outs, ends = [], [], [], []
        for state, (ending, *arcs) in enumerate(forms):
            ends.append(ending)
            for label, to, out in arcs:
                key.append(state << 8 | label)
                target.append(to)
                outs.append(out)
        pool: dict[Ids, int] = {}
        flat: list[int] = []
        for out in [*outs, *[e for e in ends if e]]:
            if out and out not in pool:
                pool[out] = len(flat)
                flat += out
        arrays = {
            "key": np.array(key, np.int64),
            "target": np.array(target, np.int32),
            "begin": np.array([pool.get(o, 0) for o in outs] + [pool.get(e or (), 0) for e in ends], np.int32),
            "size": np.array([len(o) for o in outs] + [len(e or ()) for e in ends], np.int32),
            "ends": np.array([e is not None for e in ends], np.bool_),
            "flat": np.array(flat, np.uint32),
        }
        return packed(arrays)


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // ALIGN) * ALIGN
    head = json.dumps(places).encode()
    body = bytearray(at)
    for name, a in arrays.items():
        body[places[name][2] : places[name][2] + a.nbytes] = a.tobytes()
    start = -(-(8 + len(head)) // ALIGN) * ALIGN
    return len(head).to_bytes(8, "little") + head.ljust(start - 8) + bytes(body)


def unpacked(data: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays in the bytes that `packed` made, without a copy."""
    size = int.from_bytes(data[:8].tobytes(), "little")
    start = -(-(8 + size) // ALIGN) * ALIGN
    places = json.loads(data[8 : 8 + size].tobytes())
    return {name: data[start + at : start + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in places.items()}


class Lexicon:
    """A transducer in a mapped file."""

    def __init__(self, file: str):
        self.__dict__.update(unpacked(np.memmap(file, np.uint8, "r")))
        self.root = len(self.ends) - 1
        # states are numbered after all states they lead to, so one pass from the first finds the longest way
        self.longest = self._longest()

    def _longest(self) -> int:
        state = np.full(1, self.root)
        steps = 0
        while len(self.key):
            lo, hi = np.searchsorted(self.key, state << 8), np.searchsorted(self.key, (state + 1) << 8)
            count = hi - lo
            if not count.any():
                break
            arcs = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            state = np.unique(self.target[arcs]).astype(np.int64)
            steps += 1
        return steps

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, number of ids, ids of all known words one after another); words: large_binary without nulls."""
        n = len(words)
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1]
        body = words.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
        length = np.diff(offsets)
        known = np.zeros(n, dtype=bool)
        alive = np.flatnonzero(length <= self.longest)
        state = np.full(len(alive), self.root, dtype=np.int64)
        who, which = [], []
        for step in range(self.longest + 1):
            over = length[alive] == step
            if over.any():
                done, at = alive[over], state[over]
                good = self.ends[at]
                known[done[good]] = True
                who.append(done[good])
                which.append(len(self.key) + at[good])
                alive, state = alive[~over], state[~over]
            if not len(alive):
                break
            want = state << 8 | data[offsets[alive] + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            found = self.key[arc] == want
            alive, arc = alive[found], arc[found]
            state = self.target[arc].astype(np.int64)
            loud = self.size[arc] > 0
            who.append(alive[loud])
            which.append(arc[loud])
        who = np.concatenate(who) if who else np.empty(0, np.int64)
        which = np.concatenate(which) if which else np.empty(0, np.int64)
        order = np.argsort(who, kind="stable")
        order = order[known[who[order]]]
        who, which = who[order], which[order]
        count = self.size[which].astype(np.int64)
        ids = self.flat[expanded(self.begin[which].astype(np.int64), count)]
        return known, np.bincount(who, count, n).astype(np.int64), ids


def expanded(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of size[0] places, then those of the next run."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
