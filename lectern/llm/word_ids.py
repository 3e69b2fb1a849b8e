"""Ids of distinct words under a BPE tokenizer that never joins words, kept in a table per task."""

from __future__ import annotations

import os
import unicodedata
from itertools import chain

import numpy as np
import regex

from lectern.llm.words import Words

MODEL = "word_bpe_49k.json"
TABLE_ROWS = 400_000
#: Words of these letters and signs are normalised alike everywhere; all others go through the whole tokenizer.
SIMPLE = regex.compile(r"[\x21-\x7e¡-¬®-įı-ɏ]+")
LETTERS = regex.compile(r"[A-Za-zÀ-ÖØ-öø-įı-ȿ]+")
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def _classes() -> np.ndarray:
    """Per byte: 0 letter (or part of one), 1 digit, 2 other sign, 3 one that needs the whole word."""
    kind = np.full(256, 2, dtype=np.uint8)
    kind[65:91] = kind[97:123] = kind[0x80:0xC0] = kind[0xC3:0xC9] = 0
    kind[48:58] = 1
    kind[:33] = kind[0x7F] = kind[0xC0:0xC3] = kind[0xC9:] = kind[ord("'")] = kind[ord("<")] = 3
    return kind


KIND = _classes()


def units(words: Words) -> Words:
    """The words cut where the tokenizer cuts them anyway: letters, single digits, runs of signs.

    Only words of ASCII and of letters from U+00C0 to U+023F are cut; one with an apostrophe, `<`, a control or
    any other character stays whole, and so do the three characters there that are no plain letters.
    """
    kind = KIND[words.data]
    hard = kind == 3
    lead, tail = words.data[:-1], words.data[1:]
    odd = ((lead == 0xC3) & ((tail == 0x97) | (tail == 0xB7))) | ((lead == 0xC4) & (tail == 0xB0))
    hard[:-1] |= odd
    before = np.zeros(len(kind) + 1, dtype=np.int64)
    np.cumsum(hard, out=before[1:])
    whole = before[words.end] > before[words.start]
    edge = np.zeros(len(kind) + 1, dtype=bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
    # cuts count only inside words that may be cut
    inside = np.zeros(len(kind) + 1, dtype=np.int64)
    np.add.at(inside, words.start[~whole] + 1, 1)
    np.add.at(inside, words.end[~whole], -1)
    cut = np.flatnonzero(edge & (np.cumsum(inside) > 0))
    start = np.sort(np.concatenate([words.start, cut]))
    end = np.sort(np.concatenate([words.end, cut]))
    first = np.searchsorted(start, np.append(words.start, len(words.data) + 1)[words.first])
    return Words(words.data, start, end, first)


class WordTable:
    """Distinct words and their ids: flat[begin[slot] : begin[slot] + size[slot]]."""

    def __init__(self, path: str | None = None, rows: int = TABLE_ROWS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(MODEL))
        self.model, self.letters, self.rows = self.tokenizer.model, byte_letters(), rows
        self.clear()

    def clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.part: dict[str, list[int]] = {}
        self.begin = self.size = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _part(self, part: str) -> list[int]:
        ids = self.part.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join(self.letters[b] for b in part.encode())
            ids = self.part[part] = [t.id for t in self.model.tokenize(shown)]
        return ids

    def ids(self, word: str) -> list[int]:
        if LETTERS.fullmatch(word):
            return self._part(word.lower())
        if "<|" in word or not SIMPLE.fullmatch(word) or not unicodedata.is_normalized("NFC", word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        parts = PARTS.findall(word.lower())
        return self._part(parts[0]) if len(parts) == 1 else [i for p in parts for i in self._part(p)]

    def slots(self, words: list[bytes]) -> np.ndarray:
        if len(self.slot) > self.rows:
            self.clear()
        new = [w for w in words if w not in self.slot]
        if new:
            found = [self.ids(w.decode()) for w in new]
            size = np.fromiter(map(len, found), np.int64, len(found))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))])
            self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
