"""Re-Pair grammar over symbol sequences, and one min-plus transfer matrix with audits per rule.

The alphabet: a row's role initial (s, u, a or another) with its fault, none or truncated, and one symbol for rows that must go.
A conversation is read by an automaton of four states: nothing yet, after s, after u, after a. The matrix of a symbol or rule holds,
for every state before and after, the least cost of edits over its rows and, of all cheapest edits, the ASCII-least audit.

Matrices multiply like costs (least sum), ties by audit. That is sound: two audits of one entry with equal cost cover the same rows,
so neither begins with the whole other (the rest would be inserts, which cost), and what follows can't turn their order.
Audits are ropes: a product refers to its parts, text is made where a tie or the result asks for it.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: States: nothing kept yet, after the system row, after a user row, after an assistant row; the first and last may end.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: state -> role initial -> next state
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE_OF = {"u": "user", "a": "assistant"}
#: Symbols are one letter each: whole rows in lower case, truncated ones in upper case, rows that must go as one.
WHOLE, CUT, GONE = "suax", "SUAX", "-"


class Rope:
    """A text as two parts, put together when it is read."""

    __slots__ = ("parts", "flat")

    def __init__(self, flat: str | None = None, parts: tuple | None = None):
        self.flat, self.parts = flat, parts

    def text(self) -> str:
        if self.flat is None:
            out, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope.flat is not None:
                    out.append(rope.flat)
                else:
                    todo += reversed(rope.parts)
            self.flat, self.parts = "".join(out), None
        return self.flat


EMPTY = Rope("")
Entry = tuple[int, Rope]
#: (before, after) -> (cost, audit); states without a way are left out
Matrix = dict[tuple[int, int], Entry]


def better(a: Entry, b: Entry | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and a[1].text() < b[1].text())


def times(left: Matrix, right: Matrix) -> Matrix:
    ahead = defaultdict(list)
    for (p, q), entry in right.items():
        ahead[p].append((q, entry))
    out: Matrix = {}
    for (p, m), (cost, audit) in left.items():
        for q, (more, rest) in ahead[m]:
            known = out.get((p, q))
            if known is None or cost + more <= known[0]:
                found = (cost + more, Rope(parts=(audit, rest)))
                if better(found, known):
                    out[p, q] = found
    return out


def plus(a: Matrix, b: Matrix) -> Matrix:
    out = dict(a)
    for key, entry in b.items():
        if better(entry, out.get(key)):
            out[key] = entry
    return out


def _inserts() -> Matrix:
    """Any number of inserted rows; more than two on end never pay, since states come again after two."""
    none: Matrix = {(s, s): (0, EMPTY) for s in STATES}
    one: Matrix = {(s, to): (INSERT_COST, Rope(INSERT)) for s in STATES for role, to in NEXT[s].items() if role in ROLE_OF}
    step = plus(none, one)
    return times(step, step)


INSERTS = _inserts()


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before one row, then the row."""
    row: Matrix = {(s, s): (DELETE_COST, Rope(DELETE)) for s in STATES}
    if symbol != GONE:
        extra = TRUNCATED_COST if symbol in CUT else 0
        initial = symbol.lower()
        for s in STATES:
            for role, to in NEXT[s].items():
                if role in ROLE_OF:
                    row = plus(row, {(s, to): (REROLE_COST + extra, Rope(REROLE))})
                if role == initial:
                    row = plus(row, {(s, to): (extra, Rope(KEEP))})
    return times(INSERTS, row)


SYMBOLS: dict[str, Matrix] = {s: symbol_matrix(s) for s in WHOLE + CUT + GONE}


def re_pair(sequences: Iterable[str]) -> tuple[list[tuple], list[list]]:
    """(rules, what is left of each sequence): the most frequent pair becomes a rule until no pair occurs twice.

    Rule i is written as the number i; a rule's parts are letters or numbers below its own. Pairs never cross sequences.
    """
    symbol: list = []
    for s in sequences:
        symbol += [*s, None]
    size = len(symbol)
    after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
    places: dict[tuple, set[int]] = defaultdict(set)

    def note(i: int) -> tuple | None:
        j = after[i]
        if symbol[i] is None or j >= size or symbol[j] is None:
            return None
        pair = (symbol[i], symbol[j])
        # in a run of one symbol every second pair counts, so that pairs don't overlap
        if pair[0] == pair[1] and before[i] >= 0 and before[i] in places[pair]:
            return None
        places[pair].add(i)
        return pair

    for i in range(size):
        note(i)
    queue = [(-len(at), str(pair), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(queue)
    rules: list[tuple] = []
    while queue:
        count, _, pair = heapq.heappop(queue)
        at = places[pair]
        if len(at) != -count:
            if len(at) > 1:
                heapq.heappush(queue, (-len(at), str(pair), pair))
            continue
        rule, touched = len(rules), set()
        rules.append(pair)
        for i in sorted(at):
            j = after[i]
            if symbol[i] != pair[0] or j >= size or symbol[j] != pair[1]:
                continue
            left, right = before[i], after[j]
            if left >= 0 and symbol[left] is not None:
                places[symbol[left], symbol[i]].discard(left)
            if right < size and symbol[right] is not None:
                places[symbol[j], symbol[right]].discard(j)
            symbol[i], symbol[j], after[i] = rule, None, right
            if right < size:
                before[right] = i
            for k in (left, i):
                if k >= 0 and (new := note(k)):
                    touched.add(new)
        places.pop(pair)
        for new in touched:
            if len(places[new]) > 1:
                heapq.heappush(queue, (-len(places[new]), str(new), new))
    left_over, now, i = [], [], 0
    while i < size:
        if symbol[i] is None:
            left_over.append(now)
            now = []
        else:
            now.append(symbol[i])
        i = after[i]
    return rules, left_over


class Grammar:
    """Rules over some sequences, each with its matrix; parts come before the rules that hold them."""

    def __init__(self, sequences: list[str]):
        rules, rest = re_pair(sequences)
        self.of: list[Matrix] = []
        for left, right in rules:
            self.of.append(times(self.matrix(left), self.matrix(right)))
        self.rest = dict(zip(sequences, rest))

    def matrix(self, symbol) -> Matrix:
        return SYMBOLS[symbol] if isinstance(symbol, str) else self.of[symbol]

    def advanced(self, reached: Matrix, sequence: str) -> Matrix:
        """What is reached after the rows of one of the sequences, too."""
        for symbol in self.rest[sequence]:
            reached = times(reached, self.matrix(symbol))
        return reached


BEGUN: Matrix = {(START, START): (0, EMPTY)}


def ended(reached: Matrix) -> Entry:
    """Cheapest way from the start to an end, inserts after the last row included."""
    best = None
    for (_, q), entry in times(reached, INSERTS).items():
        if q in ENDS and better(entry, best):
            best = entry
    return best
