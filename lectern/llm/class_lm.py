"""Language-model scores from class-based bigrams: classes by exchange clustering, class transitions, word emissions.

Method: clustering starts on symbols: the `WORDS` most frequent training words are symbols of their own, all others share the
symbols of their endings. Spark counts all symbol pairs of the training texts (at most the square of the number of symbols,
whatever the input). Exchange clustering moves one symbol at a time to the class that raises the likelihood of the class
bigrams most, until a sweep gains less than `SWEEP_GAIN` a token. Then every other training word leaves its ending: Spark sums
the classes before and after it (one row per word and class), and the word is exchanged into the class that raises the likelihood
most, thousands of words at once in every task, each measured against the same class table. So every training word has a class by its own contexts; only words that training never saw take
the class of their ending. Classes grow with the square root of the number of different words, up to `MOST_CLASSES`. Transitions are counted anew
with the classes of all words. A text then has the probability of its class transitions, smoothed towards the class
frequencies, times that of its words in their classes, (c + 0.1) / (N_class + 0.1 (V_class + 1)), with counts over all
training text.

Scores need the training count and the class of every word of every text. Those of the `COMMON` most frequent words travel as
a broadcast of that bounded size; the others meet the texts in a join on the word's 64-bit hash, with one row per text, word and
classes beside it, and come back as one sum per text. Two neighbours that are both not broadcast are a row that meets the table twice.

Odd input: null and empty texts are the end token alone; a row without doc_id is held out; repeated rows count and are
returned each; if nothing is left to train on, counts are zero and both formulas still hold; an empty table gives no rows;
further columns are not read. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.tables import read_table, saved
from lectern.llm.words import BYTE_CODE, run_hashes, run_sums, slices, words_of

#: Frequent words that are symbols of their own when clustering starts; symbols that the others share by their endings then.
WORDS, ENDINGS = 768, 255
ENDING_BYTES = 3
#: Classes at least and at most; between, one for so many in the square root of the number of different words.
CLASSES, MOST_CLASSES, ROOT = 64, 1024, 8
#: Sweeps go on while one gains so much likelihood a token (natural logarithm).
SWEEP_GAIN = 1e-4
#: Contexts weighed against all classes at once, and bytes of the table of what small numbers add.
WEIGHED = 16_384
SMALL_BYTES = 32 << 20
#: Frequent words whose counts and classes are broadcast.
COMMON = 131_072
ADDED = 0.1
#: Weight of the class frequencies in a transition.
PRIOR = 8.0
#: Different words a task gathers before it sends them on.
GATHER = 1_000_000


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def hashed(texts: pa.Array):
    """(words, different word hashes, their ending, place of each word among the different ones)."""
    words = words_of(texts, lower=True)
    codes = BYTE_CODE[words.data]
    total = run_sums(codes)
    # by a hash table, in the order in which they come: no sort of all places
    place, different = pd.factorize(run_hashes(codes, words.start, words.end, total))
    first = np.empty(len(different), dtype=np.int64)
    first[place[::-1]] = np.arange(len(place))[::-1]
    end = words.end[first]
    ending = run_hashes(codes, np.maximum(words.start[first], end - ENDING_BYTES), end, total) % np.uint64(ENDINGS)
    return words, different, ending.astype(np.int64), place.reshape(-1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number and ending, combined over the task."""
    parts: list[tuple] = []

    def merged():
        codes, first, at = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
        count = np.bincount(at.reshape(-1), weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        return codes, count, np.concatenate([p[2] for p in parts])[first]

    def sent(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[0].view(np.int64)), pa.array(rows[1]), pa.array(rows[2].astype(np.int32))], ["h", "n", "ending"])

    for batch in slices(batches):
        _, different, ending, place = hashed(batch.column("text"))
        parts.append((different, np.bincount(place, minlength=len(different)), ending))
        if sum(len(p[0]) for p in parts) > 2 * GATHER:
            parts = [merged()]
            if len(parts[0][0]) > GATHER:
                yield sent(parts.pop())
    if parts:
        yield sent(merged())


def looked_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted keys, whether it is there)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def symbols(different: np.ndarray, ending: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Symbol of every different word; frequent: sorted hashes of the words that are their own."""
    at, own = looked_up(frequent, different)
    return np.where(own, at, len(frequent) + ending)


def chained(symbol: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, symbol before, symbol) over all tokens; each text starts after an end and closes with one."""
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count + 1)
    now = np.full(len(row), end, dtype=np.int64)
    last = np.cumsum(count + 1) - 1
    inner = np.ones(len(row), dtype=bool)
    inner[last] = False
    now[inner] = symbol
    before = np.empty(len(row), dtype=np.int64)
    before[1:] = now[:-1]
    if len(row):
        before[0] = end
    return row, before, now


def _pairs(frequent, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for batch in slices(batches):
            words, different, ending, place = hashed(batch.column("text"))
            symbol = symbols(different, ending, frequent.value)
            _, before, now = chained(symbol[place], words.first, size - 1)
            total += np.bincount(before * size + now, minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return run


def x_log_x(x):
    return x * np.log(np.maximum(x, 1))


def put(table: np.ndarray, logs: np.ndarray, k: int, after: np.ndarray, before: np.ndarray, loop: float, sign: int) -> None:
    """Add (sign 1) or take away (sign -1) the pairs of a symbol of class k; logs: x_log_x of the table."""
    table[k] += sign * after
    table[:, k] += sign * before
    table[k, k] += sign * loop
    logs[k] = x_log_x(table[k])
    logs[:, k] = x_log_x(table[:, k])


def best_class(table: np.ndarray, logs: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, loop: float, least: float, among=slice(None)) -> int:
    """The class in which a symbol raises the likelihood most, `own` unless another (of `among`) gains more than `least`.

    The symbol's pairs are not in the table; after, before: its pairs with others by class; loop: those with itself.
    """
    to, since = np.flatnonzero(after), np.flatnonzero(before)
    diagonal = np.diag(table)
    gain = (x_log_x(table[:, to] + after[to]) - logs[:, to]).sum(axis=1) + (x_log_x(table[since] + before[since, None]) - logs[since]).sum(axis=0)
    gain += x_log_x(diagonal + after + before + loop) - x_log_x(diagonal + after) - x_log_x(diagonal + before) + np.diag(logs)
    out, into = table.sum(axis=1), table.sum(axis=0)
    gain -= x_log_x(out + after.sum() + loop) - x_log_x(out) + x_log_x(into + before.sum() + loop) - x_log_x(into)
    classes = np.arange(len(table) - 1)[among]
    best = int(classes[gain[classes].argmax()])
    return best if gain[best] > gain[own] + least else own


def least_gain(total: float) -> float:
    """Gains below are rounding."""
    return 1e-9 + 1e-12 * float(x_log_x(total))


def class_table(pairs: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How often a symbol of one class follows one of another."""
    width = int(group[-1]) + 1
    table = np.zeros((width, width))
    np.add.at(table, (group[:, None], group[None, :]), pairs)
    return table


def exchange(pairs: np.ndarray, classes: int) -> np.ndarray:
    """Class of every symbol. pairs[a, b]: how often b follows a; the last symbol, the end, stays alone in the last class."""
    size = len(pairs)
    classes = max(1, min(classes, size - 1))
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    group = np.empty(size, dtype=np.int64)
    by_weight = np.argsort(-weight[:-1], kind="stable")
    group[by_weight] = np.arange(size - 1) % classes
    group[-1] = classes
    table, least = class_table(pairs, group), least_gain(pairs.sum())
    logs = x_log_x(table)

    def sweep() -> None:
        for s in every:
            after = np.bincount(group, weights=pairs[s], minlength=classes + 1)
            before = np.bincount(group, weights=pairs[:, s], minlength=classes + 1)
            own, loop = group[s], pairs[s, s]
            after[own] -= loop
            before[own] -= loop
            put(table, logs, own, after, before, loop, -1)
            group[s] = best_class(table, logs, own, after, before, loop, least)
            put(table, logs, group[s], after, before, loop, 1)

    every = by_weight[weight[by_weight] > 0]
    before_it, now = -np.inf, likelihood(table)
    while now - before_it > SWEEP_GAIN * pairs.sum():
        sweep()
        before_it, now = now, likelihood(table)
    return group


def likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, without what no assignment changes."""
    return float(x_log_x(table).sum() - x_log_x(table.sum(axis=0)).sum() - x_log_x(table.sum(axis=1)).sum())


class Sides:
    """What n more pairs on a side add to x log x in every class; a side is a class before or after a word, or the word itself."""

    def __init__(self, table: np.ndarray):
        self.values = np.concatenate([table, table.T, np.diag(table)[None]])
        self.logs = x_log_x(self.values)
        most = 2 * SMALL_BYTES // self.values.nbytes
        # single precision: sums of gains are compared, not kept
        self.small = np.stack([np.zeros_like(self.logs), *(x_log_x(self.values + n) - self.logs for n in range(1, most))]).astype(np.float32) if most > 1 else None

    def added(self, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.small is None:
            return x_log_x(self.values[k] + n[:, None]) - self.logs[k]
        out = self.small[np.minimum(n, len(self.small) - 1), k]
        big = np.flatnonzero(n >= len(self.small))
        out[big] = x_log_x(self.values[k[big]] + n[big, None]) - self.logs[k[big]]
        return out


def best_of_many(table: np.ndarray, own: np.ndarray, size: np.ndarray, k: np.ndarray, n: np.ndarray, among: np.ndarray, sides: Sides | None = None) -> np.ndarray:
    """The class of every word: `own`, or the one of `among` that raises the likelihood more than leaving `own` lowers it.

    Word i has size[i] contexts, one after another in k and n: k is a class before it, width + a class after it, or 2 * width for
    itself. Each word is weighed against the same table, as if its neighbours stayed.
    """
    width = len(table)
    sides = sides or Sides(table)
    classes = own.copy()
    out, into = table.sum(axis=1), table.sum(axis=0)
    out_logs, into_logs = x_log_x(out), x_log_x(into)
    has = np.flatnonzero(size)
    end = np.cumsum(size)
    # whole words, about WEIGHED contexts at once
    cuts = np.searchsorted(end[has], np.arange(WEIGHED, end[-1] if len(end) else 0, WEIGHED))
    for words in np.split(has, np.unique(cuts)):
        if not len(words):
            continue
        lo, hi = end[words[0]] - size[words[0]], end[words[-1]]
        kk, nn = k[lo:hi], n[lo:hi]
        begin = end[words] - size[words] - lo
        gain = np.add.reduceat(sides.added(kk, nn), begin, axis=0)
        mine = np.repeat(own[words], size[words])
        held = sides.values[kk, mine]
        loss = np.add.reduceat(sides.logs[kk, mine] - x_log_x(np.maximum(held - nn, 0)), begin)
        before = np.add.reduceat(np.where((kk < width) | (kk == 2 * width), nn, 0), begin)
        after = np.add.reduceat(np.where(kk >= width, nn, 0), begin)
        gain = gain - (x_log_x(out + after[:, None]) - out_logs + x_log_x(into + before[:, None]) - into_logs)
        at = own[words]
        loss -= out_logs[at] - x_log_x(np.maximum(out[at] - after, 0)) + into_logs[at] - x_log_x(np.maximum(into[at] - before, 0))
        gain[np.arange(len(words)), at] = loss
        best = among[gain[:, among].argmax(axis=1)]
        moves = gain[np.arange(len(words)), best] > loss + 1e-5
        classes[words[moves]] = best[moves]
    return classes


def _contexts(shared):
    """(word, list of class before | width + class after | 2 width for the word itself, list of numbers) of the words without a symbol of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, group, table = shared.value
        width = len(table)
        parts: list[tuple] = []

        def merged():
            """Contexts word after word, in the order in which the words first came."""
            h, k, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
            at, different = pd.factorize(h)
            at, k, n = _summed(at, k, n)
            return different[at], k, n

        def sent(rows):
            first = np.flatnonzero(np.append(True, rows[0][1:] != rows[0][:-1])) if len(rows[0]) else np.empty(0, np.int64)
            h = rows[0][first]
            ends = pa.array(np.append(first, len(rows[0])), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(r, t)) for r, t in ((rows[1], pa.int32()), (rows[2], pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *lists], ["h", "ks", "ns"])

        for batch in slices(batches):
            words, different, ending, place = hashed(batch.column("text"))
            symbol = symbols(different, ending, frequent)
            of = np.append(group[symbol], width - 1)
            open_ = np.append(symbol >= len(frequent), False)
            _, before, now = chained(place, words.first, -1)
            at, since = open_[now], open_[before] & (before != now)
            k = np.where(before == now, 2 * width, of[before])[at]
            pair = np.concatenate([now[at] * (2 * width + 1) + k, before[since] * (2 * width + 1) + width + of[now[since]]])
            pair, n = np.unique(pair, return_counts=True)
            parts.append((different[pair // (2 * width + 1)], pair % (2 * width + 1), n.astype(np.int64)))
            if sum(len(p[0]) for p in parts) > 2 * GATHER:
                parts = [merged()]
                if len(parts[0][0]) > GATHER:
                    yield sent(parts.pop())
        if parts:
            yield sent(merged())

    return run


def _summed(owner: np.ndarray, k: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, k, sum of n), ascending."""
    if not len(k):
        return owner, k, n
    # one number for both: sorted faster than two
    wide = int(k.max()) + 1
    both = owner * wide + k
    order = np.argsort(both)
    both = both[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    return both[first] // wide, both[first] % wide, np.add.reduceat(n[order], first)


def _contexts_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(different words, and the number of the word, k and n of their contexts, summed); rows are sorted by h."""
    h = rows.column("h").to_numpy()
    first = np.flatnonzero(np.append(True, np.diff(h) != 0))
    ks, ns = (rows.column(c).combine_chunks() for c in ("ks", "ns"))
    size = pc.fill_null(pc.list_value_length(ks), 0).to_numpy()
    owner = np.repeat(np.cumsum(np.append(True, np.diff(h) != 0)) - 1, size)
    return (h[first], *_summed(owner, ks.flatten().to_numpy().astype(np.int64), ns.flatten().to_numpy()))


WORD_ROWS = pa.schema([("h", pa.int64()), ("n", pa.int64()), ("ending", pa.int32()), ("ks", pa.list_(pa.int32())), ("ns", pa.list_(pa.int64()))])


def _classed(shared):
    """(word, count, class): every word without a symbol of its own leaves the class of its ending for its best one.

    Rows come sorted by word: one with its count and ending, others with contexts from one task each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, group, table = shared.value
        sides = Sides(table)
        # an empty class would take in words that have nothing in common
        used = np.flatnonzero(table.sum(axis=0)[:-1])

        def done(rows: pa.Table) -> pa.RecordBatch:
            h, owner, k, n = _contexts_of(rows)
            counted = rows.filter(pc.is_valid(rows.column("n")))
            symbol = symbols(h.view(np.uint64), counted.column("ending").to_numpy().astype(np.int64), frequent)
            classes = group[symbol]
            if len(used):
                best = best_of_many(table, classes, np.bincount(owner, minlength=len(h)), k, n, used, sides)
                classes = np.where(symbol < len(frequent), classes, best)
            return pa.RecordBatch.from_arrays([pa.array(h), counted.column("n").combine_chunks(), pa.array(classes, pa.int32())], ["h", "n", "class"])

        def joined(rows: pa.Table) -> pa.Table:
            """Rows of one word as one, so that a word of every task stays small."""
            h, _, k, n = _contexts_of(rows)
            counted = rows.filter(pc.is_valid(rows.column("n")))
            one = {"h": h.tolist(), "n": counted.column("n").to_pylist() or [None], "ending": counted.column("ending").to_pylist() or [None], "ks": [k.tolist()], "ns": [n.tolist()]}
            return pa.table(one, schema=WORD_ROWS)

        rest = WORD_ROWS.empty_table()
        for batch in batches:
            rows = pa.concat_tables([rest, pa.Table.from_batches([batch]).cast(WORD_ROWS)]).combine_chunks()
            if rows.num_rows:
                h = rows.column("h").to_numpy()
                # the last word may go on in the next batch
                cut = int(np.searchsorted(h, h[-1]))
                if cut:
                    yield done(rows.slice(0, cut))
                rest = joined(rows.slice(cut))
        if rest.num_rows:
            yield done(rest)

    return run


class Model:
    """What a task needs to know of words: bounded tables only."""

    def __init__(self, common, counts, classes, frequent, group, value=None, end_count=None):
        self.common, self.counts, self.classes, self.frequent, self.group = common, counts, classes, frequent, group
        self.width = int(group[-1]) + 1
        self.value, self.end_count = value, end_count

    def parts(self) -> tuple:
        """What a broadcast carries: arrays only, so that executors need no copy of this package to read it."""
        return self.common, self.counts, self.classes, self.frequent, self.group, self.value, self.end_count

    def of(self, different: np.ndarray, ending: np.ndarray):
        """(whether it is here, its count, its class or else that of its ending) of every word."""
        at, here = looked_up(self.common, different)
        by_ending = self.group[symbols(different, ending, self.frequent)]
        if not len(self.common):
            return here, np.zeros(len(different), np.int64), by_ending
        return here, np.where(here, self.counts[at], 0), np.where(here, self.classes[at], by_ending)


def linked(words, place: np.ndarray, here: np.ndarray, classes: np.ndarray, end: int):
    """Pairs of neighbours, by what is known of them.

    (text, class, class) if both are here; (text, word, class before, class after, times) of the words that are not, with -1
    for a neighbour that is not either; (text, word, word, times) of two such neighbours.
    """
    row, before, now = chained(place, words.first, -1)
    known, of = np.append(here, True), np.append(classes, end)
    left, right = known[before], known[now]
    sure = left & right
    at = np.flatnonzero(~right)
    sides = end + 2
    beside = np.where(left[at], of[before[at]], -1) + 1, np.where(right[at + 1], of[now[at + 1]], -1) + 1
    many = max(1, len(here))
    alone, times = np.unique(((row[at].astype(np.int64) * many + now[at]) * sides + beside[0]) * sides + beside[1], return_counts=True)
    word = alone // sides**2
    alone = word // many, word % many, alone // sides % sides - 1, alone % sides - 1, times
    both = np.flatnonzero(~left & ~right)
    # a place of the word before, then of the word: texts apart
    order = np.lexsort((now[both], before[both], row[both]))
    both = both[order]
    first = np.flatnonzero(np.append(True, (np.diff(row[both]) != 0) | (np.diff(before[both]) != 0) | (np.diff(now[both]) != 0))) if len(both) else both
    two = row[both[first]], before[both[first]], now[both[first]], np.diff(np.append(first, len(both)))
    return (row[sure], of[before[sure]], of[now[sure]]), alone, two


LINKS = "h long, h2 long, n int, before int, after int, class int, class2 int"


def link_columns(different: np.ndarray, classes: np.ndarray, alone, two) -> list[pa.Array]:
    """Columns of LINKS, and the text of each row; class, class2: what holds for words that training never saw."""
    words = np.concatenate([alone[1], two[1]])
    none, gap = np.full(len(two[0]), -1), pa.nulls(len(alone[0]), pa.int64())
    second = pa.concat_arrays([gap, pa.array(different[two[2]].view(np.int64))])
    numbers = np.concatenate([alone[4], two[3]]), np.concatenate([alone[2], none]), np.concatenate([alone[3], none]), classes[words], np.concatenate([np.full(len(alone[0]), -1), classes[two[2]]])
    return [pa.array(different[words].view(np.int64)), second, *(pa.array(c.astype(np.int32)) for c in numbers)]


def met(links: DataFrame, words: DataFrame, *kept: str) -> DataFrame:
    """(kept, n, count, class before, class after) of every pair that a task could not know: each pair once, a word's count on one row.

    Columns: n, word (times its count is to be used), c (its count or null), a, b (classes).
    """
    found = words.select("h", F.col("n").alias("c"), F.col("class").alias("of"))
    one = links.filter("h2 IS NULL").join(found, "h", "left").withColumn("class", F.coalesce("of", "class"))
    one = one.select(*kept, "n", "c", F.posexplode(F.array(
        F.struct(F.col("before").alias("a"), F.col("class").alias("b")), F.struct(F.col("class").alias("a"), F.col("after").alias("b")))))
    one = one.select(*kept, "n", F.when(F.col("pos") == 0, F.col("n")).alias("word"), "c", "col.a", "col.b")
    two = links.filter("h2 IS NOT NULL").join(found.drop("c"), "h", "left").select(*kept, "n", F.coalesce("of", "class").alias("a"), F.col("h2").alias("h"), "class2")
    two = two.join(found.drop("c"), "h", "left").select(*kept, "n", F.lit(None).cast("int").alias("word"), F.lit(None).cast("long").alias("c"), "a", F.coalesce("of", "class2").alias("b"))
    return one.union(two)


def _class_pairs(shared):
    """Links of words that are not broadcast; the others are counted here, as rows with the number of the pair in h2 and no h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        width = model.width
        total = np.zeros(width * width, dtype=np.int64)
        names = [c.split()[0] for c in LINKS.split(", ")] + ["pairs"]
        for batch in slices(batches):
            words, different, ending, place = hashed(batch.column("text"))
            here, _, classes = model.of(different, ending)
            (_, before, now), alone, two = linked(words, place, here, classes, width - 1)
            total += np.bincount(before * width + now, minlength=width * width)
            columns = link_columns(different, classes, alone, two)
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(columns[0]), pa.int64())], names)
        at = np.flatnonzero(total)
        empty = [pa.nulls(len(at), pa.int32())] * 5
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.array(at), *empty, pa.array(total[at])], names)

    return run


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """The words above a count that at most `most` words reach: found on counts by sixteenths of a power of two, without a sort."""
    step = F.floor(F.log2("n") * 16).cast("int")
    left, least = most, None
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("step").desc()).collect():
        left -= r["words"]
        if left < 0:
            break
        least = r["step"]
    return counts.filter(step >= least) if least is not None else counts.filter(F.lit(False))


def train(docs: DataFrame):
    """(model, words table (h, n, class), training tokens N, different tokens V)."""
    spark = docs.sparkSession
    learned = docs.filter(~held_out(F.col("doc_id"))).select("text")
    counts = learned.mapInArrow(_counted, "h long, n long, ending int").groupBy("h").agg(F.sum("n").alias("n"), F.first("ending").alias("ending"))
    counts = saved(counts, "word-counts")
    kinds, n_words = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    own = counts.orderBy(F.col("n").desc(), "h").limit(WORDS).select("h").toArrow().column("h").to_numpy()
    frequent = np.sort(own.view(np.uint64))
    size = len(frequent) + ENDINGS + 1
    found = learned.mapInArrow(_pairs(spark.sparkContext.broadcast(frequent), size), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(size * size)
    pairs[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    pairs = pairs.reshape(size, size)
    group = exchange(pairs, min(MOST_CLASSES, max(CLASSES, isqrt(kinds) // ROOT)))
    start = spark.sparkContext.broadcast((frequent, group, class_table(pairs, group)))
    seen = learned.mapInArrow(_contexts(start), "h long, ks array<int>, ns array<long>")
    rows = counts.select("h", "n", "ending").unionByName(seen, allowMissingColumns=True).repartition("h").sortWithinPartitions("h")
    words = saved(rows.mapInArrow(_classed(start), "h long, n long, class int"), "word-classes")
    top = frequent_words(words, COMMON).toArrow()
    h, n, classes = (top.column(c).to_numpy() for c in ("h", "n", "class"))
    order = np.argsort(h.view(np.uint64))
    model = Model(h.view(np.uint64)[order], n[order], classes[order].astype(np.int64), frequent, group)
    # transitions between the classes of all words
    width = model.width
    links = saved(learned.mapInArrow(_class_pairs(spark.sparkContext.broadcast(model.parts())), LINKS + ", pairs long"), "class-links")
    rest = met(links.filter("h IS NOT NULL"), words).filter("a >= 0 AND b >= 0").select((F.col("a").cast("long") * width + F.col("b")).alias("pair"), F.col("n").cast("long").alias("n"))
    sums = links.filter("h IS NULL").select(F.col("h2").alias("pair"), F.col("pairs").alias("n")).union(rest).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(width * width)
    table[sums.column("pair").to_numpy()] = sums.column("n").to_numpy()
    table = table.reshape(width, width)
    mass = table.sum(axis=0) + ADDED
    transition = np.log10((table + PRIOR * mass / mass.sum()) / (table.sum(axis=1, keepdims=True) + PRIOR))
    different = np.zeros(width)
    for r in words.groupBy("class").agg(F.count(F.lit(1)).alias("words")).collect():
        different[r["class"]] = r["words"]
    class_term = np.log10(table.sum(axis=0) + ADDED * (different + 1))
    texts = int(table[:, -1].sum())
    # the end is the only word of its class: log10((c + 0.1) / (c + 0.1)) = 0
    class_term[-1] = np.log10(texts + ADDED)
    model.value, model.end_count = transition - class_term, texts
    return model, words, int(n_words) + texts, kinds + (1 if texts else 0)


def _terms(shared):
    """Per text one row with all that is known here, and the links of its words that are not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        end_log = np.log10(model.end_count + ADDED)
        names = ["rid", *(c.split()[0] for c in LINKS.split(", ")), "own"]
        for batch in slices(batches):
            words, different, ending, place = hashed(batch.column("text"))
            here, count, classes = model.of(different, ending)
            n = batch.num_rows
            (row, before, now), alone, two = linked(words, place, here, classes, model.width - 1)
            rest = np.bincount(row, weights=model.value[before, now], minlength=n).astype(float)
            text, here_word = words.row_of(), here[place]
            log = np.bincount(text, weights=np.where(here_word, np.log10(count[place] + ADDED), 0), minlength=n) + end_log
            known = np.bincount(text, weights=here_word, minlength=n).astype(np.int64) + (model.end_count > 0)
            tokens = np.diff(words.first) + 1
            rid = batch.column("__rid").to_numpy()
            own = pa.StructArray.from_arrays([batch.column("doc_id"), pa.array(tokens.astype(np.int64)), pa.array(known), pa.array(log), pa.array(rest)], ["doc_id", "tokens", "known", "log", "rest"])
            yield pa.RecordBatch.from_arrays([pa.array(rid), *[pa.nulls(n, pa.int64())] * 2, *[pa.nulls(n, pa.int32())] * 5, own], names)
            columns = link_columns(different, classes, alone, two)
            yield pa.RecordBatch.from_arrays([pa.array(rid[np.concatenate([alone[0], two[0]])]), *columns, pa.nulls(len(columns[0]), own.type)], names)

    return run


OWN = "struct<doc_id:bigint,tokens:bigint,known:bigint,log:double,rest:double>"


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    model, words, total, kinds = train(docs)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("__rid"))
    terms = saved(rows.mapInArrow(_terms(spark.sparkContext.broadcast(model.parts())), f"rid long, {LINKS}, own {OWN}"), "terms")
    width = model.width
    steps = spark.createDataFrame(pa.table({"step": np.arange(width * width), "value": model.value.reshape(-1)}))
    rare = met(terms.filter("h IS NOT NULL").drop("own"), words, "rid")
    # a neighbour that is not here either is -1: that pair has a row of its own
    step = F.when((F.col("a") >= 0) & (F.col("b") >= 0), F.col("a").cast("long") * width + F.col("b"))
    rare = rare.withColumn("step", step).join(F.broadcast(steps), "step", "left").select(
        "rid", F.lit(None).cast(OWN).alias("own"),
        F.when(F.col("c").isNotNull(), F.col("word").cast("long")).alias("known"),
        (F.col("word") * F.log10(F.coalesce("c", F.lit(0)) + ADDED)).alias("log"), (F.col("n") * F.col("value")).alias("rest"),
    )
    own = terms.filter("own IS NOT NULL").select("rid", "own", "own.known", "own.log", "own.rest")
    summed = own.union(rare).groupBy("rid").agg(
        F.max("own.doc_id").alias("doc_id"), F.count("own").alias("copies"), F.max("own.tokens").alias("n_tokens"),
        F.sum(F.coalesce("known", F.lit(0))).alias("known"), F.sum("log").alias("log"), F.sum("rest").alias("rest"),
    )
    # equal rows were summed together
    out = summed.withColumn("log", F.col("log") / F.col("copies")).withColumn("rest", F.col("rest") / F.col("copies")).withColumn("n_known", F.expr("known div copies"))
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log") - F.col("n_tokens") * float(np.log10(total + ADDED * (kinds + 1)))).alias("base_score"), (F.col("log") + F.col("rest")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read_table(spark, sf_dir, "documents"))
