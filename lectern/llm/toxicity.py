"""Toxicity scores by a classifier that is regularised against its own counterfactuals.

Method: a logistic model over the presence of words and word beginnings. Every labelled training text gets two counterfactuals:
one mentions a group of people at a place that a hash of the text picks (beside the mentions it has already), the other is that
one with every mention swapped for another group. The squared changes of the logit by the mention and by the swap are part of the
loss, so a group's name can't carry a score, however often labelled insults mention it, and a neutral mention changes nothing.

Labels come from rows whose crc32(doc_id) mod 4 is not 2, and of those from the `SAMPLE` rows with the smallest hash of
doc_id (all of them while there are fewer). Spark counts in how many toxic and other sample texts each feature occurs; the
`FEATURES` that tell them apart best make the model, which is fitted on sparse rows of those features only. Scores cover
every whole text in one pass without a shuffle.

Odd input: null and empty texts have no feature and get the score of the bias alone; labels that are null or given twice for a
row are left out (the larger is taken if two differ); a label whose document is missing is ignored; with labels of one kind
only, or none, every score is the smoothed rate of toxic labels; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.tables import read_table, saved
from lectern.llm.words import BYTE_CODE, NO_LETTER, mix, run_hashes, slices, words_of

#: Labelled rows the model is fitted on, at most.
SAMPLE = 20_000
#: Features of the model, at most.
FEATURES = 4096
#: Sample texts a feature must occur in, and standard errors by which its shares in toxic and other texts must differ.
LEAST, APART = 3, 4.0
THRESHOLD = 0.3
#: Word beginnings that count as features, in bytes.
BEGINNINGS = (4, 5, 6)
RIDGE, FAIRNESS = 1e-4, 1.0
#: Lists of feature places per sample text: its own; what a mention adds and takes; what a swap adds and takes.
PARTS = ("own", "named_adds", "named_takes", "swap_adds", "swap_takes")
#: Names of groups that a text may mention neutrally; each is swapped for the next of its row.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("lesbian", "gay", "straight", "bisexual", "transgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "arab"), ("immigrants", "refugees", "natives"),
    ("disabled", "deaf", "blind", "elderly"),
    ("frauen", "männer"), ("christen", "muslime", "juden", "buddhisten"), ("einwanderer", "flüchtlinge"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs", "bouddhistes"), ("immigrés", "réfugiés"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos", "budistas"), ("inmigrantes", "refugiados"),
)


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def swaps() -> dict[str, str]:
    return {a: b for row in IDENTITY for a, b in zip(row, row[1:] + row[:1])}


def swapped(text: str) -> str:
    """text with every group name swapped; as it is if it has none."""
    import regex

    names = swaps()
    return regex.sub(r"\p{L}+", lambda m: names.get(m[0].lower(), m[0]), text)


def mentioning(text: str) -> str:
    """text with one more group name, put behind a word; hashes of the text pick the word and the name."""
    from xxhash import xxh64_intdigest

    body, names = text.encode("utf-8", "surrogatepass"), sorted(swaps())
    at = text.find(" ", xxh64_intdigest(body, 1) % (len(text) + 1))
    at = len(text) if at < 0 else at
    return f"{text[:at]} {names[xxh64_intdigest(body, 2) % len(names)]} {text[at:]}"


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word and word beginning."""
    words = words_of(texts, lower=True, apart=NO_LETTER)
    codes, row, size = BYTE_CODE[words.data], words.row_of(), words.end - words.start
    rows, found = [row], [run_hashes(codes, words.start, words.end)]
    for length in BEGINNINGS:
        long = np.flatnonzero(size > length)
        rows.append(row[long])
        found.append(mix(run_hashes(codes, words.start[long], words.start[long] + length) ^ np.uint64(length)))
    return np.concatenate(rows), np.concatenate(found)


def present(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same, each feature once per text."""
    row, code = features(texts)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return row[new], code[new]


def known(row: np.ndarray, code: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place in the sorted chosen features), each pair once."""
    if not len(chosen):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(chosen, code)
    at[at == len(chosen)] = 0
    hit = chosen[at] == code
    pair = np.unique(row[hit] * len(chosen) + at[hit])
    return pair // len(chosen), pair % len(chosen)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        row, code = present(batch.column("text"))
        code, at, count = np.unique(code, return_inverse=True, return_counts=True)
        toxic = np.bincount(at, weights=batch.column("label").to_numpy()[row], minlength=len(code)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(count), pa.array(toxic)], ["code", "n", "toxic"])


def _lists(pair: np.ndarray, rows: int, width: int) -> pa.ListArray:
    """One list of places per text from sorted row * width + place."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(pair // max(1, width), minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((pair % max(1, width)).astype(np.int32)))


def _rows(chosen: np.ndarray):
    """Sample texts as places of chosen features, and the places in which their counterfactuals differ."""
    width = len(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [t or "" for t in batch.column("text").to_pylist()]
            with_name = [mentioning(t) for t in own]
            found = []
            for version in (own, with_name, [swapped(t) for t in with_name]):
                row, place = known(*features(pa.array(version, pa.large_string())), chosen)
                found.append(row * width + place)
            plain, named, other = found
            changes = [np.setdiff1d(named, plain), np.setdiff1d(plain, named), np.setdiff1d(other, named), np.setdiff1d(named, other)]
            lists = [_lists(pair, len(own), width) for pair in (plain, *changes)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *lists], ["label", *PARTS])

    return run


class Sparse:
    """Rows of feature places (an Arrow column of lists), multiplied with numpy."""

    def __init__(self, rows: pa.ChunkedArray | pa.Array, width: int):
        chunks = rows.chunks if isinstance(rows, pa.ChunkedArray) else [rows]
        size = np.concatenate([np.empty(0, np.int64)] + [np.diff(c.offsets.to_numpy()) for c in chunks])
        self.row = np.repeat(np.arange(len(size)), size)
        self.place = np.concatenate([np.empty(0, np.int64)] + [c.flatten().to_numpy() for c in chunks])
        self.shape = (len(size), width)

    def times(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weight[self.place], minlength=self.shape[0])

    def back(self, value: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, weights=value[self.row], minlength=self.shape[1])


def fit(rows: pa.Table, width: int, fairness: float = FAIRNESS, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss + ridge + fairness x mean squared logit changes of the counterfactuals (Adam steps).

    rows: label and the lists of `PARTS`: the text's own features, those that the mention adds and takes, those that the swap
    adds and takes. A change of the logit is a difference of weights, so only the places that differ are multiplied.
    """
    label = rows.column("label").to_numpy().astype(float)
    x, *sides = [Sparse(rows.column(part), width) for part in PARTS]
    rate = (label.sum() + 0.5) / (len(label) + 1)
    value = np.zeros(width + 1)
    value[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        weight, bias = value[:-1], value[-1]
        error = (1 / (1 + np.exp(-(x.times(weight) + bias))) - label) / max(1, len(label))
        slope = np.append(x.back(error) + RIDGE * weight, error.sum())
        for adds, takes in (sides[:2], sides[2:]):
            change = 2 * fairness * (adds.times(weight) - takes.times(weight)) / max(1, len(label))
            slope[:-1] += adds.back(change) - takes.back(change)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        pace = 0.1 * (1 - step / (steps + 1))
        value -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return value[:-1], float(value[-1])


def sample_of(docs: DataFrame, labels: DataFrame, column: str, rows: int = SAMPLE) -> DataFrame:
    """(text, label) of the labelled training rows with the smallest hashes; at most `rows` ids are broadcast."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return saved(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label").repartition(max(1, rows // 1000)), "sample")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, width: int = FEATURES, least: int = LEAST, fairness: float = FAIRNESS):
    """(chosen feature hashes, sorted; weights; bias)."""
    sample = sample_of(docs, labels, "toxic", rows)
    total = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    n, toxic = int(total[0]), int(total[1])
    if toxic == 0 or toxic == n:
        rate = (toxic + 0.5) / (n + 1)
        return np.empty(0, np.uint64), np.empty(0), float(np.log(rate / (1 - rate)))
    counts = sample.mapInArrow(_counted, "code long, n long, toxic long").groupBy("code").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    among, rest, share = F.col("toxic") / toxic, (F.col("n") - F.col("toxic")) / (n - toxic), F.col("n") / n
    apart = F.abs(among - rest) / F.sqrt(share * (1 - share) * (1 / toxic + 1 / (n - toxic)))
    best = counts.filter((F.col("n") >= least) & (F.col("n") < n)).withColumn("apart", apart).filter(F.col("apart") >= APART)
    best = best.orderBy(F.col("apart").desc(), "code").limit(width).collect()
    names = name_features()
    chosen = np.unique(np.concatenate([np.array([r["code"] for r in best], dtype=np.int64).view(np.uint64), names]))
    found = sample.mapInArrow(_rows(chosen), "label int, " + ", ".join(f"{part} array<int>" for part in PARTS)).toArrow()
    weight, bias = fit(found, len(chosen), fairness)
    return chosen, weight, bias


def name_features() -> np.ndarray:
    """Feature hashes of the group names: always in the model, so that their weights are held down."""
    return np.unique(features(pa.array(sorted(swaps())))[1])


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weight, bias = model.value
        for batch in slices(batches):
            row, place = known(*features(batch.column("text")), chosen)
            logit = bias + np.bincount(row, weights=weight[place], minlength=batch.num_rows) if len(row) else np.full(batch.num_rows, bias)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(logit, -500, 500))))], [*batch.schema.names, "__score"])

    return run


def _counterfactuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        own = [t or "" for t in batch.column("text").to_pylist()]
        named = [mentioning(t) for t in own]
        for kind, texts in (("own", own), ("named", named), ("swapped", [swapped(t) for t in named])):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([kind] * len(texts)), pa.array(texts)], ["doc_id", "version", "text"])


def counterfactual_scores(docs: DataFrame, trained) -> DataFrame:
    """(doc_id, version, text, __score) of each text, of the text with a mention and of that with its mentions swapped."""
    texts = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_counterfactuals, "doc_id long, version string, text string")
    return _with_scores(texts, trained)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with __score."""
    return _with_scores(docs, train(docs, labels))


def _with_scores(docs: DataFrame, trained) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(trained)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", __score double"
    return docs.mapInArrow(_scores(model), schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents below the threshold stay, unchanged."""
    return scored(docs, read_table(spark, sf_dir, "labels")).filter(F.col("__score") < THRESHOLD).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
