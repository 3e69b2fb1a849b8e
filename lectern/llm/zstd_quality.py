"""Quality scores by compression: how much better a text compresses with a dictionary of good texts than with one of bad texts.

Method: two zstandard dictionaries are built, from labelled good and bad text. A text is compressed in blocks of `BLOCK` bytes
with each (all blocks, to the end, so that a long text cannot drown the dictionaries in its own repetitions); the difference
of the two sizes over the size of the text, held back a little for very short texts, goes through a logistic curve
fitted on labelled rows that the dictionaries have not seen.

Labels come from rows whose crc32(doc_id) mod 4 is not 2, and of those from the `SAMPLE` rows with the smallest hash of
doc_id. Half of them give the dictionaries (at most `PIECES` blocks of `PIECE` bytes a class, drawn by hash over whole texts), half
the curve. Scores cover every whole text in one pass without a shuffle.

Odd input: null and empty texts have difference 0 and get the score of the curve there; labels that are null are left out (the
larger is taken if two differ); with labels of one kind only, or too few for a dictionary, every score is the smoothed rate
of good labels; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.tables import read_table
from lectern.llm.toxicity import held_out, sample_of
from lectern.llm.words import slices, text_bytes

SAMPLE = 20_000
PIECES, PIECE = 6000, 2000
DICTIONARY = 65_536
BLOCK = 512
LEVEL = 3
#: Bytes added to the size of a text: the difference of a very short one says little.
HOLD = 64
THRESHOLD = 0.7


def dictionary(pieces: list[bytes], size: int = DICTIONARY) -> bytes | None:
    """A trained dictionary, None if there is too little text for one."""
    import zstandard

    size = min(size, sum(map(len, pieces)) // 8)
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes() if size >= 1024 and len(pieces) >= 8 else None
    except zstandard.ZstdError:
        return None


def differences(data: np.ndarray, offsets: np.ndarray, good: bytes, bad: bytes) -> np.ndarray:
    """Per text (size with the bad dictionary - size with the good one) / (bytes + HOLD)."""
    import zstandard

    packers = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (good, bad)]
    body, out = data.tobytes(), []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        gain = 0
        for at in range(lo, hi, BLOCK):
            block = body[at : min(at + BLOCK, hi)]
            gain += len(packers[1].compress(block)) - len(packers[0].compress(block))
        out.append(gain / (hi - lo + HOLD))
    return np.array(out)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        labels, pieces = [], []
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            body = (text or "").encode()
            cut = [body[at : at + PIECE] for at in range(0, len(body), PIECE)]
            labels += [label] * len(cut)
            pieces += cut
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(pieces, pa.binary())], ["label", "piece"])


def _differences(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = differences(*text_bytes(batch.column("text")), *model.value)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found)], ["label", "x"])

    return run


def curve(x: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float, float]:
    """(slope, bias, scale) of the logistic curve, by Newton steps with a small ridge."""
    scale = float(x.std()) or 1.0
    design = np.column_stack([x / scale, np.ones(len(x))])
    value = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ value, -30, 30)))
        slope = design.T @ (p - label) + 1e-2 * value
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        value = value - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(value[0]), float(value[1]), scale


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE):
    """(good dictionary, bad dictionary, curve); without dictionaries the curve is flat."""
    spark = docs.sparkSession
    sample = sample_of(docs, labels, "quality", rows)
    total = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    rate = (int(total[1]) + 0.5) / (int(total[0]) + 1)
    flat = (None, None, (0.0, float(np.log(rate / (1 - rate))), 1.0))
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)) == 0
    cut = sample.filter(half).mapInArrow(_pieces, "label int, piece binary")
    built = []
    for label in (1, 0):
        chosen = cut.filter(F.col("label") == label).orderBy(F.xxhash64("piece"), "piece").limit(PIECES).collect()
        built.append(dictionary([bytes(r["piece"]) for r in chosen]))
    if None in built:
        return flat
    model = spark.sparkContext.broadcast(tuple(built))
    seen = sample.filter(~half).mapInArrow(_differences(model), "label int, x double").toArrow()
    label = seen.column("label").to_numpy().astype(float)
    if not 0 < label.sum() < len(label):
        return flat
    return (*built, curve(seen.column("x").to_numpy(), label))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, (slope, bias, scale) = model.value
        for batch in slices(batches):
            x = differences(*text_bytes(batch.column("text")), good, bad) if good else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(slope * x / scale + bias, -500, 500))))], [*batch.schema.names, "__score"])

    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with __score."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", __score double"
    return docs.mapInArrow(_scores(model), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
