"""Subword encoding and decoding through a table of distinct chunks.

Method: no piece of the model holds a whitespace marker after another character, so no merge crosses the start of a marked
word. A text is therefore the concatenation of its marked words (markers with the characters that follow), each segmented on
its own. Every task keeps a table of the distinct chunks it meets, segments each once with the library, and joins ids and
decoded text back by position with array lookups. The table stays beside its texts: joining all positions with one table of
the whole corpus would shuffle several times the input.

Odd input: null and empty texts have no ids and decode to empty text; repeated rows give repeated results; a text of any length
is encoded whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lectern.llm.tables import read_table
from lectern.llm.words import slices, text_bytes

MODEL = "piece_bpe_32k.model"
#: Chunks a task keeps before it starts a new table.
TABLE_ROWS = 300_000
MARK = "▁"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def model_file(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path(MODEL)


class ChunkTable:
    """Distinct chunks with their ids and decoded text; a chunk is a marked word without its first marker."""

    def __init__(self, path: str | None = None, rows: int = TABLE_ROWS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file(path))
        crossing = [p for p in map(self.model.id_to_piece, range(self.model.get_piece_size())) if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross whitespace markers: {crossing[:3]}")
        self.mark = [self.model.piece_to_id(MARK)]
        self.rows = rows
        self.clear()

    def clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.listed: list[bytes] = []
        self.plain: list[bytes] = []
        self.size = np.empty(0, np.int64)

    def slots(self, chunks: list[bytes]) -> np.ndarray:
        if len(self.slot) > self.rows:
            self.clear()
        new = [c for c in chunks if c not in self.slot]
        if new:
            found = self.model.encode([c.decode() for c in new], num_threads=1)
            found = [ids if c else self.mark for c, ids in zip(new, found)]
            self.slot.update(zip(new, range(len(self.ids), len(self.ids) + len(new))))
            self.ids += found
            self.listed += [",".join(map(str, ids)).encode() for ids in found]
            self.plain += [t.encode() for t in self.model.decode(found)]
            self.size = np.concatenate([self.size, np.fromiter(map(len, found), np.int64, len(found))])
        return np.fromiter(map(self.slot.__getitem__, chunks), np.int64, len(chunks))


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all chunks of the texts in order, first chunk of each text)."""
    data, offsets = text_bytes(texts)
    if MARK.encode() in data.tobytes():
        # a literal marker stands for a space, in the model and here
        plain = [(t or "").replace(MARK, " ") for t in texts.to_pylist()]
        data, offsets = text_bytes(pa.array(plain, pa.large_string()))
    space = data == 32
    head = np.zeros(len(data) + 1, dtype=bool)
    head[offsets[:-1]] = offsets[1:] > offsets[:-1]
    head = head[:-1]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = space[:-1]
    start = np.flatnonzero(head | (space & ~before))
    dropped = start[space[start] & ~head[start]]
    kept = np.ones(len(data), dtype=bool)
    kept[dropped] = False
    size = np.diff(np.append(start, len(data))) - (space[start] & ~head[start])
    ends = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=ends[1:])
    chunks = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data[kept])])
    return chunks, np.searchsorted(start, offsets)


def coded(texts: pa.Array, table: ChunkTable) -> Iterator[tuple[np.ndarray, ChunkTable]]:
    """Per text the table slots of its chunks."""
    chunks, first = chunks_of(texts)
    packed = chunks.dictionary_encode()
    slots = table.slots(packed.dictionary.to_pylist())
    places = slots[packed.indices.to_numpy(zero_copy_only=False)] if len(chunks) else np.empty(0, np.int64)
    for lo, hi in zip(first[:-1], first[1:]):
        yield places[lo:hi], table


def encode(texts: list[str | None], path: str | None = None) -> list[list[int]]:
    """Ids of each text."""
    table = ChunkTable(path)
    return [[i for s in places for i in t.ids[s]] for places, t in coded(pa.array(texts, pa.large_string()), table)]


def _digests(path: str | None, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(path, rows)
        for batch in slices(batches):
            count, ids, plain = [], [], []
            for places, t in coded(batch.column("text"), table):
                at = places.tolist()
                count.append(int(t.size[places].sum()))
                ids.append(hashlib.sha256(b",".join([t.listed[i] for i in at])).hexdigest())
                plain.append(hashlib.sha256(b" ".join([t.plain[i] for i in at])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(plain, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _pieces(path: str | None, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(path, rows)
        for batch in slices(batches):
            ids, plain = [], []
            for places, t in coded(batch.column("text"), table):
                at = places.tolist()
                ids.append([i for s in at for i in t.ids[s]])
                plain.append(b" ".join([t.plain[s] for s in at]).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(plain, pa.string())], ["doc_id", "ids", "decoded"])

    return run


def encode_table(docs: DataFrame, path: str | None = None, rows: int = TABLE_ROWS) -> DataFrame:
    """(doc_id, ids, decoded) of every text."""
    return docs.select("doc_id", "text").mapInArrow(_pieces(path, rows), "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None, rows: int = TABLE_ROWS) -> DataFrame:
    """(doc_id, n_tokens, digests of ids and decoded text): the ids stay in the task."""
    return docs.select("doc_id", "text").mapInArrow(_digests(path, rows), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"))
