"""Word-level BPE encoding and decoding through a minimal acyclic transducer of the corpus' frequent words.

Method: Spark counts the units of all texts (runs that the tokenizer never joins), takes the most frequent up to `rows` by a
histogram of counts, and segments those once, in tasks. Their transducer (`lexicon`) is written to the shared folder, handed
to every executor as a file, and mapped into memory by its workers. A batch looks its distinct units up all at once; units
that the transducer doesn't hold are merged exactly by the tokenizer's own merges. Which units are in the transducer changes
the time, never the ids.

Bounds: the transducer holds at most `rows` words of at most `LONGEST` bytes, which bounds what the driver builds; workers keep
merged unseen units in a table that starts anew when full; texts pass in slices and are never cut.

Odd input: null and empty texts have no ids and decode to empty text; repeated rows give repeated results; a null doc_id stays;
a text of any length is encoded whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.lexicon import Builder, Lexicon, expanded
from lectern.llm.tables import read_table, saved
from lectern.llm.word_ids import WordTable, units
from lectern.llm.words import slices, words_of
from lectern.session import shared_path

#: Most words in the transducer, and their most bytes.
ROWS = 100_000
LONGEST = 48
#: Bytes of text whose units are counted together, or looked up together.
COUNT_BYTES = 8 << 20
LOOKUP_BYTES = 2 << 20
#: Hash buckets in which equally frequent words are dealt out where only some of them have room.
BUCKETS = 4096
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=COUNT_BYTES):
        found = units(words_of(batch.column("text"))).packed()
        if len(found):
            seen = pc.value_counts(found)
            word, n = seen.field("values"), seen.field("counts")
            short = pc.less_equal(pc.binary_length(word), LONGEST)
            yield pa.RecordBatch.from_arrays([word.filter(short).cast(pa.binary()), n.filter(short)], ["word", "n"])


def frequent_units(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """(word, n) of at most `rows` units, the most frequent of all texts; equally frequent ones by hash."""
    counts = docs.select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = saved(counts, "units")
    # counts of one share a band up to 64; beyond, an eighth of an octave does
    band = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.lit(64 - 48) + F.floor(F.log2("n") * 8)).cast("long")
    counts = counts.withColumn("band", band)
    room, least, part = rows, 0, None
    for r in sorted(counts.groupBy("band").count().collect(), key=lambda r: -r["band"]):
        if r["count"] > room:
            least, part = r["band"] + 1, r["band"]
            break
        room -= r["count"]
    keep = F.col("band") >= least
    if part is not None:
        bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
        sizes = {r["b"]: r["count"] for r in counts.filter(F.col("band") == part).groupBy(bucket.alias("b")).count().collect()}
        taken = np.cumsum([sizes.get(b, 0) for b in range(BUCKETS)])
        keep |= (F.col("band") == part) & (bucket < int(np.searchsorted(taken, room, side="right")))
    return counts.filter(keep).select("word", "n")


def _segmented(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(path)
        for batch in batches:
            word = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.binary()), pa.array([table.ids(w.decode()) for w in word], pa.list_(pa.int32()))], ["word", "ids"])

    return run


def build_lexicon(docs: DataFrame, path: str | None = None, rows: int = ROWS) -> str:
    """Compile the frequent units of docs; returns the name under which every executor finds the file."""
    spark = docs.sparkSession
    found = frequent_units(docs, rows).select("word").mapInArrow(_segmented(path), "word binary, ids array<int>").toArrow()
    builder = Builder()
    word, ids = found.column("word").combine_chunks(), found.column("ids").combine_chunks()
    for i in pc.sort_indices(word).to_pylist():
        builder.add(word[i].as_py(), ids[i].as_py())
    return shipped(spark, builder.file())


def shipped(spark: SparkSession, content: bytes) -> str:
    """Write a file to the shared folder and hand it to all executors, those that start later too."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    target = f"{shared_path(spark, 'llm-lexicon')}/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(content)
    out.close()
    spark.sparkContext.addFile(path.toUri().toString() if path.toUri().getScheme() else target)
    return name


class Codec:
    """Ids of text batches: the transducer first, exact merges for what it doesn't hold."""

    def __init__(self, lexicon: Lexicon, path: str | None = None, rows: int = ROWS):
        self.lexicon, self.unseen = lexicon, WordTable(path, rows)
        count = self.unseen.tokenizer.get_vocab_size()
        self.names = pa.array([self.unseen.tokenizer.id_to_token(i) for i in range(count)], pa.large_string())
        self.digits = pa.array([str(i) for i in range(count)], pa.large_string())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text begins in them)."""
        words = units(words_of(texts))
        listed = words.packed().dictionary_encode()
        if not len(listed):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        known, size, flat = self.lexicon.lookup(listed.dictionary)
        begin = np.cumsum(size) - size
        if not known.all():
            new = np.flatnonzero(~known)
            slots = self.unseen.slots(listed.dictionary.take(pa.array(new)).to_pylist())
            size[new] = self.unseen.size[slots]
            begin[new] = len(flat) + self.unseen.begin[slots]
            flat = np.concatenate([flat, self.unseen.flat])
        places = listed.indices.to_numpy(zero_copy_only=False)
        before = np.zeros(len(places) + 1, dtype=np.int64)
        np.cumsum(size[places], out=before[1:])
        return flat[expanded(begin[places], size[places])], before[words.first]

    def joined(self, ids: np.ndarray, first: np.ndarray, parts: pa.Array) -> pa.Array:
        """parts[id] of every id, joined by one space per text."""
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), parts.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(" ", parts.type))


def _codes(name: str, path: str | None, whole: bool):
    def digest(texts: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Lexicon(SparkFiles.get(name)), path)
        for batch in slices(batches, limit=LOOKUP_BYTES):
            ids, first = codec.encode(batch.column("text"))
            plain = codec.joined(ids, first, codec.names)
            if whole:
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, plain.cast(pa.string())], ["doc_id", "ids", "decoded"])
            else:
                digits = codec.joined(ids, first, codec.digits)
                columns = [batch.column("doc_id"), pa.array(np.diff(first)), digest(digits), digest(plain)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_table(docs: DataFrame, path: str | None = None, rows: int = ROWS) -> DataFrame:
    """(doc_id, ids, decoded) of every text."""
    run = _codes(build_lexicon(docs, path, rows), path, True)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_tokens, digests of ids and decoded text): the ids stay in the task."""
    return docs.select("doc_id", "text").mapInArrow(_codes(build_lexicon(docs, path, rows), path, False), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"))
