"""Repair of damaged conversations at least cost, by a dynamic programme over a grammar of their rows.

A conversation's rows should have the role initials (s?(ua)+)?. A row's first fault counts: blank (no character but white
space), duplicate (role and text seen in an earlier row), truncated (last such character isn't . ! or ?). Keeping a row costs 0,
giving it the role user or assistant 2, deleting it 3 (blank and duplicate rows must go), inserting an empty row of either role 2;
a truncated row that stays costs 1 more. Of all cheapest edits the one with the ASCII-least initials (K, R, D, I) counts.

Method: slim rows without text are grouped by their whole key, which folds hot repeats before the shuffle; a second grouping finds the
first turn of every (role, text). The rows are dealt by ranges of conversation and turn, so that a conversation may span many
tasks, and become sequences of at most `SEGMENT` symbols. Tasks build a Re-Pair grammar (`repair_grammar`) over the different
sequences of a batch of conversations, one min-plus matrix with audit ropes per rule, shared by all conversations, and pass each
conversation's states through its symbols. Last, the texts are shuffled once, behind the audit of their conversation, and hashed row by row.

Bounds: memory per task holds one batch of sequences (`BATCH` symbols), one audit and one batch of texts. A conversation's audit is one
value and its digest one hash over its text, so those two are sequential per conversation by definition.

Odd input: a null role or text is one space, a null conv_id is a conversation of its own, null turns come first; rows of one
turn stand in the order of role, the first `HEAD` characters and MD5 of the text, equal rows next to each other; a conversation without rows
after damage has zeros and an empty audit; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.repair_grammar import BEGUN, CUT, DELETE, GONE, INSERT, KEEP, NEXT, ROLE_OF, START, WHOLE, Grammar, Matrix, ended
from lectern.llm.tables import read_table, saved

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
STOPS = ".!?"
#: Damage by crc32 of conversation and turn.
DAMAGE = 20
DROP, EMPTY_TEXT, NO_STOPS, TWICE, AS_USER = range(5)
HEAD = 32
#: Rows of one sequence; symbols of different sequences that share a grammar.
SEGMENT = 4096
BATCH = 1 << 16
KEY = ("conv_id", "turn", "role", "head", "md5")
SEGMENTS = (
    "conv_id long, part int, no int, symbols string, blank long, duplicate long, truncated long, illegal long, "
    "first_role int, last_role int, first_turn long, last_turn long, low long, high long, turns long"
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
DIGESTS = f"{RESULT}, repaired_sha256 string"
ROWS = "conv_id long, place long, edit string, role string, text string"
LEGAL = ("su", "ua", "au")
ROLES = "suax"


def with_nulls_as_space(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows after damage; dropped ones stay with 0 copies."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *said).cast("binary")) % DAMAGE
    return (
        with_nulls_as_space(conversations)
        .withColumn("kind", kind)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == EMPTY_TEXT, "").when(F.col("kind") == NO_STOPS, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
            F.when(F.col("kind") == DROP, 0).when(F.col("kind") == TWICE, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.substring("text", 1, HEAD), "md5": F.md5(F.col("text").cast("binary"))})


def _order() -> list[Column]:
    return [F.asc_nulls_first(c) for c in KEY]


def faults(rows: DataFrame) -> DataFrame:
    """One row per different (conv_id, turn, role, text): copies, blank, cut, and whether (role, text) comes here first."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    slim = _keyed(rows).groupBy(*KEY).agg(
        F.sum("copies").alias("copies"),
        F.bool_or(bare == "").alias("blank"),
        F.bool_or(~F.right(bare, F.lit(1)).isin(*STOPS)).alias("cut"),
    )
    slim = saved(slim, "rows").withColumn("first", F.lit(False))
    early = F.when(F.bool_or(F.col("turn").isNull()), None).otherwise(F.min("turn"))
    firsts = slim.filter("copies > 0").groupBy("conv_id", "role", "head", "md5").agg(early.alias("turn"))
    marks = firsts.select(*KEY, F.lit(0).cast("long").alias("copies"), F.lit(False).alias("blank"), F.lit(False).alias("cut"), F.lit(True).alias("first"))
    return slim.select(marks.columns).union(marks).groupBy(*KEY).agg(
        F.sum("copies").alias("copies"), F.bool_or("blank").alias("blank"), F.bool_or("cut").alias("cut"), F.bool_or("first").alias("first")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Rows one by one as arrays, copies written out, in pieces of one conversation and at most SEGMENT rows."""
    for batch in batches:
        initial = [ROLES.find(r[:1]) if r else 3 for r in batch.column("role").to_pylist()]
        initial = np.array([3 if i < 0 else i for i in initial], np.int64)
        flag = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("blank", "cut", "first")}
        copies = batch.column("copies").to_numpy(zero_copy_only=False)
        conv, turn = batch.column("conv_id"), batch.column("turn")
        null_turn = turn.is_null().to_numpy(zero_copy_only=False)
        turn = turn.fill_null(0).to_numpy(zero_copy_only=False)
        listed = conv.to_pylist()
        at = 0
        while at < len(listed):
            to, room = at, SEGMENT
            while to < len(listed) and listed[to] == listed[at] and (to == at or copies[to] <= room):
                room -= copies[to]
                to += 1
            left = copies[at:to].copy()
            new = flag["first"][at:to].copy()
            while True:
                # a row with more copies than a piece holds goes on in the next one
                now = np.minimum(left, SEGMENT) if len(left) == 1 else left
                row = np.repeat(np.arange(at, to), now)
                begins = np.zeros(len(row), dtype=bool)
                begins[(np.cumsum(now) - now)[now > 0]] = new[now > 0]
                yield {"conv": listed[at], "initial": initial[row], "blank": flag["blank"][row], "cut": flag["cut"][row], "new": begins, "turn": turn[row], "null": null_turn[row]}
                left = left - now
                new[:] = False
                if not left.any():
                    break
            at = to


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    legal = np.array([[a + b in LEGAL for b in ROLES] for a in ROLES])
    letters = np.frombuffer((WHOLE + CUT + GONE).encode(), np.uint8)
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        names = [f.split()[0] for f in SEGMENTS.split(", ")]
        kinds = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.split()[1]] for f in SEGMENTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for no, p in enumerate(_pieces(batches)):
        blank = p["blank"]
        again = ~blank & ~p["new"]
        cut = ~blank & ~again & p["cut"]
        symbol = np.where(blank | again, 8, p["initial"] + 4 * cut)
        who = p["initial"]
        illegal = int((~legal[who[:-1], who[1:]]).sum()) if len(who) else 0
        turn = p["turn"][~p["null"]]
        # turns ascend, so a piece's different turns are its steps
        turns = int((turn[1:] != turn[:-1]).sum()) + 1 if len(turn) else 0
        ends = (int(turn[0]), int(turn[-1])) if len(turn) else (None, None)
        roles = (int(who[0]), int(who[-1])) if len(who) else (None, None)
        out.append((p["conv"], part, no, letters[symbol].tobytes().decode(), int(blank.sum()), int(again.sum()), int(cut.sum()), illegal, *roles, *ends, *ends, turns))
        if len(out) >= 4096:
            yield flush()
            out = []
    if out:
        yield flush()


class _Conversation:
    """What is known of a conversation after some of its segments."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.counts = [0, 0, 0, 0]
        self.last_role = self.low = self.high = None
        self.turns = 0
        self.rows = 0
        self.reached: Matrix = BEGUN

    def add(self, seg: dict, reached: Matrix) -> None:
        for i, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[i] += seg[c]
        if seg["first_role"] is not None:
            if self.last_role is not None and ROLES[self.last_role] + ROLES[seg["first_role"]] not in LEGAL:
                self.counts[3] += 1
            self.last_role = seg["last_role"]
        if seg["low"] is not None:
            self.turns += seg["turns"] - (self.high == seg["low"])
            self.low = seg["low"] if self.low is None else self.low
            self.high = seg["high"]
        self.rows += len(seg["symbols"])
        self.reached = reached

    def result(self) -> tuple:
        cost, audit = ended(self.reached) if self.rows else ended(BEGUN)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        blank, duplicate, truncated, illegal = self.counts
        return self.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.text()


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Segments in order, cut where the different sequences hold BATCH symbols."""
    now: list[dict] = []
    seen: set[str] = set()
    held = 0
    for batch in batches:
        for seg in batch.to_pylist():
            now.append(seg)
            if seg["symbols"] not in seen:
                seen.add(seg["symbols"])
                held += len(seg["symbols"])
            if held >= BATCH or len(now) >= BATCH:
                yield now
                now, seen, held = [], set(), 0
    if now:
        yield now


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*rows)] or [()] * 8
        names = [f.split()[0] for f in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "audit" else pa.int64()) for c, n in zip(columns, names)], names)

    now: _Conversation | None = None
    for segments in _batched(batches):
        grammar = Grammar(sorted({s["symbols"] for s in segments}))
        begun: dict[str, Matrix] = {}
        out = []
        for seg in segments:
            if now is None or now.conv_id != seg["conv_id"]:
                if now is not None:
                    out.append(now.result())
                now = _Conversation(seg["conv_id"])
            text = seg["symbols"]
            if now.reached is BEGUN:
                # equal first sequences are passed through once
                if text not in begun:
                    begun[text] = grammar.advanced(BEGUN, text)
                now.add(seg, begun[text])
            else:
                now.add(seg, grammar.advanced(now.reached, text))
        yield table(out)
    if now is not None:
        yield table([now.result()])


def costs(rows: DataFrame) -> DataFrame:
    """Counts, least cost and audit of every conversation; rows: as `damaged` returns them."""
    ordered = faults(rows).repartitionByRange(*_order()).sortWithinPartitions(*_order())
    segments = ordered.mapInArrow(_segments, SEGMENTS)
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no").mapInArrow(_costs, RESULT)


class _Repair:
    """Edits applied to the rows of one conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _new_role(self) -> str:
        return next(r for r in NEXT[self.state] if r in ROLE_OF)

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == INSERT:
            role = self._new_role()
            self.state, self.at = NEXT[self.state][role], self.at + 1
            yield INSERT, ROLE_OF[role], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            initial = role[0] if edit == KEEP else self._new_role()
            self.state = NEXT[self.state][initial]
            yield edit, role if edit == KEEP else ROLE_OF[initial], text


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    head = repair = digest = None
    lines = 0

    def add(found) -> None:
        nonlocal lines
        for _, role, text in found:
            digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
            lines += 1

    def close() -> tuple:
        add(repair.inserted())
        return *(head[n] for n in names[:-1]), digest.hexdigest()

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*rows)] or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("audit", names[-1]) else pa.int64()) for c, n in zip(columns, names)], names)

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["kind"] == 0:
                if head is not None:
                    out.append(close())
                head, repair, digest, lines = r, _Repair(r["audit"]), hashlib.sha256(), 0
            else:
                for _ in range(r["copies"]):
                    add(repair.row(r["role"], r["text"]))
        yield table(out)
    if head is not None:
        yield table([close()])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv = repair = None
    place = 0

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*rows)] or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in ROWS.split(", ")])

    for batch in batches:
        out = []

        def add(found) -> None:
            nonlocal place
            for edit, role, text in found:
                out.append((conv, place, edit, role, text))
                place += 1

        for r in batch.to_pylist():
            if r["kind"] == 0:
                if repair is not None:
                    add(repair.inserted())
                conv, repair, place = r["conv_id"], _Repair(r["audit"]), 0
            else:
                for _ in range(r["copies"]):
                    add(repair.row(r["role"], r["text"]))
        yield table(out)
    if repair is not None:
        yield table([(conv, place + i, *row) for i, row in enumerate(repair.inserted())])


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The texts of every conversation in order, behind its result."""
    texts = _keyed(rows).filter("copies > 0").withColumn("kind", F.lit(1))
    both = found.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    order = [F.asc_nulls_first(c) for c in ("conv_id", "kind", *KEY[1:])]
    return both.repartition("conv_id").sortWithinPartitions(*order)


def repair_digests(rows: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest of the repaired rows of every conversation; rows: (conv_id, turn, role, text, copies)."""
    return _stream(rows, saved(costs(rows), "costs")).mapInArrow(_digested, DIGESTS)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of every conversation after repair; edit is K, R or I."""
    return _stream(rows, saved(costs(rows), "costs")).mapInArrow(_rewritten, ROWS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(damaged(read_table(spark, sf_dir, "conversations")))
