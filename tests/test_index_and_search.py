import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.vectors import keyword_vector
from lectern.operators import answers, index, retrieval, search
from lectern.operators.chunking import chunk_spans, recursive_chunks
from lectern.operators.embed import embed_queries
from lectern.plans import catalog, ingest
from lectern.streaming import jobs


# --- splitter against a plain restatement of its rules ----------------------------------


def split_reference(text, size, overlap, separators):
    sep, rest = next(((s, separators[i + 1 :]) for i, s in enumerate(separators) if s == "" or s in text), ("", ()))
    if sep:
        parts = text.split(sep)
        pieces = [p for p in [parts[0], *[sep + p for p in parts[1:]]] if p]
    else:
        pieces = list(text)
    out, run = [], []

    def flush():
        window = []
        for piece in run:
            if window and sum(map(len, window)) + len(piece) > size:
                out.append("".join(window))
                while sum(map(len, window)) > overlap or (window and sum(map(len, window)) + len(piece) > size):
                    window.pop(0)
            window.append(piece)
        if window:
            out.append("".join(window))
        run.clear()

    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
        else:
            flush()
            out.extend(split_reference(piece, size, overlap, rest) if rest else [piece])
    flush()
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab .?!;\n", max_size=160), st.integers(4, 40), st.integers(0, 3))
def test_splitter_rules(text, size, overlap):
    ours = [text[a:b] for a, b in chunk_spans(text, 0, len(text), size, overlap, C.SEPARATORS)]
    theirs = split_reference(text, size, overlap, C.SEPARATORS) if text else []
    assert [x for x in map(str.strip, ours) if x] == [x for x in map(str.strip, theirs) if x]
    assert all(len(x.strip()) <= size for x in ours)
    spans = list(chunk_spans(text, 0, len(text), size, overlap, C.SEPARATORS))
    covered = {i for a, b in spans for i in range(a, b)}
    assert all(i in covered for i, ch in enumerate(text) if not ch.isspace())


# --- index ---------------------------------------------------------------------------------

PAGES = [
    (1, "tarih.txt", 0, "Tanzimat ferman 1839. " * 40, "tarih"),
    (2, "fizik.pdf", 1, "Newton kuvvet yasa. " * 30, "fizik"),
    (2, "fizik.pdf", 2, "   ", "fizik"),
    (2, "fizik.pdf", 3, "ivme ve eylemsizlik", "fizik"),
    (3, "tarih.txt", 0, "Tanzimat ferman 1839. " * 40, "tarih"),
    (4, "bos.txt", 0, " \n ", "genel"),
]
SCHEMA = "file_id long, source string, page_num int, text string, subject string"


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA)


def build(pages, existing=None):
    return ingest.index_documents(pages, recursive_chunks("text"), keyword_vector, existing=existing)


def test_index_numbers_chunks_over_the_document(pages):
    rows = build(pages).orderBy("doc_id", "chunk_index").collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    assert set(by_source) == {"tarih.txt", "fizik.pdf"}
    for found in by_source.values():
        assert [r["chunk_index"] for r in found] == list(range(len(found)))
        assert len({r["doc_id"] for r in found}) == 1
        assert [r["page_num"] for r in found] == sorted(r["page_num"] for r in found)
    assert by_source["fizik.pdf"][-1]["text"] == "ivme ve eylemsizlik" and by_source["fizik.pdf"][-1]["page_num"] == 3
    assert len({r["point_id"] for r in rows}) == len(rows)
    assert [r[0] for r in index.blank_files(pages).collect()] == [4]


def test_duplicate_skip_and_source_name(spark, pages):
    first = build(pages).cache()
    assert build(pages, existing=first).count() == 0
    other = pages.withColumn("source", F.concat(F.lit("yeni_"), "source"))
    assert build(other, existing=first).count() == first.count()
    changed = pages.withColumn("text", F.concat("text", F.lit("!")))
    assert build(changed, existing=first).count() > 0


def test_metadata_cannot_replace_automatic_fields(pages):
    points = index.build_points(
        index.new_documents(index.with_document_id(pages)), recursive_chunks("text"), keyword_vector, metadata=("subject", "source", "doc_id")
    )
    assert {r["source"] for r in points.collect()} == {"tarih.txt", "fizik.pdf"}


def test_upsert_replaces(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "point_id string, x int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "point_id string, x int")
    assert sorted(map(tuple, index.upsert(old, new).collect())) == [("a", 1), ("b", 3), ("c", 4)]
    twice = spark.createDataFrame([("b", 3, 1), ("b", 9, 2), ("c", 4, 1), ("c", 5, 0)], "point_id string, x int, v int")
    assert sorted(map(tuple, index.upsert(old, twice, order="v").collect())) == [("a", 1), ("b", 9), ("c", 4)]


def test_null_question_keeps_its_row(spark):
    asked = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "query_id long, text string")
    found = embed_queries(asked, "text", keyword_vector)
    assert sorted((r["query_id"], r["vector"] is None) for r in found.collect()) == [(1, False), (2, True), (3, False)]
    points = found.select(F.col("query_id").alias("point_id"), "vector")
    assert {r["query_id"] for r in search.top_k(points, found.select("query_id", "vector")).collect()} == {1, 3}


def test_query_with_unknown_gold_is_wrong(spark):
    points = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "point_id long, vector array<double>")
    asked = spark.createDataFrame([(10, [1.0, 0.0]), (11, [0.0, 1.0]), (12, [0.0, 1.0])], "query_id long, vector array<double>")
    gold = spark.createDataFrame([(10, 1), (11, 99), (12, 1)], "query_id long, gold_id long")
    found = retrieval.score_margins(search.top_k(points, asked, k=1), gold, asked, points)
    assert sorted((r["query_id"], r["ok"], r["gold_score"], r["margin"]) for r in found.collect()) == [(10, True, 1.0, 0.0), (11, False, None, None), (12, False, 0.0, 1.0)]
    assert retrieval.margin_summary(found).first()["wrong"] == 2


def test_list_documents_defaults(spark):
    rows = [("d", "s", "x", 1, 0), ("d", "s2", "y", 0, 3), (None, None, None, None, None)]
    points = spark.createDataFrame(rows, "doc_id string, source string, subject string, page_num int, chunk_index int")
    got = {r["doc_id"]: r for r in index.list_documents(points).collect()}
    assert got["d"]["source"] == "s" and got["d"]["pages"] == [0, 1] and got["d"]["chunk_count"] == 2
    assert got[C.UNKNOWN_DOC]["pages"] == [0]


def test_uploads(spark):
    rows = [(1, "a.txt", "x" * 600, "genel"), (2, "a.txt", "x" * 600, "genel"), (3, "b.exe", "x", "genel"), (4, "c.txt", "y" * 11 * 2**20, "genel")]
    ups = spark.createDataFrame(rows, "file_id long, source string, text string, subject string")
    points, report, rejected = ingest.index_uploads(ups, recursive_chunks("text"), keyword_vector)
    got = {r["file_id"]: (r["chunks_indexed"], r["status"]) for r in report.collect()}
    assert got == {1: (2, "ready"), 2: (0, "ready")}
    assert {r["file_id"]: r["status_code"] for r in rejected.collect()} == {3: 415, 4: 413}


# --- search -----------------------------------------------------------------------------------


def brute(points, queries, k, filtered):
    out = set()
    for qid, qv, qs in queries:
        scored = []
        for pid, pv, ps in points:
            if filtered and qs and qs != ps:
                continue
            n = np.linalg.norm(qv) * np.linalg.norm(pv)
            scored.append((-round(float(np.dot(qv, pv) / n), 9) if n else 0.0, pid))
        for rank, (_, pid) in enumerate(sorted(scored)[:k], 1):
            out.add((qid, pid, rank))
    return out


@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("limit", [10**9, 600, 0])
def test_top_k_paths_agree_with_brute_force(spark, filtered, limit):
    rng = np.random.default_rng(3)
    points = [(i, rng.integers(-2, 3, 5).astype(float).tolist(), "ab"[i % 2]) for i in range(120)]
    points += [(1000 + i, points[0][1], "a") for i in range(60)]  # a third are copies of one vector
    queries = [(q, rng.normal(size=5).tolist(), ["", "a", "zz", " b "][q % 4]) for q in range(17)]
    p = spark.createDataFrame(points, "point_id long, vector array<double>, subject string")
    q = spark.createDataFrame(queries, "query_id long, vector array<double>, subject string")
    if limit == 600:
        p, q = p.limit(0).unionByName(spark.createDataFrame(points[:10], p.schema)), q
        points = points[:10]
    hits = search.top_k(p, q, k=4, subject="subject" if filtered else None, broadcast_bytes=limit, block_bytes=400)
    expected = brute(points, [(a, b, c.strip()) for a, b, c in queries], 4, filtered)
    assert {(r["query_id"], r["point_id"], r["rank"]) for r in hits.collect()} == expected


def test_empty_collection_and_context(spark):
    p = spark.createDataFrame([], "point_id string, vector array<double>, subject string, text string, source string, page_num int, chunk_index int, doc_id string")
    q = spark.createDataFrame([(1, [1.0, 0.0], "kuvvet", "fizik"), (2, [0.0, 1.0], "yok", "")], "query_id long, vector array<double>, text string, subject string")
    docs = search.hit_documents(search.top_k(p, q), p)
    got = {r["query_id"]: r["result"] for r in search.search_answers(q, search.context_strings(docs)).collect()}
    assert got == {1: "'kuvvet' sorgusu için fizik dersinde ilgili materyal bulunamadı.", 2: "'yok' sorgusu için ilgili materyal bulunamadı."}
    assert {r["confidence"] for r in search.confidence(q, docs).collect()} == {0.0}


def test_context_numbers_and_drops_empty_after_limit(spark):
    p = spark.createDataFrame(
        [("a", [1.0, 0.0], "m1", "s.txt", 0), ("b", [0.9, 0.1], "", "s.txt", 1), ("c", [0.5, 0.5], "m3", "t.txt", 2)],
        "point_id string, vector array<double>, text string, source string, page_num int",
    ).withColumn("subject", F.lit("x")).withColumn("chunk_index", F.lit(0)).withColumn("doc_id", F.lit("d"))
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    docs = search.hit_documents(search.top_k(p, q, k=2), p)
    assert search.context_strings(docs).first()["context"] == "[1] (kaynak: s.txt, sayfa: 0)\nm1"
    docs = search.hit_documents(search.top_k(p, q, k=3), p)
    assert search.context_strings(docs).first()["context"].endswith("\n\n[2] (kaynak: t.txt, sayfa: 2)\nm3")


# --- streams -------------------------------------------------------------------------------------


def test_stream_ingest_skips_known_documents(spark, tmp_path):
    folder = str(tmp_path / "in")
    docs = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in PAGES if r[0] in (1, 3)], SCHEMA)
    docs.where("file_id = 1").coalesce(1).write.mode("append").parquet(folder)
    docs.where("file_id = 3").coalesce(1).write.mode("append").parquet(folder)

    def to_points(batch, existing):
        return index.scan_collection(build(batch, existing))

    stream = jobs.file_stream(spark, folder, files_per_trigger=1)
    points = jobs.run_ingest(spark, stream, to_points)
    assert points.select("point_id").distinct().count() == points.count() == build(docs).count()


def test_stream_counters_restart_from_state(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    events = spark.createDataFrame([(1, "a", 1), (1, "b", 5), (2, "a", 3)], "session_id long, subject string, ts long")
    more = spark.createDataFrame([(1, "a", 9), (3, "c", 2)], "session_id long, subject string, ts long")
    events.write.mode("append").parquet(folder)
    jobs.session_counters(jobs.file_stream(spark, folder), out, state)
    more.write.mode("append").parquet(folder)
    jobs.session_counters(jobs.file_stream(spark, folder), out, state)
    got = {r["session_id"]: (r["question_count"], r["last_activity"], r["subjects"]) for r in jobs.current_counters(spark, out).collect()}
    assert got == {1: (3, 9, ["a", "b"]), 2: (1, 3, ["a"]), 3: (1, 2, ["c"])}


def test_attempts_fold_over_batches_and_a_restart(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    good, schema = "x" * 80, "question_id int, attempt bigint, answer string"
    batches = [[(1, 2, good), (2, 1, "kısa"), (4, 1, None)], [(1, 1, "kısa"), (2, 3, "kısa"), (3, 2, "b")], [(2, 2, "kısa"), (3, 1, good), (4, 2, "az")]]
    rows = [r for b in batches for r in b]
    for part in (batches[:2], batches[2:]):
        for b in part:
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.attempt_folds(jobs.file_stream(spark, folder, files_per_trigger=1), out, state)
    whole = answers.fold_attempts(spark.createDataFrame(rows, schema)).collect()
    got = jobs.current_attempts(spark, out).collect()
    assert sorted(got) == sorted(whole) and len(whole) == 4
    assert spark.read.parquet(out).select("batch").distinct().count() == 3


def test_documents_are_listed_over_batches_and_a_restart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT", 2)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "doc_id string, source string, subject string, page_num int, chunk_index int"
    batches = [
        [("a", "s", "x", 1, 1), ("a", "s", "x", 1, 2), (None, "t", None, None, None)],
        [("a", "s", "x", 2, 3), ("b", "u", "y", 0, 0)], [("a", "s0", "x0", 0, 0), ("b", "u", "y", 0, 1)], [("c", None, "z", 5, 0)], [("a", "s", "x", 2, 4)],
    ]
    rows = [r for b in batches for r in b]
    for part in (batches[:4], batches[4:]):
        for b in part:
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.document_summaries(jobs.file_stream(spark, folder, files_per_trigger=1), out, state)
    whole = {r["doc_id"]: r for r in index.list_documents(spark.createDataFrame(rows, schema)).collect()}
    got = {r["doc_id"]: r for r in jobs.current_documents(spark, out).collect()}
    assert got == whole and got["a"]["pages"] == [0, 1, 2] and got["a"]["chunk_count"] == 5 and got["a"]["source"] == "s0"


def test_long_text_without_separators():
    text = "x" * 10_000_000
    spans = list(chunk_spans(text, 0, len(text), 500, 50, C.SEPARATORS))
    assert spans[0] == (0, 500) and spans[-1][1] == len(text)
    assert all(a[1] - b[0] == 50 for a, b in zip(spans, spans[1:]))


def test_tables_arrive_in_files_that_follow_their_bytes(spark, tmp_path, monkeypatch):
    """A table read by many tasks arrives in as many files, still in three batches."""
    spark.range(6000).selectExpr("id event_id", "id % 50 user_id", "'e' event_type", "timestamp_seconds(id) ts", "repeat('x', 20) props").write.parquet(str(tmp_path / "events.parquet"))
    seen, open_stream = [], jobs.file_stream
    monkeypatch.setattr(jobs, "file_stream", lambda spark, path, files_per_trigger: seen.append((path, files_per_trigger)) or open_stream(spark, path, files_per_trigger))
    for most, files in (("4k", None), ("1g", 1)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if files is None else "1g")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            read = spark.read.parquet(str(tmp_path / "events.parquet")).rdd.getNumPartitions()
            rows = catalog.session_rollup_stream(spark, str(tmp_path)).collect()
        finally:
            for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
                spark.conf.unset(f"spark.sql.files.{name}")
        path, at_once = seen.pop()
        written = [f for f in os.listdir(path) if f.endswith(".parquet")]
        assert len(rows) == 50 and all(r["question_count"] == 120 for r in rows)
        assert files is None or read <= 8
        assert at_once == -(-read // 3) and len(written) == 3 * at_once
        assert files is not None or at_once > 2
