"""Registered queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions import text as T
from lectern.functions.vectors import dot, keyword_vector, l2_normalize, norm
from lectern.operators import answers, cells, index, neardup, quality, retrieval, routing, rules, scoring, search, sessions, sketches, split, stats
from lectern.operators.chunking import explode_single_pages, recursive_chunks, window_chunks
from lectern.operators.collection import Collection
from lectern.operators.embed import embed_queries, isolating_vectorizer, split_failures
from lectern.plans import ingest, prepare
from lectern.plans import roles as R
from lectern.session import cut_lineage, shared_path
from lectern.sources import curriculum as plan
from lectern.sources import files, replies
from lectern.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _r6(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


def _r6_up(name: str) -> Column:
    """Six digits; the nudge settles exact ties the same way on every engine."""
    return F.round(F.col(name) + 1e-9, 6).alias(name)


def _joined(name: str, sep: str = ",") -> Column:
    return F.array_join(name, sep).alias(name)


def vectorizer(text: Column) -> Column:
    return keyword_vector(text, R.KEYWORDS)


# --- search ---------------------------------------------------------------------------


def _hits(hits: DataFrame, *ids: str) -> DataFrame:
    return hits.select(*ids, *_r6("score"), *_long("rank"))


def _window_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.index_documents(R.pages(spark, sf_dir), window_chunks("text"), vectorizer, single_page=True, normalize=False)


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_queries(R.questions(spark, sf_dir), "text", vectorizer, normalize=False)


@query
def topk_cosine(spark, sf_dir):
    return _hits(search.top_k(R.points(spark, sf_dir), R.centroids(spark, sf_dir)), "query_id", "point_id")


@query
def topk_cosine_by_subject(spark, sf_dir):
    hits = search.top_k(R.points(spark, sf_dir), R.centroids(spark, sf_dir), subject="subject")
    return _hits(hits, "query_id", "point_id")


@query
def topk_cosine_one_subject(spark, sf_dir):
    points = search.by_subject(R.points(spark, sf_dir), " s3 ")
    return _hits(search.top_k(points, R.centroids(spark, sf_dir), k=2), "query_id", "point_id")


@query
def topk_cells(spark, sf_dir):
    """The hits of a full scan, from cells visited by their bound."""
    path = cells.write_cells(R.points(spark, sf_dir), cell_rows=64)
    return _hits(cells.top_k_in_cells(spark, path, R.centroids(spark, sf_dir))[0], "query_id", "point_id")


def _stored(spark, rows: DataFrame) -> Collection:
    held = Collection(spark, shared_path(spark, "collection"))
    held.upsert(rows)
    return held


@query
def collection_one_subject(spark, sf_dir):
    """A stored collection, searched in the folders of one subject."""
    points = _stored(spark, R.points(spark, sf_dir)).read(subject="s3")
    return _hits(search.top_k(points, R.centroids(spark, sf_dir), k=2), "query_id", "point_id")


@query
def collection_large_subjects(spark, sf_dir):
    """Points of the subjects that hold at least the mean number of them; the scan is pruned when their names are known."""
    points = R.points(spark, sf_dir)
    counts = points.groupBy("subject").count()
    large = counts.where(F.col("count") >= counts.agg(F.avg("count")).first()[0])
    return _stored(spark, points).read(among=large).select("point_id", "subject")


@query
def collection_upsert(spark, sf_dir):
    """The German documents are indexed again twice under other subjects; worn buckets are compacted between and after."""
    points = index.scan_collection(_window_points(spark, sf_dir))
    held = _stored(spark, points)
    german = held.read(subject="de")
    for name in ("deutsch", "almanca"):
        held.upsert(german.withColumn("subject", F.lit(name)))
        held.compact()
    return held.read().select("point_id", "doc_id", "subject")


@query
def confidence(spark, sf_dir):
    asked = R.centroids(spark, sf_dir)
    result = search.confidence(asked, search.top_k(R.points(spark, sf_dir), asked))
    return result.select("query_id", *_r6("confidence"))


@query
def keyword_search(spark, sf_dir):
    hits = search.top_k(_window_points(spark, sf_dir), _asked(spark, sf_dir))
    return _hits(hits, "query_id", "point_id")


MODEL = "intfloat/multilingual-e5-large"


@query
def prefixed_search(spark, sf_dir):
    """Passages and questions are vectorized with the prefixes that the model wants."""
    points = ingest.index_documents(R.pages(spark, sf_dir), window_chunks("text"), vectorizer, single_page=True, normalize=False, model=MODEL)
    asked = embed_queries(R.questions(spark, sf_dir), "text", vectorizer, model=MODEL, normalize=False)
    return _hits(search.top_k(points, asked), "query_id", "point_id")


def _question_documents(spark, sf_dir):
    points = cut_lineage(_window_points(spark, sf_dir))
    asked = cut_lineage(_asked(spark, sf_dir))
    return asked, search.hit_documents(search.top_k(points, asked, subject="subject"), points)


@query
def context_string(spark, sf_dir):
    return search.context_strings(_question_documents(spark, sf_dir)[1])


@query
def search_or_message(spark, sf_dir):
    asked, documents = _question_documents(spark, sf_dir)
    return search.search_answers(asked, search.context_strings(documents)).select("query_id", "result")


@query
def answer_sources(spark, sf_dir):
    found = answers.answer_sources(_question_documents(spark, sf_dir)[1])
    return found.select("query_id", _joined("sources"))


@query
def merged_search(spark, sf_dir):
    asked = R.centroids(spark, sf_dir)
    points = R.points(spark, sf_dir)
    low = F.col("subject") < "s5"
    corpora = {"theory": search.top_k(points.where(low), asked), "exam": search.top_k(points.where(~low), asked)}
    merged = search.merged_search(corpora)
    return merged.select("query_id", "corpus", "point_id", *_r6("score", "scaled"), *_long("rank"))


# --- retrieval quality -------------------------------------------------------------------


def _vectors(spark, sf_dir):
    """Every point asks for its label among the label centroids: (queries, corpus, gold)."""
    asked = R.points(spark, sf_dir).select(F.col("point_id").alias("query_id"), "vector", "subject")
    corpus = R.centroids(spark, sf_dir).select(F.col("subject").alias("point_id"), "vector")
    return asked, corpus, asked.select("query_id", F.col("subject").alias("gold_id"))


def _nearest_centroid(spark, sf_dir, k):
    asked, corpus, gold = _vectors(spark, sf_dir)
    return asked, corpus, gold, search.top_k(corpus, asked, k=k)


@query
def retrieval_accuracy(spark, sf_dir):
    _, _, gold, hits = _nearest_centroid(spark, sf_dir, 3)
    ranks = retrieval.gold_ranks(hits, gold)
    return retrieval.recall_at(ranks).select(*_long("k", "n"), *_r6("recall"))


@query
def recall_at_k(spark, sf_dir):
    _, _, gold, hits = _nearest_centroid(spark, sf_dir, 10)
    ranks = retrieval.gold_ranks(hits, gold)
    return retrieval.recall_at(ranks, (1, 4, 10)).select(*_long("k", "n"), *_r6("recall"))


def _margins(spark, sf_dir):
    """The gold of label 9 is not in the corpus."""
    asked, corpus, gold, hits = _nearest_centroid(spark, sf_dir, 1)
    gold = gold.withColumn("gold_id", F.when(F.col("gold_id") == "s9", F.lit("yok")).otherwise(F.col("gold_id")))
    return retrieval.score_margins(hits, gold, asked, corpus)


@query
def retrieval_margin(spark, sf_dir):
    return _margins(spark, sf_dir).select("query_id", "gold_id", "top1", "ok", *_r6("top1_score", "gold_score", "margin"))


@query
def margin_summary(spark, sf_dir):
    found = retrieval.margin_summary(_margins(spark, sf_dir))
    return found.select(*_long("wrong"), *_r6("top1_mean", "top1_min", "wrong_margin_mean"))


def _models(spark, sf_dir):
    def cut(size):
        def tables():
            asked, corpus, _ = _vectors(spark, sf_dir)
            short = F.slice("vector", 1, size).alias("vector")
            return corpus.select("point_id", short), asked.select("query_id", short)

        return tables

    def broken():
        raise ValueError("model not available")

    return {"full": cut(64), "half": cut(32), "quarter": cut(16), "missing": broken}


def _model_results(spark, sf_dir):
    gold = _vectors(spark, sf_dir)[2]
    return retrieval.benchmark_models(spark, _models(spark, sf_dir), gold)


@query
def model_benchmark(spark, sf_dir):
    return _model_results(spark, sf_dir).select("model_id", *_long("vector_dim"), *_r6("top1_acc", "top3_recall"))


@query
def model_choice(spark, sf_dir):
    return retrieval.choose_model(_model_results(spark, sf_dir)).select("model_id", *_r6("top1_acc", "top3_recall"))


# --- records: parsing, filters, dedup ------------------------------------------------------


def _replies(spark, sf_dir):
    """Raw replies of five shapes around the Q&A rows: fenced, bare, broken, mixed, not a list."""
    item = F.to_json(F.struct("instruction", "output"))
    shape = F.col("rec_id") % 5
    fenced = F.concat(F.lit("İşte sorular:\n```json\n["), item, F.lit("]\n```\nBitti."))
    bare = F.concat(F.lit("Cevap: [ "), item, F.lit(" ] son"))
    broken = F.concat(F.lit("["), item, F.lit(", {\"instruction\": ]"))
    mixed = F.concat(F.lit('[1, "metin", {"instruction": "  ", "output": "x"}, {"instruction": "q"}, '), item, F.lit(', {"instruction": " soru\\n", "output": 12}]'))
    reply = F.when(shape == 0, fenced).when(shape == 1, bare).when(shape == 2, broken).when(shape == 3, mixed).otherwise(item)
    return R.qa(spark, sf_dir).select("rec_id", reply.alias("reply"))


@query
def parse_replies(spark, sf_dir):
    parsed = replies.parse_replies(_replies(spark, sf_dir), "reply", ["rec_id"])
    return parsed.select("rec_id", *_long("position"), "instruction", "input", "output")


@query
def reply_counts(spark, sf_dir):
    return replies.parse_counts(_replies(spark, sf_dir), "reply")


@query
def marked_corpus(spark, sf_dir):
    """Two marked paragraphs per document: its text, and its source with notes around."""
    n = F.col("doc_id")
    marked = F.concat(
        F.lit("# derlem\nönsöz\n##P"), (n * 2).cast("string"), F.lit("\n"), F.col("text"),
        F.lit("\n##P"), (n * 2 + 1).cast("string"), F.lit("  \n# not\n  "), F.col("source"), F.lit("\n\n "), F.col("lang"), F.lit(" \n##P0x\n##P7\n\n"),
    )
    documents = R.table(spark, sf_dir, "documents").select("doc_id", marked.alias("marked"))
    return files.marked_paragraphs(documents, "marked", ["doc_id"])


@query
def marked_corpus_file(spark, sf_dir):
    """Documents as marked paragraphs of corpus files, written and read back."""
    path = shared_path(spark, "corpus")
    marked = F.concat(F.lit("##P"), F.col("doc_id").cast("string"), F.lit("\n"), F.col("text"))
    R.table(spark, sf_dir, "documents").select(marked.alias("value")).write.option("maxRecordsPerFile", 10_000).text(path)
    return files.read_marked_corpus(spark, path)


@query
def seed_documents(spark, sf_dir):
    """Text files of the documents as seeds, each under a subject of its own; one listed name does not exist."""
    path = shared_path(spark, "seeds")
    lines = R.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    lines.write.option("maxRecordsPerFile", 10_000).text(path)
    names = sorted(r["name"] for r in spark.read.format("binaryFile").load(path).select(T.base_name("path").alias("name")).collect())
    seeds = [(name, f"ders{i}") for i, name in enumerate(names)] + [("yok.txt", "genel")]
    pages = files.read_seed_documents(spark, path, seeds)
    words = pages.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line") != "")
    return words.groupBy("line").agg(F.count("*").alias("n"))


@query
def normalize_key_dedup(spark, sf_dir):
    kept = quality.first_per_key(R.texts(spark, sf_dir), "text", "rec_id")
    return kept.select("rec_id", F.md5(T.normalize_key("text")).alias("key"))


@query
def quality_filter(spark, sf_dir):
    return quality.quality_filter(R.texts(spark, sf_dir), "text", "text", "rec_id").select("rec_id", "lang", "source")


@query
def filter_funnel(spark, sf_dir):
    return quality.filter_funnel(R.texts(spark, sf_dir), "text", "text")


@query
def outlier_classes(spark, sf_dir):
    flagged = R.qa(spark, sf_dir).withColumn("outlier", quality.outlier_class("output"))
    return flagged.groupBy("outlier").agg(F.count("*").alias("n"))


@query
def outlier_counts(spark, sf_dir):
    return quality.outlier_counts(R.qa(spark, sf_dir), "output")


@query
def sequence_budget(spark, sf_dir):
    rows = quality.sequence_budget(R.qa(spark, sf_dir))
    return rows.select("rec_id", "instruction_tokens", "output_tokens", "total_tokens", "over", "near")


@query
def chars_per_token(spark, sf_dir):
    rows = quality.sequence_budget(R.qa(spark, sf_dir))
    return quality.chars_per_token(rows, "output", "output_tokens").select(*_r6("chars_per_token"))


#: 64 vectors of 64 numbers: the test tables fill many cells and blocks.
SMALL_BLOCK = 64 * 64 * 8


@query
def near_flags(spark, sf_dir):
    return neardup.first_neighbours(R.points(spark, sf_dir), "point_id", "vector", 0.3, block_bytes=SMALL_BLOCK)


@query
def semantic_dedup(spark, sf_dir):
    return neardup.semantic_dedup(R.points(spark, sf_dir), "point_id", "vector", 0.3, pivots=128, block_bytes=SMALL_BLOCK)


@query
def semantic_dedup_sparse(spark, sf_dir):
    return neardup.semantic_dedup(R.points(spark, sf_dir), "point_id", "vector", 0.4, block_bytes=SMALL_BLOCK)


@query
def semantic_dedup_texts(spark, sf_dir):
    rows = R.texts(spark, sf_dir).select("rec_id", vectorizer(F.col("text")).alias("vector"))
    return neardup.semantic_dedup(rows, "rec_id", "vector")


# --- curriculum ----------------------------------------------------------------------------


def _curriculum(spark, sf_dir):
    """Nested curriculum of the documents: language -> grade -> distinct sources."""
    cells = R.labelled_texts(spark, sf_dir).join(R.texts(spark, sf_dir).select("rec_id", "source"), "rec_id")
    cells = cells.select("subject", "grade", "source").distinct()
    topics = cells.groupBy("subject", "grade").agg(F.array_sort(F.collect_list("source")).alias("topics"))
    grades = F.map_from_entries(F.collect_list(F.struct("grade", "topics")))
    return topics.groupBy("subject").agg(grades.alias("grades"))


@query
def curriculum_plan(spark, sf_dir):
    exploded = plan.with_quota(plan.explode_curriculum(_curriculum(spark, sf_dir)), 50)
    return exploded.select("subject", *_long("grade", "quota"), _joined("topics"))


@query
def curriculum_prompts(spark, sf_dir):
    exploded = plan.with_quota(plan.explode_curriculum(_curriculum(spark, sf_dir)), 12)
    return plan.prompts(exploded).select("subject", *_long("grade"), "prompt")


@query
def mock_records(spark, sf_dir):
    return plan.mock_records(plan.explode_curriculum(_curriculum(spark, sf_dir))).select(
        "instruction", "input", "output", "subject", *_long("grade")
    )


# --- chunks and index ------------------------------------------------------------------------


@query
def chunk_windows(spark, sf_dir):
    rows = R.texts(spark, sf_dir).select("rec_id", "text")
    return explode_single_pages(rows, window_chunks("text")).select("rec_id", *_long("chunk_index"), "text")


@query
def chunk_recursive(spark, sf_dir):
    rows = R.texts(spark, sf_dir).select("rec_id", "text")
    return explode_single_pages(rows, recursive_chunks("text")).select("rec_id", *_long("chunk_index"), "text")


@query
def document_ids(spark, sf_dir):
    return index.with_document_id(R.pages(spark, sf_dir), single_page=True).select("file_id", "doc_id")


@query
def page_document_ids(spark, sf_dir):
    named = index.with_document_id(R.conversation_pages(spark, sf_dir))
    return named.select("file_id", *_long("page_num"), "doc_id")


@query
def point_ids(spark, sf_dir):
    rows = R.table(spark, sf_dir, "documents").select("doc_id", T.point_id(F.concat(F.col("source"), F.lit("_"), F.col("lang")), "doc_id").alias("point_id"))
    return rows


def _point_columns(points):
    return points.select(
        "point_id", "doc_id", "source", "subject", *_long("page_num", "chunk_index"), "text",
        F.array_join(F.transform("vector", lambda x: F.round(x * 1000000).cast("bigint").cast("string")), ",").alias("vector"),
    )


@query
def index_build(spark, sf_dir):
    return _point_columns(_window_points(spark, sf_dir))


@query
def index_build_pages(spark, sf_dir):
    pages = R.conversation_pages(spark, sf_dir)
    return _point_columns(ingest.index_documents(pages, window_chunks("text"), vectorizer, normalize=False))


@query
def index_build_recursive(spark, sf_dir):
    points = ingest.index_documents(R.pages(spark, sf_dir), recursive_chunks("text"), vectorizer, single_page=True, normalize=False)
    return _point_columns(points)


@query
def index_incremental(spark, sf_dir):
    """English documents are indexed first; then all arrive, and the known ones are skipped."""
    pages = R.pages(spark, sf_dir)
    build = dict(chunks=window_chunks("text"), vectorizer=vectorizer, single_page=True, normalize=False)
    existing = cut_lineage(index.scan_collection(ingest.index_documents(pages.where(F.col("subject") == "en"), **build)))
    fresh = index.scan_collection(ingest.index_documents(pages, existing=existing, **build))
    total = index.upsert(existing, fresh)
    marked = total.join(fresh.select("point_id", F.lit(1).alias("new")), "point_id", "left")
    return marked.groupBy("subject").agg(F.count("*").alias("chunks"), F.count("new").alias("new_chunks"))


@query
def index_upsert(spark, sf_dir):
    """The German documents are indexed again twice under other subjects, the second time last; the rest stays."""
    points = cut_lineage(index.scan_collection(_window_points(spark, sf_dir)))
    german = points.where(F.col("subject") == "de")
    again = [german.withColumns({"subject": F.lit(name), "version": F.lit(n)}) for n, name in enumerate(("deutsch", "almanca"))]
    return index.upsert(points, again[1].unionByName(again[0]), order="version").select("point_id", "doc_id", "subject")


@query
def list_documents(spark, sf_dir):
    pages = R.conversation_pages(spark, sf_dir)
    points = ingest.index_documents(pages, window_chunks("text"), vectorizer, normalize=False)
    listed = index.list_documents(points)
    return listed.select("doc_id", "source", "subject", _joined("pages"), *_long("page_count", "chunk_count"))


@query
def blank_documents(spark, sf_dir):
    """Files of which only blank pages are left once letters are removed from short turns."""
    pages = R.conversation_pages(spark, sf_dir).withColumn("text", F.when(F.length("text") > 200, F.col("text")).otherwise(F.lit(" \n ")))
    return index.blank_files(pages)


@query
def keyword_vectors(spark, sf_dir):
    rows = R.texts(spark, sf_dir).select("rec_id", F.posexplode(vectorizer(F.col("text"))).alias("i", "x"))
    return rows.select("rec_id", *_long("i"), *_r6("x"))


@query
def vector_sizes(spark, sf_dir):
    points = R.points(spark, sf_dir)
    cut = points.withColumn("vector", F.when(F.col("point_id") % 7 == 0, F.slice("vector", 1, 60)).otherwise(F.col("vector")))
    return index.wrong_size(cut, 64).select("point_id", F.size("vector").cast("bigint").alias("size"))


@query
def unit_vectors(spark, sf_dir):
    rows = R.points(spark, sf_dir).withColumn("raw", F.transform("vector", lambda x: x.cast("double") * F.col("point_id")))
    unit = rows.withColumn("unit", l2_normalize("raw"))
    return unit.select("point_id", F.round(norm("unit"), 6).alias("length"), F.round(dot("unit", "vector"), 6).alias("same"))


@query
def isolated_vectors(spark, sf_dir):
    """Texts with a digit fail the encoder alone; the others of their batch are kept."""

    def load():
        def encode(batch):
            if any(ch.isdigit() for t in batch for ch in t):
                raise ValueError("digit in text")
            return [[float(len(t)), 1.0] for t in batch]

        return encode

    rows = R.texts(spark, sf_dir).withColumn("encoded", isolating_vectorizer(load)(F.col("text")))
    good, bad = split_failures(rows, "encoded", "text")
    kept = good.select("rec_id", F.element_at("vector", 1).cast("bigint").alias("size"), F.lit("").alias("cause"), F.lit("").alias("preview"))
    return kept.unionByName(bad.select("rec_id", F.lit(0).cast("bigint").alias("size"), "cause", "preview"))


@query
def record_points(spark, sf_dir):
    rows = index.record_points(R.qa(spark, sf_dir), "rec_id", vectorizer)
    return rows.select("point_id", "doc_id", "source", "subject", *_long("grade_level", "chunk_index", "page_num"), "text")


@query
def upload_report(spark, sf_dir):
    _, report, _ = ingest.index_uploads(R.uploads(spark, sf_dir), window_chunks("text"), vectorizer)
    return report.select("file_id", "source", "size_bytes", "chunks_indexed", "status")


@query
def upload_rejects(spark, sf_dir):
    _, _, rejected = ingest.index_uploads(R.uploads(spark, sf_dir), window_chunks("text"), vectorizer)
    return rejected.select("file_id", "source", *_long("status_code"))


# --- splits and checks -------------------------------------------------------------------------


def _split_records(spark, sf_dir):
    return split.stratified_split(R.qa(spark, sf_dir).where(quality.length_ok("output")), "rec_id")


def _split_texts(spark, sf_dir):
    return cut_lineage(split.stratified_split(R.labelled_texts(spark, sf_dir), "rec_id"))


@query
def stratified_split(spark, sf_dir):
    return _split_records(spark, sf_dir).select("rec_id", "split")


@query
def split_sizes(spark, sf_dir):
    return _split_texts(spark, sf_dir).groupBy("subject", "grade", "split").agg(F.count("*").alias("n")).select("subject", *_long("grade", "n"), "split")


@query
def split_leakage(spark, sf_dir):
    rows = _split_texts(spark, sf_dir)
    return split.leaked(rows.where(F.col("split") == "train"), rows.where(F.col("split") == "eval"), "instruction").select("rec_id")


@query
def shared_keys(spark, sf_dir):
    rows = _split_texts(spark, sf_dir)
    keys = split.shared_keys(rows.where(F.col("split") == "train"), rows.where(F.col("split") == "eval"), "instruction")
    return keys.select(F.md5("key").alias("key"))


@query
def split_duplicates(spark, sf_dir):
    rows = _split_texts(spark, sf_dir)
    return split.duplicate_keys(rows.where(F.col("split") == "train"), rows.where(F.col("split") == "eval"), "instruction")


@query
def seeded_sample(spark, sf_dir):
    return split.seeded_sample(R.qa(spark, sf_dir), "rec_id", 30).select("rec_id")


@query
def first_rows(spark, sf_dir):
    return split.first_rows(R.qa(spark, sf_dir), "rec_id", 20).select("rec_id", "subject")


def _record_lines(spark, sf_dir):
    """JSON lines of the Q&A rows; some lack keys, have a wrong type, subject or grade."""
    n = F.col("rec_id") / 1000
    kind = F.floor(n) % 7
    line = (
        F.when(kind == 0, F.to_json(F.struct("instruction", "output", "subject")))
        .when(kind == 1, F.to_json(F.struct("instruction", F.lit(0).alias("input"), "output", "subject", "grade")))
        .when(kind == 2, F.to_json(F.struct("instruction", "input", "output", F.lit("coğrafya").alias("subject"), (F.col("grade") - 1).alias("grade"))))
        .when(kind == 3, F.to_json(F.struct(F.lit(" \t").alias("instruction"), "input", "output", "subject", "grade")))
        .otherwise(F.to_json(F.struct("instruction", "input", "output", "subject", "grade")))
    )
    return R.qa(spark, sf_dir).select("rec_id", line.alias("line"))


@query
def dataset_contract(spark, sf_dir):
    return rules.contract_violations(_record_lines(spark, sf_dir), "line", ["rec_id"])


@query
def request_violations(spark, sf_dir):
    return rules.violations(R.requests(spark, sf_dir), rules.request_rules(), ["rec_id"])


@query
def session_id_violations(spark, sf_dir):
    """Requests with a session id: with dashes, without, one digit short."""
    digest, kind = F.md5(F.col("rec_id").cast("string")), F.floor(F.col("rec_id") / 1000) % 3
    dashed = F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    rows = R.requests(spark, sf_dir).withColumn("session_id", F.when(kind == 0, dashed).when(kind == 1, digest).otherwise(F.substring(digest, 1, 31)))
    return rules.violations(rows, rules.request_rules("session_id"), ["rec_id"])


@query
def upload_violations(spark, sf_dir):
    """Titles are the pages themselves, so most are too long; every third subject is unknown."""
    rows = R.table(spark, sf_dir, "pages").select(
        "page_id", F.col("html").alias("title"), F.when(F.col("page_id") % 3 == 0, F.lit("resim")).otherwise(F.lit("genel")).alias("subject"),
        (F.col("page_id") % 14).cast("int").alias("grade_level"),
    )
    short = rows.withColumn("title", F.concat(F.lit("sayfa "), F.col("page_id").cast("string")))
    return rules.violations(rows, rules.upload_rules(), ["page_id"]).unionByName(
        rules.violations(short.withColumn("page_id", -F.col("page_id") - 1), rules.upload_rules(), ["page_id"])
    )


@query
def response_violations(spark, sf_dir):
    rows = R.table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") / 100).alias("confidence"), (F.col("value") - 1).alias("processing_time_ms")
    )
    return rules.violations(rows, rules.response_rules(), ["event_id"])


@query
def split_report(spark, sf_dir):
    rows = _split_texts(spark, sf_dir).withColumn("input", F.lit(""))
    line = F.to_json(F.struct("instruction", "input", "output", "subject", "grade")).alias("line")
    train, evaluation = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "eval")
    return prepare.split_report(train.select(line), evaluation.select(line), train, evaluation)


@query
def prepare_dataset(spark, sf_dir):
    done = prepare.prepare(R.qa(spark, sf_dir))
    return done.records.select("rec_id", "subject", *_long("grade"), "split")


@query
def prepare_funnel(spark, sf_dir):
    return prepare.prepare(R.labelled_texts(spark, sf_dir), vectorizer=vectorizer).funnel


# --- statistics ------------------------------------------------------------------------------------


@query
def subject_grade_pivot(spark, sf_dir):
    return stats.subject_grade_pivot(R.qa(spark, sf_dir))


@query
def subject_grade_cube(spark, sf_dir):
    return stats.subject_grade_cube(R.qa(spark, sf_dir))


@query
def cross_table_ranges(spark, sf_dir):
    return stats.cross_table_ranges(R.qa(spark, sf_dir))


def _lengths(df):
    return df.select(*[c for c in df.columns if c not in ("mean", "q1", "median", "q3", "std")], *_r6("mean", "q1", "median", "q3", "std"))


@query
def length_stats(spark, sf_dir):
    return _lengths(stats.length_stats(R.qa(spark, sf_dir), "output"))


@query
def length_stats_by_language(spark, sf_dir):
    return _lengths(stats.length_stats(R.texts(spark, sf_dir), "text", ["lang"]))


@query
def value_counts(spark, sf_dir):
    return stats.value_counts(R.texts(spark, sf_dir), "lang", "source")


@query
def distinct_counts(spark, sf_dir):
    return stats.distinct_counts(R.qa(spark, sf_dir), "subject", "grade", "instruction")


@query
def length_histogram(spark, sf_dir):
    return stats.histogram(R.texts(spark, sf_dir).withColumn("len", F.length("text")), "len")


@query
def smallest_stratum(spark, sf_dir):
    return stats.smallest_stratum(R.qa(spark, sf_dir), "subject", "grade")


@query
def longest_shortest(spark, sf_dir):
    rows = R.texts(spark, sf_dir).select("rec_id", F.length("text").cast("bigint").alias("len"))
    long, short = stats.longest(rows, "len", "rec_id"), stats.shortest(rows, "len", "rec_id")
    return long.withColumn("kind", F.lit("longest")).unionByName(short.withColumn("kind", F.lit("shortest")))


# --- answer scores -----------------------------------------------------------------------------------


@query
def rouge1(spark, sf_dir):
    return R.answer_pairs(spark, sf_dir).select("rec_id", F.round(scoring.rouge1("b_answer", "gold"), 6).alias("rouge1"))


@query
def rouge_l(spark, sf_dir):
    return R.answer_pairs(spark, sf_dir).select("rec_id", F.round(scoring.rouge_l("a_answer", "gold"), 6).alias("rougeL"))


@query
def paired_answers(spark, sf_dir):
    rows = R.answer_pairs(spark, sf_dir)
    both = scoring.pair_strictly(rows.select("rec_id", F.col("a_answer").alias("prediction")), rows.select("rec_id", F.col("gold").alias("reference")), "rec_id")
    return both.select("rec_id", F.length("prediction").cast("bigint").alias("p"), F.length("reference").cast("bigint").alias("r"))


@query
def evaluate_answers(spark, sf_dir):
    rows = R.answer_pairs(spark, sf_dir).select(
        "rec_id", F.col("a_answer").alias("prediction"), F.col("gold").alias("reference"),
        "b_confidence", F.col("a_input_tokens").cast("double").alias("latency"),
    )
    done = scoring.evaluate_answers(rows, "rec_id", bert="b_confidence", latency="latency")
    return done.select("n", *_r6("rouge1_mean", "rougeL_mean", "bertscore_f1_mean", "latency_mean"), "rougeL_band", "bert_band", _joined("notes", "; "))


@query
def evaluation_samples(spark, sf_dir):
    rows = R.answer_pairs(spark, sf_dir).select("rec_id", F.col("a_answer").alias("prediction"), F.col("gold").alias("reference"))
    return scoring.sample_table(rows, "rec_id")


@query
def score_bands(spark, sf_dir):
    share = F.col("value") / 500
    return R.table(spark, sf_dir, "events").select(
        "event_id", scoring.band(share, C.ROUGE_L_BANDS).alias("rougeL_band"), scoring.band(share * 2, C.BERT_F1_BANDS).alias("bert_band")
    )


@query
def metric_means(spark, sf_dir):
    return scoring.metric_means(R.table(spark, sf_dir, "events"), ["value"]).select(*_r6("value_mean"))


def _ab(spark, sf_dir, metrics=("rouge1", "rougeL")):
    return scoring.ab_rows(R.answer_pairs(spark, sf_dir), metrics)


def _ab_numbers(df):
    return df.select(*[c for c in df.columns if c not in ("a_mean", "b_mean", "delta")], *_r6("a_mean", "b_mean", "delta"))


@query
def ab_summary(spark, sf_dir):
    return _ab_numbers(scoring.ab_summary(_ab(spark, sf_dir, ["rouge1"]), ["rouge1"]))


@query
def ab_by_subject(spark, sf_dir):
    return _ab_numbers(scoring.ab_summary(_ab(spark, sf_dir, ["rouge1"]), ["rouge1"], by=["subject"]))


@query
def ab_summary_lcs(spark, sf_dir):
    return _ab_numbers(scoring.ab_summary(_ab(spark, sf_dir), ["rouge1", "rougeL"]))


@query
def ab_totals(spark, sf_dir):
    done = scoring.ab_totals(R.answer_pairs(spark, sf_dir))
    return done.select("a_total_tokens", *_r6("b_avg_confidence", "b_avg_attempts"))


@query
def ab_table(spark, sf_dir):
    rows = split.seeded_sample(R.answer_pairs(spark, sf_dir), "rec_id", 30).withColumn("idx", F.col("rec_id"))
    return scoring.ab_table(scoring.ab_rows(rows))


@query
def arm_breakdown(spark, sf_dir):
    """Four arms: the four quarters of the day's events, scored by value."""
    arm = F.element_at(F.array(*[F.lit(a) for a in ("A", "B", "C", "D")]), (F.floor(F.hour("ts") / 6) + 1).cast("int"))
    long = R.table(spark, sf_dir, "events").select(arm.alias("arm"), F.col("event_type").alias("subject"), F.col("value").alias("score"))
    return scoring.arm_breakdown(long, "A").select("arm", "n", *_r6("mean_score", "positive_share"))


@query
def running_latency(spark, sf_dir):
    rows = R.table(spark, sf_dir, "events").select("event_id", "value")
    return scoring.running_latency(rows, "event_id", "value").select("event_id", _r6_up("running_avg"))


# --- answer checks ---------------------------------------------------------------------------------------


def _weak_attempts(spark, sf_dir):
    """Attempts, of which every third says that it does not know."""
    rows = R.attempts(spark, sf_dir)
    unsure = (F.col("question_id") + F.col("attempt")) % 3 != 0
    return rows.withColumn("answer", F.when(unsure, F.concat("answer", F.lit(" Bu konuda YETERLİ değil, BİLMİYORUM; emin değilim."))).otherwise(F.col("answer")))


@query
def weak_answers(spark, sf_dir):
    return _weak_attempts(spark, sf_dir).where(answers.is_weak("answer")).select("question_id", "attempt")


@query
def retry_decisions(spark, sf_dir):
    rows = _weak_attempts(spark, sf_dir)
    score = (F.col("question_id") % 10) / 10
    return rows.select(
        "question_id", "attempt", answers.needs_retry("answer", "attempt").alias("retry"),
        answers.needs_retry("answer", "attempt", C.EXTENDED_WEAK_PHRASES, top_score=score).alias("retry_scored"),
    )


@query
def fold_attempts(spark, sf_dir):
    return answers.fold_attempts(_weak_attempts(spark, sf_dir))


@query
def fold_attempts_stream(spark, sf_dir):
    """The attempts arrive in several files, those of a question spread over them."""
    arriving = _arriving(_weak_attempts(spark, sf_dir), R.table(spark, sf_dir, "conversations"), "stream-attempts")
    folded = jobs.run_attempt_folds(spark, arriving)
    return folded.select("question_id", "attempts", "answer", "needs_retry")


@query
def cited_sources(spark, sf_dir):
    checked = answers.check_cited_sources(R.cited_answers(spark, sf_dir))
    return checked.select("rec_id", "is_clean", _joined("academic_refs", "|"), _joined("unknown_sources", "|"), F.size("warnings").cast("bigint").alias("n_warnings"))


@query
def unknown_citations(spark, sf_dir):
    """Files a question cites (its document's source and one invented) against the files allowed for the language."""
    rows = R.table(spark, sf_dir, "documents")
    cited = rows.select("doc_id", "lang", F.explode(F.array(F.upper(F.concat("source", F.lit(".txt"))), F.concat("lang", F.lit(".md")))).alias("name"))
    allowed = rows.select("lang", F.concat("source", F.lit(".txt")).alias("name"))
    return answers.unknown_citations(cited, allowed, "lang")


@query
def step_previews(spark, sf_dir):
    _, documents = _question_documents(spark, sf_dir)
    grouped = documents.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "source"))).alias("docs"))
    return grouped.select("query_id", answers.step_preview("docs").alias("p")).select("query_id", F.col("p.count").cast("bigint").alias("n"), F.array_join("p.preview", ",").alias("preview"))


# --- sessions ----------------------------------------------------------------------------------------------


@query
def session_rollup(spark, sf_dir):
    return sessions.session_rollup(R.question_events(spark, sf_dir)).select("session_id", "question_count", "last_activity", _joined("subjects"))


def _created(spark, sf_dir):
    """Created sessions: every order opens one; most never get a question, and no order has the number 0 of the first user."""
    return R.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("session_id"), F.col("o_orderdate").alias("created_at"))


@query
def session_table(spark, sf_dir):
    done = sessions.session_rollup(R.question_events(spark, sf_dir), _created(spark, sf_dir))
    return done.select("session_id", "created_at", "question_count", "last_activity", _joined("subjects"))


@query
def fresh_sessions(spark, sf_dir):
    """Every user gets a session at a given time; sessions start without questions."""
    created = sessions.create_sessions(R.question_events(spark, sf_dir), now=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    nothing = R.question_events(spark, sf_dir).where(F.col("session_id").isNull())
    return sessions.session_rollup(nothing, created).select("session_id", "created_at", "question_count", "last_activity", _joined("subjects"))


@query
def unknown_session_events(spark, sf_dir):
    return sessions.unknown_events(R.question_events(spark, sf_dir), _created(spark, sf_dir)).select("event_id", "session_id")


#: Batches in which a table arrives.
STREAM_FILES = 3


def _arriving(rows: DataFrame, read: DataFrame, label: str) -> DataFrame:
    """The rows as a folder of files that arrive in `STREAM_FILES` batches, each of as many files as keep tasks small.

    `read` is the table the rows come from: its scan has a task for so many bytes.
    """
    spark = rows.sparkSession
    path = shared_path(spark, label)
    files = -(-read.rdd.getNumPartitions() // STREAM_FILES)
    rows.repartition(STREAM_FILES * files).write.parquet(path)
    return jobs.file_stream(spark, path, files_per_trigger=files)


def _file_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table as a folder of several files that arrive one batch after another."""
    rows = R.table(spark, sf_dir, name)
    return _arriving(rows, rows, f"stream-{name}")


@query
def session_rollup_stream(spark, sf_dir):
    stream = _file_stream(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), F.col("event_type").alias("subject"), "ts")
    return jobs.run_session_counters(spark, stream).select("session_id", "question_count", "last_activity", _joined("subjects"))


@query
def ingest_stream(spark, sf_dir):
    stream = _file_stream(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.concat("source", F.lit(".txt")).alias("source"), F.lit(0).alias("page_num"), "text", F.col("lang").alias("subject"),
    )

    def to_points(batch, existing):
        return index.scan_collection(ingest.index_documents(batch, window_chunks("text"), vectorizer, existing=existing, single_page=True, normalize=False))

    return jobs.run_ingest(spark, stream, to_points).select("point_id", "doc_id", *_long("chunk_index"))


@query
def list_documents_stream(spark, sf_dir):
    """The chunks of all documents arrive in several files."""
    points = ingest.index_documents(R.conversation_pages(spark, sf_dir), window_chunks("text"), vectorizer, normalize=False)
    arriving = _arriving(index.scan_collection(points), R.table(spark, sf_dir, "conversations"), "stream-points")
    listed = jobs.run_document_summaries(spark, arriving)
    return listed.select("doc_id", "source", "subject", _joined("pages"), *_long("page_count", "chunk_count"))


def _steps(events):
    return events.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), F.col("event_type").alias("field"), F.col("props").alias("value")
    )


@query
def step_fold(spark, sf_dir):
    return sessions.fold_steps(_steps(R.table(spark, sf_dir, "events")))


@query
def step_fold_stream(spark, sf_dir):
    return jobs.run_folded_steps(spark, _steps(_file_stream(spark, sf_dir, "events")))


@query
def conversation_pairs(spark, sf_dir):
    return sessions.conversation_pairs(R.table(spark, sf_dir, "conversations"))


@query
def conversation_history(spark, sf_dir):
    history = sessions.conversation_history(R.table(spark, sf_dir, "conversations"))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return history.select("conv_id", F.array_join(lines, "\n").alias("messages"))


@query
def last_messages(spark, sf_dir):
    return sessions.last_messages(R.table(spark, sf_dir, "conversations"), 2).select("conv_id", "turn", *_long("recency"))


@query
def usage_cost(spark, sf_dir):
    events = R.table(spark, sf_dir, "events")
    usage = events.select("user_id", "ts", F.col("event_type").alias("model_name"), (F.col("value") * 100).cast("bigint").alias("input_tokens"), F.col("event_id").alias("output_tokens"))
    priced = events.where(F.col("event_type") != "error")
    prices = priced.groupBy(F.col("event_type").alias("model_name")).agg(F.lit(0.8).alias("input_price"), (F.length(F.first("event_type")) / 2).cast("double").alias("output_price"))
    done = sessions.usage_cost(usage, prices)
    return done.select("user_id", "day", "questions", _r6_up("dollars"), "unpriced", "over_limit")


@query
def latency_percentiles(spark, sf_dir):
    return sessions.latency_percentiles(R.table(spark, sf_dir, "events"), "value").select("share", *_r6("value"))


@query
def latency_percentiles_kept(spark, sf_dir):
    """Sketches of three batches of days are kept; their merge brackets one exact pass."""
    events, path = R.table(spark, sf_dir, "events"), shared_path(spark, "sketches")
    for part in range(3):
        sketches.append_sketches(events.where(F.pmod(F.dayofyear("ts"), F.lit(3)) == part), path, "ts", "value")
    kept = sketches.read_sketches(spark, path)
    return sketches.exact_from_sketches(events, "value", kept, (0.5, 0.95, 0.99)).select("share", *_r6("value"))


@query
def daily_error_rate(spark, sf_dir):
    events = R.table(spark, sf_dir, "events")
    recent = sessions.last_hours(events, "ts", events.agg(F.max("ts")).scalar())
    return sessions.error_rate(recent, F.col("event_type") == "error").select("n", *_r6("error_rate"))


# --- texts -------------------------------------------------------------------------------------------------


@query
def prompt_texts(spark, sf_dir):
    rows = R.requests(spark, sf_dir)
    model = F.when(F.col("rec_id") % 2 == 0, F.lit("intfloat/multilingual-E5-large")).otherwise(F.lit("bge-m3"))
    context = F.when(F.col("grade_level") > 6, F.col("subject")).otherwise(F.lit(""))
    return rows.select(
        "rec_id", F.concat(T.query_prefix(model), "question").alias("asked"), F.concat(T.passage_prefix(model), "question").alias("stored"),
        T.user_message("question", context).alias("message"), T.preview("question", 60).alias("preview"),
    )


@query
def processing_times(spark, sf_dir):
    return R.table(spark, sf_dir, "events").select("event_id", T.whole_millis("value").alias("millis"))


@query
def chat_messages(spark, sf_dir):
    rows = R.qa(spark, sf_dir).select("rec_id", F.posexplode(T.chat_messages("instruction", "output")).alias("i", "m"))
    return rows.select("rec_id", *_long("i"), "m.role", "m.content")


@query
def file_names(spark, sf_dir):
    return R.table(spark, sf_dir, "pages").select("page_id", T.base_name("url").alias("base"), T.file_stem(F.concat(F.col("url"), F.lit(".Tar.GZ"))).alias("stem"), T.file_suffix(F.concat(F.col("url"), F.lit(".Tar.GZ"))).alias("suffix"))


@query
def route_questions(spark, sf_dir):
    rows = R.texts(spark, sf_dir)
    return rows.select("rec_id", routing.route_question("text").alias("route"))


@query
def page_quality(spark, sf_dir):
    noise = F.when(F.col("rec_id") % 3 == 0, F.repeat(F.lit("\n-----\n12\n   "), 60)).otherwise(F.lit("\n\n7\n"))
    rows = R.texts(spark, sf_dir).withColumn("raw", F.concat("text", noise)).withColumn("clean", routing.clean_page("raw"))
    return rows.select("rec_id", F.length("clean").cast("bigint").alias("clean_chars"), routing.page_quality("clean", "raw").alias("quality"))


@query
def exam_chunks(spark, sf_dir):
    """Exam questions written and read back as JSON."""
    rows = R.qa(spark, sf_dir)
    exam = rows.select(
        (2000 + F.col("rec_id") % 20).cast("int").alias("year"), F.lit("TYT").alias("exam_type"), "subject", F.col("instruction").alias("question"),
        F.array("output", "instruction").alias("choices"), F.lit("A").alias("answer_key"),
    )
    path = shared_path(spark, "exam")
    files.write_jsonl(exam, path)
    return routing.exam_chunks(spark.read.schema(routing.EXAM_SCHEMA).json(path)).select("text", "answer_key", *_long("year"), "exam_type", "subject")


@query
def jsonl_round_trip(spark, sf_dir):
    path = shared_path(spark, "records")
    files.write_jsonl(R.qa(spark, sf_dir).select("instruction", "input", "output", "subject", "grade"), path)
    return files.read_jsonl(spark, path).select("instruction", "input", "output", "subject", *_long("grade"))


@query
def result_csv(spark, sf_dir):
    path = shared_path(spark, "results")
    files.write_result_csv(R.qa(spark, sf_dir).select("rec_id", "instruction", "output"), path)
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("rec_id bigint, instruction string, output string").csv(path)
