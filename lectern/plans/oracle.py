"""DuckDB twins of the registered queries, over the same whole tables."""

from __future__ import annotations

from lectern.plans.roles import KEYWORDS

SQL: dict[str, str] = {}

QA = """qa AS (
  SELECT conv_id * 1000 + turn AS rec_id, conv_id, instruction, output,
    CASE conv_id % 9 WHEN 0 THEN 'matematik' WHEN 1 THEN 'fizik' WHEN 2 THEN 'kimya' WHEN 3 THEN 'biyoloji'
      WHEN 4 THEN 'tarih' WHEN 5 THEN 'cografya' WHEN 6 THEN 'felsefe' WHEN 7 THEN 'edebiyat' ELSE 'ingilizce' END AS subject,
    9 + CAST(floor(conv_id / 9) AS BIGINT) % 4 AS grade
  FROM (SELECT conv_id, turn, role, text AS instruction,
          lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
          lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS output FROM conversations) p
  WHERE role = 'user' AND next_role = 'assistant')"""

CENTROIDS = """cells AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
centroids AS (SELECT CAST(label AS BIGINT) AS query_id, 's' || label AS subject, list(m ORDER BY i) AS q FROM cells GROUP BY label),
points AS (SELECT vec_id AS point_id, 's' || label AS subject, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def ranked(source: str, k: int, where: str = "true") -> str:
    return f"""SELECT query_id, point_id, round(s, 6) AS score, rank FROM (
      SELECT query_id, point_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rank
      FROM ({source}) x WHERE {where}) y WHERE rank <= {k}"""


PAIRS = "SELECT query_id, point_id, c.subject AS qs, p.subject AS ps, round(list_cosine_similarity(q, v), 9) AS s FROM centroids c, points p"
SQL["topk_cosine"] = f"WITH {CENTROIDS} {ranked(PAIRS, 4)}"
SQL["topk_cosine_by_subject"] = f"WITH {CENTROIDS} {ranked(PAIRS, 4, 'qs = ps')}"
SQL["topk_cosine_one_subject"] = f"WITH {CENTROIDS} {ranked(PAIRS, 2, chr(39).join(['ps = ', 's3', '']))}"
SQL["topk_cells"] = SQL["topk_cosine"]
SQL["collection_one_subject"] = SQL["topk_cosine_one_subject"]
SQL["collection_large_subjects"] = """WITH p AS (SELECT vec_id AS point_id, concat('s', CAST(label AS STRING)) AS subject FROM embeddings)
SELECT point_id, subject FROM p WHERE subject IN (SELECT subject FROM p GROUP BY subject HAVING count(*) >= (SELECT count(*) / count(DISTINCT subject) FROM p))"""
SQL["confidence"] = f"WITH {CENTROIDS} SELECT query_id, round(max(s), 6) AS confidence FROM ({PAIRS}) x GROUP BY query_id"
SQL["merged_search"] = f"""WITH {CENTROIDS}, hits AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, corpus ORDER BY s DESC, point_id) AS r
  FROM (SELECT *, CASE WHEN ps < 's5' THEN 'theory' ELSE 'exam' END AS corpus FROM ({PAIRS}) x) y),
scaled AS (SELECT query_id, corpus, point_id, s, min(s) OVER w AS lo, max(s) OVER w AS hi FROM hits WHERE r <= 4 WINDOW w AS (PARTITION BY query_id, corpus)),
both_ AS (SELECT *, CASE WHEN hi = lo THEN 1.0 ELSE (s - lo) / (hi - lo) END AS sc FROM scaled)
SELECT query_id, corpus, point_id, round(s, 6) AS score, round(sc, 6) AS scaled, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sc, 9) DESC, corpus, point_id) AS rank FROM both_) z WHERE rank <= 4"""

NEAREST = f"""{CENTROIDS}, hits AS (
  SELECT vec AS query_id, gold AS gold_id, cid AS point_id, s, row_number() OVER (PARTITION BY vec ORDER BY s DESC, cid) AS rank FROM (
    SELECT p.point_id AS vec, p.subject AS gold, c.subject AS cid, round(list_cosine_similarity(q, v), 9) AS s FROM points p, centroids c) x)"""


def recall(ks: list[int]) -> str:
    parts = [
        f"SELECT CAST({k} AS BIGINT) AS k, count(*) AS n, round(avg(CASE WHEN rank <= {k} THEN 1.0 ELSE 0.0 END), 6) AS recall FROM hits WHERE point_id = gold_id"
        for k in ks
    ]
    return f"WITH {NEAREST} " + " UNION ALL ".join(parts)


SQL["retrieval_accuracy"] = recall([1, 3])
SQL["recall_at_k"] = recall([1, 4, 10])
MARGIN = f"""{NEAREST}, margins AS (SELECT a.query_id, CASE WHEN a.gold_id = 's9' THEN 'yok' ELSE a.gold_id END AS gold_id, a.point_id AS top1, a.gold_id <> 's9' AND a.point_id = a.gold_id AS ok,
  a.s AS top1_score, CASE WHEN a.gold_id <> 's9' THEN g.s END AS gold_score, CASE WHEN a.gold_id <> 's9' THEN a.s - g.s END AS margin
  FROM hits a JOIN hits g ON a.query_id = g.query_id AND g.point_id = g.gold_id WHERE a.rank = 1)"""
SQL["retrieval_margin"] = f"WITH {MARGIN} SELECT query_id, gold_id, top1, ok, round(top1_score, 6) AS top1_score, round(gold_score, 6) AS gold_score, round(margin, 6) AS margin FROM margins"
SQL["margin_summary"] = f"""WITH {MARGIN} SELECT count(*) FILTER (NOT ok) AS wrong, round(avg(top1_score), 6) AS top1_mean,
  round(min(top1_score), 6) AS top1_min, round(avg(margin) FILTER (NOT ok), 6) AS wrong_margin_mean FROM margins"""
MODELS = f"""{CENTROIDS}, models AS (SELECT * FROM (VALUES ('full', 64), ('half', 32), ('quarter', 16)) m(model_id, dim)),
mhits AS (SELECT model_id, dim, gold, cid, row_number() OVER (PARTITION BY model_id, vec ORDER BY s DESC, cid) AS rank FROM (
  SELECT model_id, dim, p.point_id AS vec, p.subject AS gold, c.subject AS cid, round(list_cosine_similarity(q[1:dim], v[1:dim]), 9) AS s FROM models, points p, centroids c) x),
results AS (SELECT model_id, CAST(dim AS BIGINT) AS vector_dim, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END), 6) AS top1_acc,
  round(avg(CASE WHEN rank <= 3 THEN 1.0 ELSE 0.0 END), 6) AS top3_recall FROM mhits WHERE gold = cid GROUP BY ALL)"""
SQL["model_benchmark"] = f"WITH {MODELS} SELECT * FROM results UNION ALL SELECT 'missing', 0, 0.0, 0.0"
SQL["model_choice"] = f"WITH {MODELS} SELECT model_id, top1_acc, top3_recall FROM results ORDER BY top1_acc DESC, top3_recall DESC, vector_dim LIMIT 1"

# --- keyword vectors, chunks, index ------------------------------------------------
HITS = "[" + ", ".join(f"CASE WHEN contains(lower(text), '{k}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for k in KEYWORDS) + "]"


def hits_of(alias: str) -> str:
    return HITS.replace("lower(text)", f"lower({alias}.text)")


PAGES = """pages_ AS (SELECT doc_id AS file_id, source || '.txt' AS source, text, lang AS subject, 0 AS page_num,
  source || '_' || substr(sha256(text), 1, 16) AS doc_id FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '')"""
UUID = """(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  CASE substr(h, 17, 1) WHEN '0' THEN '8' WHEN '4' THEN '8' WHEN '8' THEN '8' WHEN 'c' THEN '8'
    WHEN '1' THEN '9' WHEN '5' THEN '9' WHEN '9' THEN '9' WHEN 'd' THEN '9'
    WHEN '2' THEN 'a' WHEN '6' THEN 'a' WHEN 'a' THEN 'a' WHEN 'e' THEN 'a' ELSE 'b' END
  || substr(h, 18, 3) || '-' || substr(h, 21, 12))"""


def digest(name: str) -> str:
    return f"sha1(unhex('a3c4f1d278904abcdef01234567890ab') || encode({name}))"


def windows(source: str) -> str:
    return f"""wins AS (SELECT f.*, CAST(i AS BIGINT) AS pos, substr(full_text, 1 + i * 450, 500) AS text
  FROM (SELECT * EXCLUDE (text), text AS full_text, unnest(range(0, greatest(1, ceil((length(text) - 50) / 450.0))::BIGINT)) AS i FROM {source}) f)"""


def splits(source: str, key: str) -> str:
    """Recursive splitting, level by level: pieces of 500 characters or more go one separator down, runs of shorter
    ones are joined from left to right, each window starting at most 50 characters before the end of the last."""
    parts = [f"s0 AS (SELECT {key} AS k, text AS t, 0::BIGINT AS lo, length(text)::BIGINT AS hi FROM {source})"]
    for n, sep in enumerate(("chr(10) || chr(10)", "chr(10)", "'. '", "'? '", "'! '", "'; '", "' '")):
        here = f"contains(substr(t, lo + 1, hi - lo), {sep})"
        parts += [
            f"u{n} AS (SELECT k, t, lo AS base, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (SELECT *, string_split(substr(t, lo + 1, hi - lo), {sep}) AS p FROM s{n} WHERE {here}) x)",
            f"v{n} AS (SELECT k, t, base, i, length(piece) + CASE WHEN i > 1 THEN length({sep}) ELSE 0 END AS n FROM u{n})",
            f"w{n} AS (SELECT k, t, base, n, CAST(base + sum(n) OVER (PARTITION BY k, base ORDER BY i) - n AS BIGINT) AS a FROM v{n})",
            f"""p{n} AS (SELECT *, sum(CASE WHEN n >= 500 THEN 1 ELSE 0 END) OVER (PARTITION BY k, base ORDER BY a ROWS UNBOUNDED PRECEDING) AS g FROM w{n} WHERE n > 0)""",
            f"s{n + 1} AS (SELECT k, t, lo, hi FROM s{n} WHERE NOT {here} UNION ALL SELECT k, t, a, a + n FROM p{n} WHERE n >= 500)",
            f"r{n} AS (SELECT {n} AS level, k, base, g, list(a ORDER BY a) AS s, list(a + n ORDER BY a) AS e FROM p{n} WHERE n < 500 GROUP BY k, base, g)",
        ]
    runs = " UNION ALL ".join(f"SELECT * FROM r{n}" for n in range(7))
    return ",\n".join(parts) + f""",
steps AS (SELECT level, k, base, g, s, e, 1::BIGINT AS f FROM ({runs}) r
  UNION ALL SELECT level, k, base, g, s, e, 1 + len(list_filter(s, lambda x: x < greatest(s[l + 1] - 50, e[l + 1] - 500)))
  FROM (SELECT *, len(list_filter(e, lambda x: x <= s[f] + 500)) AS l FROM steps) q WHERE l < len(e)),
spans AS (SELECT k, s[f] AS a, e[len(list_filter(e, lambda x: x <= s[f] + 500))] AS b FROM steps
  UNION ALL SELECT k, lo + i * 450, least(lo + i * 450 + 500, hi)
  FROM (SELECT *, unnest(range(0, 1 + greatest(0, ceil((hi - lo - 500) / 450.0))::BIGINT)) AS i FROM s7) c),
wins AS (SELECT * EXCLUDE (a, k), row_number() OVER (PARTITION BY {key} ORDER BY a) - 1 AS pos FROM (
  SELECT f.* EXCLUDE (text), k, a, regexp_replace(substr(f.text, a + 1, b - a), '^\\s+|\\s+$', '', 'g') AS text FROM spans JOIN {source} f ON f.{key} = k) z WHERE text <> '')"""


POINTS = f"""{PAGES}, firsts AS (SELECT * FROM pages_ QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY file_id) = 1),
{windows('firsts')}, chunks AS (SELECT * EXCLUDE (pos), pos AS chunk_index, {digest("doc_id || ':' || pos")} AS h, {HITS} AS hits FROM wins),
kpoints AS (SELECT *, {UUID} AS point_id, list_sum(hits) AS nh FROM chunks)"""
VECTOR = """array_to_string(list_transform(hits, lambda x: CAST(CAST(CASE WHEN nh = 0 THEN 0 ELSE round(x / sqrt(nh) * 1000000) END AS BIGINT) AS VARCHAR)), ',') AS vector"""
SQL["chunk_windows"] = f"""WITH src AS (SELECT doc_id AS rec_id, text FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''), {windows('src')}
SELECT rec_id, pos AS chunk_index, text FROM wins"""
SQL["chunk_recursive"] = f"""WITH RECURSIVE src AS (SELECT doc_id AS rec_id, text FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''), {splits('src', 'rec_id')}
SELECT rec_id, pos AS chunk_index, text FROM wins"""
RECURSIVE_POINTS = POINTS.replace(windows("firsts"), splits("firsts", "file_id"))
SQL["document_ids"] = f"WITH {PAGES} SELECT file_id, doc_id FROM pages_"
SQL["point_ids"] = f"SELECT doc_id, {UUID} AS point_id FROM (SELECT doc_id, {digest(chr(39).join(['source || ', '_', ' || lang || ', ':', ' || doc_id']))} AS h FROM documents) x"
SQL["index_build"] = f"WITH {POINTS} SELECT point_id, doc_id, source, subject, CAST(page_num AS BIGINT) AS page_num, chunk_index, text, {VECTOR} FROM kpoints"
SQL["index_build_recursive"] = f"WITH RECURSIVE {RECURSIVE_POINTS} SELECT point_id, doc_id, source, subject, CAST(page_num AS BIGINT) AS page_num, chunk_index, text, {VECTOR} FROM kpoints"
CONVERSATIONS = f"""cpages AS (SELECT conv_id AS file_id, 'konusma_' || conv_id || '.pdf' AS source, turn + 1 AS page_num, text,
  CASE WHEN conv_id % 2 = 0 THEN 'tarih' ELSE 'fizik' END AS subject FROM conversations WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''),
cdocs AS (SELECT file_id, 'konusma_' || file_id || '_' || substr(sha256(string_agg(text, chr(10) ORDER BY page_num)), 1, 16) AS doc_id FROM cpages GROUP BY file_id),
cnamed AS (SELECT cpages.*, doc_id FROM cpages JOIN cdocs USING (file_id)),
{windows('cnamed')},
cchunks AS (SELECT *, {digest("doc_id || ':' || chunk_index")} AS h, {HITS} AS hits FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_num, pos) - 1 AS chunk_index FROM wins WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '') x),
cpoints AS (SELECT *, {UUID} AS point_id, list_sum(hits) AS nh FROM cchunks)"""
SQL["page_document_ids"] = f"WITH {CONVERSATIONS} SELECT file_id, page_num, doc_id FROM cnamed"
SQL["index_build_pages"] = f"WITH {CONVERSATIONS} SELECT point_id, doc_id, source, subject, page_num, chunk_index, text, {VECTOR} FROM cpoints"
SQL["list_documents"] = f"""WITH {CONVERSATIONS} SELECT doc_id, min(source) AS source, min(subject) AS subject,
  (SELECT 1) * count(DISTINCT page_num) AS page_count, count(*) AS chunk_count,
  array_to_string(list_sort(list(DISTINCT page_num)), ',') AS pages FROM cpoints GROUP BY doc_id"""
SQL["index_incremental"] = f"""WITH {PAGES}, en AS (SELECT DISTINCT doc_id FROM pages_ WHERE subject = 'en'),
firsts AS (SELECT * FROM (SELECT * FROM pages_ WHERE subject = 'en' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY file_id) = 1)
  UNION ALL SELECT * FROM (SELECT * FROM pages_ WHERE doc_id NOT IN (SELECT doc_id FROM en) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY file_id) = 1)),
{windows('firsts')}
SELECT subject, count(*) AS chunks, count(*) FILTER (subject <> 'en') AS new_chunks FROM wins GROUP BY subject"""
SQL["index_upsert"] = f"WITH {POINTS} SELECT point_id, doc_id, CASE WHEN subject = 'de' THEN 'almanca' ELSE subject END AS subject FROM kpoints"
SQL["collection_upsert"] = SQL["index_upsert"]
SQL["list_documents_stream"] = SQL["list_documents"]
SQL["ingest_stream"] = f"WITH {POINTS} SELECT point_id, doc_id, chunk_index FROM kpoints"
SQL["blank_documents"] = "SELECT conv_id AS file_id FROM conversations GROUP BY conv_id HAVING max(length(text)) <= 200"
SQL["keyword_vectors"] = f"""SELECT rec_id, CAST(i AS BIGINT) AS i, round(CASE WHEN nh = 0 THEN 0 ELSE hits[i + 1] / sqrt(nh) END, 6) AS x
FROM (SELECT doc_id AS rec_id, hits, list_sum(hits) AS nh, unnest(range(0, {len(KEYWORDS)})) AS i FROM (SELECT doc_id, {HITS} AS hits FROM documents) a) b"""
ASKED = f"""asked AS (SELECT item_id AS query_id, text AS question, [('')::VARCHAR, 'en', 'fr', 'it', 'de'][item_id % 5 + 1] AS qs, {HITS} AS qhits FROM benchmark),
kpairs AS (SELECT query_id, point_id, qs, p.subject AS ps, CASE WHEN nh = 0 OR list_sum(qhits) = 0 THEN 0.0
  ELSE round(list_dot_product(hits, qhits) / sqrt(nh * list_sum(qhits)), 9) END AS s FROM asked, kpoints p)"""
SQL["keyword_search"] = f"WITH {POINTS}, {ASKED} {ranked('SELECT * FROM kpairs', 4)}"
SQL["prefixed_search"] = f"WITH {POINTS}, {ASKED.replace('text)', chr(39).join(['', 'query: ', ' || text)']))} {ranked('SELECT * FROM kpairs', 4)}"
DOCUMENTS = f"""{POINTS}, {ASKED}, found AS ({ranked('SELECT * FROM kpairs', 4, "qs = '' OR qs = ps")}),
docs AS (SELECT f.query_id, f.rank, k.source, k.page_num, k.text FROM found f JOIN kpoints k USING (point_id) WHERE k.text <> ''),
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS i FROM docs),
contexts AS (SELECT query_id, string_agg('[' || i || '] (kaynak: ' || source || ', sayfa: ' || page_num || ')' || chr(10) || text, chr(10) || chr(10) ORDER BY i) AS context FROM numbered GROUP BY query_id)"""
SQL["context_string"] = f"WITH {DOCUMENTS} SELECT query_id, context FROM contexts"
SQL["search_or_message"] = f"""WITH {DOCUMENTS} SELECT a.query_id, coalesce(context, '''' || question || ''' sorgusu için ' ||
  CASE WHEN qs <> '' THEN qs || ' dersinde ' ELSE '' END || 'ilgili materyal bulunamadı.') AS result FROM asked a LEFT JOIN contexts USING (query_id)"""
SQL["answer_sources"] = f"WITH {DOCUMENTS} SELECT query_id, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM docs GROUP BY query_id"
SQL["step_previews"] = f"""WITH {DOCUMENTS} SELECT query_id, count(*) AS n, string_agg(source, ',' ORDER BY i) FILTER (i <= 3) AS preview FROM numbered GROUP BY query_id"""
SQL["vector_sizes"] = "SELECT vec_id AS point_id, CAST(60 AS BIGINT) AS size FROM embeddings WHERE vec_id % 7 = 0"
SQL["unit_vectors"] = """SELECT vec_id AS point_id, CAST(CASE WHEN vec_id = 0 THEN 0 ELSE 1 END AS DOUBLE) AS length,
  CASE WHEN vec_id = 0 THEN 0.0 ELSE round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) END AS same FROM embeddings"""
SQL["isolated_vectors"] = """SELECT doc_id AS rec_id, CASE WHEN regexp_matches(text, '[0-9]') THEN 0 ELSE length(text) END AS size,
  CASE WHEN regexp_matches(text, '[0-9]') THEN 'ValueError: digit in text' ELSE '' END AS cause,
  CASE WHEN regexp_matches(text, '[0-9]') THEN substr(text, 1, 80) ELSE '' END AS preview FROM documents"""
SQL["record_points"] = f"""WITH {QA} SELECT {UUID} AS point_id, 'train_' || rec_id AS doc_id, 'train.jsonl#' || rec_id AS source, subject,
  CAST(grade AS BIGINT) AS grade_level, CAST(0 AS BIGINT) AS chunk_index, CAST(0 AS BIGINT) AS page_num,
  'Soru: ' || instruction || chr(10) || chr(10) || 'Cevap: ' || output AS text
FROM (SELECT *, {digest("'train_' || rec_id || ':0'")} AS h FROM qa) x"""
UPLOADS = """ups AS (SELECT page_id AS file_id, 'page_' || page_id || CASE WHEN page_id % 10 = 0 THEN '.exe' WHEN page_id % 10 = 1 THEN '.PDF' ELSE '.txt' END AS source, html AS text FROM pages)"""
SQL["upload_report"] = f"""WITH {UPLOADS} SELECT file_id, source, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes,
  CAST(greatest(1, ceil((length(text) - 50) / 450.0)) AS BIGINT) AS chunks_indexed, 'ready' AS status
FROM ups WHERE source NOT LIKE '%.exe' AND octet_length(encode(text)) <= 10485760"""
SQL["upload_rejects"] = f"""WITH {UPLOADS} SELECT file_id, source, CAST(CASE WHEN source LIKE '%.exe' THEN 415 ELSE 413 END AS BIGINT) AS status_code
FROM ups WHERE source LIKE '%.exe' OR octet_length(encode(text)) > 10485760"""

# --- records ---------------------------------------------------------------------------
SQL["parse_replies"] = f"""WITH {QA}, kept AS (
  SELECT rec_id, CAST(CASE WHEN rec_id % 5 = 3 THEN 4 ELSE 0 END AS BIGINT) AS position, instruction, output FROM qa WHERE rec_id % 5 IN (0, 1, 3)
  UNION ALL SELECT rec_id, 5, 'soru', '12' FROM qa WHERE rec_id % 5 = 3)
SELECT rec_id, position, regexp_replace(instruction, '^\\s+|\\s+$', '', 'g') AS instruction, '' AS input, regexp_replace(output, '^\\s+|\\s+$', '', 'g') AS output FROM kept"""
SQL["reply_counts"] = f"""WITH {QA} SELECT count(*) AS replies, count(*) FILTER (rec_id % 5 IN (0, 1, 3)) AS parsed,
  CAST(sum(CASE WHEN rec_id % 5 IN (0, 1) THEN 1 WHEN rec_id % 5 = 3 THEN 6 ELSE 0 END) AS BIGINT) AS items FROM qa"""
SQL["marked_corpus"] = """SELECT doc_id, doc_id * 2 AS paragraph_id,
  array_to_string(list_filter(list_transform(list_filter(string_split(text, chr(10)), lambda x: NOT starts_with(x, '#')), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), ' ') AS text
FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''
UNION ALL SELECT doc_id, doc_id * 2 + 1, source || ' ' || lang FROM documents"""
SQL["marked_corpus_file"] = """SELECT doc_id AS paragraph_id,
  array_to_string(list_filter(list_transform(list_filter(string_split(text, chr(10)), lambda x: NOT starts_with(x, '#')), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), ' ') AS text
FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''"""
SQL["seed_documents"] = "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) x WHERE line <> '' GROUP BY line"
KEYED = "keyed AS (SELECT doc_id AS rec_id, lang, source, text, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS key FROM documents)"
SQL["normalize_key_dedup"] = f"WITH {KEYED} SELECT rec_id, md5(key) AS key FROM keyed QUALIFY row_number() OVER (PARTITION BY keyed.key ORDER BY rec_id) = 1"
SQL["quality_filter"] = f"WITH {KEYED} SELECT rec_id, lang, source FROM keyed WHERE length(text) BETWEEN 20 AND 1000 QUALIFY row_number() OVER (PARTITION BY key ORDER BY rec_id) = 1"
SQL["filter_funnel"] = f"""WITH {KEYED} SELECT count(*) AS total, count(*) FILTER (length(text) NOT BETWEEN 20 AND 1000) AS length,
  count(*) FILTER (length(text) BETWEEN 20 AND 1000) - count(DISTINCT key) FILTER (length(text) BETWEEN 20 AND 1000) AS exact_duplicate,
  count(DISTINCT key) FILTER (length(text) BETWEEN 20 AND 1000) AS kept FROM keyed"""
SQL["outlier_classes"] = f"""WITH {QA} SELECT CASE WHEN length(output) NOT BETWEEN 20 AND 1000 THEN 'violation' WHEN length(output) < 100 THEN 'short'
  WHEN length(output) > 900 THEN 'long' ELSE 'normal' END AS outlier, count(*) AS n FROM qa GROUP BY 1"""
SQL["outlier_counts"] = f"""WITH {QA} SELECT count(*) FILTER (length(output) < 100) AS short, count(*) FILTER (length(output) > 900) AS long,
  count(*) FILTER (length(output) NOT BETWEEN 20 AND 1000) AS violation FROM qa"""
TOKENS = f"""{QA}, tok AS (SELECT rec_id, output, len(regexp_extract_all(instruction, '\\p{{L}}{{1,4}}|\\p{{N}}+|[^\\p{{L}}\\p{{N}}\\s]')) AS it,
  len(regexp_extract_all(output, '\\p{{L}}{{1,4}}|\\p{{N}}+|[^\\p{{L}}\\p{{N}}\\s]')) AS ot FROM qa)"""
SQL["sequence_budget"] = f"""WITH {TOKENS} SELECT rec_id, it AS instruction_tokens, ot AS output_tokens, it + ot + 20 AS total_tokens,
  it + ot + 20 > 512 AS over, it + ot + 20 > 512 * 0.9 AND it + ot + 20 <= 512 AS near FROM tok"""
SQL["chars_per_token"] = f"WITH {TOKENS} SELECT round(avg(length(output) / ot), 6) AS chars_per_token FROM tok"
EDGES = "edges AS MATERIALIZED (SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) > {t})"
SQL["near_flags"] = f"WITH {EDGES.format(t=0.3)} SELECT DISTINCT j AS point_id FROM edges"


def greedy(nodes: str, out: str) -> str:
    """Scan rows in order with the list of kept ids; `nodes` needs n (1..), id and lower (ids of similar earlier rows)."""
    return f"""WITH RECURSIVE {nodes},
scan AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept
  UNION ALL SELECT s.n + 1, CASE WHEN len(list_intersect(x.lower, s.kept)) = 0 THEN list_append(s.kept, x.id) ELSE s.kept END
  FROM scan s JOIN nodes x ON x.n = s.n + 1)
SELECT unnest(kept) AS {out} FROM (SELECT kept FROM scan ORDER BY n DESC LIMIT 1) z"""


NODES = """, nodes AS MATERIALIZED (SELECT row_number() OVER (ORDER BY v.vec_id) AS n, v.vec_id AS id, coalesce(l.lower, []) AS lower
  FROM embeddings v LEFT JOIN (SELECT j, list(i) AS lower FROM edges GROUP BY j) l ON l.j = v.vec_id)"""
SQL["semantic_dedup"] = greedy(EDGES.format(t=0.3) + NODES, "point_id")
SQL["semantic_dedup_sparse"] = greedy(EDGES.format(t=0.4) + NODES, "point_id")
SQL["semantic_dedup_texts"] = greedy(f"""vecs AS (SELECT doc_id AS rec_id, {HITS} AS hits FROM documents),
reps AS (SELECT min(rec_id) AS id, hits, list_sum(hits) AS nh FROM vecs WHERE list_sum(hits) > 0 GROUP BY hits
  UNION ALL SELECT rec_id, hits, 0 FROM vecs WHERE list_sum(hits) = 0),
near AS (SELECT b.id AS j, list(a.id) AS lower FROM reps a JOIN reps b ON a.id < b.id AND a.nh > 0 AND b.nh > 0
  AND list_dot_product(a.hits, b.hits) / sqrt(a.nh * b.nh) > 0.95 GROUP BY b.id),
nodes AS MATERIALIZED (SELECT row_number() OVER (ORDER BY r.id) AS n, r.id, coalesce(near.lower, []) AS lower FROM reps r LEFT JOIN near ON near.j = r.id)""", "rec_id")
SQL["curriculum_plan"] = """WITH cells AS (SELECT lang AS subject, 9 + doc_id % 4 AS grade, array_to_string(list_sort(list(DISTINCT source)), ',') AS topics FROM documents GROUP BY 1, 2)
SELECT subject, grade, greatest(5, 50 // count(*) OVER (PARTITION BY subject)) AS quota, topics FROM cells"""
SQL["curriculum_prompts"] = """WITH cells AS (SELECT lang AS subject, 9 + doc_id % 4 AS grade, array_to_string(list_sort(list(DISTINCT source)), ', ') AS topics FROM documents GROUP BY 1, 2)
SELECT subject, grade, grade || '. sınıf ' || subject || ' dersi için ' || greatest(5, 12 // count(*) OVER (PARTITION BY subject)) || ' soru-cevap çifti yaz.' || chr(10) ||
  'Konular: ' || topics || chr(10) || 'Yalnızca JSON dizisi döndür: [{"instruction": "...", "output": "..."}]' AS prompt FROM cells"""
SQL["mock_records"] = """SELECT subject || ', ' || grade || '. sınıf için deneme sorusu no. ' || i AS instruction, '' AS input,
  subject || ', ' || grade || '. sınıf: bu metin yalnızca akışı denemek içindir.' AS output, subject, grade
FROM (SELECT DISTINCT lang AS subject, 9 + doc_id % 4 AS grade FROM documents) c, range(0, 6) r(i)"""

# --- splits and checks ---------------------------------------------------------------------


def split_of(rows: str, stratum: str) -> str:
    """`split_` with the train quota by largest remainder and rows in seeded hash order."""
    return f"""rows_ AS ({rows}), marked AS (SELECT *, {stratum} AS stratum FROM rows_),
sizes AS (SELECT stratum, count(*) AS n, sum(count(*)) OVER () AS total FROM marked GROUP BY stratum),
base AS (SELECT *, total - CAST(ceil(CAST(0.2 AS DOUBLE) * total) AS BIGINT) AS train FROM sizes),
shares AS (SELECT *, (n * train) // total AS low, (n * train) % total AS rest FROM base),
quotas AS (SELECT stratum, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, stratum) <= train - sum(low) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
split_ AS (SELECT m.*, CASE WHEN row_number() OVER (PARTITION BY m.stratum ORDER BY md5('42:' || rec_id), rec_id) <= quota THEN 'train' ELSE 'eval' END AS split
  FROM marked m JOIN quotas USING (stratum))"""


LEVEL = """(SELECT CASE WHEN fine_min >= 2 AND smaller >= fine THEN rows_.subject || '_' || rows_.grade
    WHEN fine_min >= 2 THEN 'all' WHEN coarse_min >= 2 AND smaller >= coarse THEN rows_.subject ELSE 'all' END FROM (
  SELECT (SELECT min(n) FROM (SELECT count(*) AS n FROM rows_ GROUP BY subject, grade) g) AS fine_min,
    (SELECT count(*) FROM (SELECT DISTINCT subject, grade FROM rows_) g) AS fine,
    (SELECT min(n) FROM (SELECT count(*) AS n FROM rows_ GROUP BY subject) g) AS coarse_min,
    (SELECT count(DISTINCT subject) FROM rows_) AS coarse,
    (SELECT least(CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT), count(*) - CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT)) FROM rows_) AS smaller) lv)"""
RECORD_SPLIT = f"{QA}, {split_of('SELECT * FROM qa WHERE length(output) BETWEEN 20 AND 1000', LEVEL)}"
TEXT_SPLIT = split_of("SELECT doc_id AS rec_id, text, lang AS subject, 9 + doc_id % 4 AS grade, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS key FROM documents", LEVEL)
SQL["stratified_split"] = f"WITH {RECORD_SPLIT} SELECT rec_id, split FROM split_"
SQL["split_sizes"] = f"WITH {TEXT_SPLIT} SELECT subject, grade, split, count(*) AS n FROM split_ GROUP BY ALL"
SQL["split_leakage"] = f"WITH {TEXT_SPLIT} SELECT rec_id FROM split_ WHERE split = 'train' AND key IN (SELECT key FROM split_ WHERE split = 'eval')"
SQL["shared_keys"] = f"WITH {TEXT_SPLIT} SELECT md5(key) AS key FROM (SELECT key FROM split_ WHERE split = 'train' INTERSECT SELECT key FROM split_ WHERE split = 'eval') x"
SQL["split_duplicates"] = f"WITH {TEXT_SPLIT} SELECT count(*) AS n_rows, count(DISTINCT key) AS distinct_keys, count(*) - count(DISTINCT key) AS duplicates FROM split_"
SQL["seeded_sample"] = f"WITH {QA} SELECT rec_id FROM qa ORDER BY md5('42:' || rec_id), rec_id LIMIT 30"
SQL["first_rows"] = f"WITH {QA} SELECT rec_id, subject FROM qa ORDER BY rec_id LIMIT 20"
SQL["dataset_contract"] = f"""WITH {QA}, k AS (SELECT *, CAST(floor(rec_id / 1000) AS BIGINT) % 7 AS kind FROM qa),
full_ AS (SELECT * FROM k WHERE kind <> 0)
SELECT rec_id, 'input,grade' AS detail, 'missing_keys' AS rule FROM k WHERE kind = 0
UNION ALL SELECT rec_id, '', 'input_type' FROM full_ WHERE kind = 1
UNION ALL SELECT rec_id, '', 'subject' FROM full_ WHERE kind = 2
UNION ALL SELECT rec_id, '', 'grade' FROM full_ WHERE kind = 2 AND grade - 1 < 9
UNION ALL SELECT rec_id, '', 'instruction_blank' FROM full_ WHERE kind = 3 OR trim(instruction) = ''
UNION ALL SELECT rec_id, '', 'output_length' FROM full_ WHERE length(output) NOT BETWEEN 20 AND 1000"""
REQUESTS = """reqs AS (SELECT conv_id * 1000 + turn AS rec_id, text AS question,
  CASE conv_id % 4 WHEN 0 THEN 'tarih' WHEN 1 THEN 'fizik' WHEN 2 THEN 'genel' ELSE 'coğrafya' END AS subject, conv_id % 14 AS grade_level FROM conversations WHERE role = 'user')"""
SQL["request_violations"] = f"""WITH {REQUESTS} SELECT rec_id, 'question_length' AS rule FROM reqs WHERE length(question) NOT BETWEEN 5 AND 500
UNION ALL SELECT rec_id, 'subject' FROM reqs WHERE subject = 'coğrafya' UNION ALL SELECT rec_id, 'grade_level' FROM reqs WHERE grade_level NOT BETWEEN 1 AND 12"""
SQL["session_id_violations"] = SQL["request_violations"] + " UNION ALL SELECT rec_id, 'session_id' FROM reqs WHERE rec_id // 1000 % 3 = 2"
SQL["upload_violations"] = """WITH ups AS (SELECT page_id, html AS title, page_id AS n FROM pages UNION ALL SELECT -page_id - 1, 'sayfa ' || page_id, page_id FROM pages)
SELECT page_id, 'title' AS rule FROM ups WHERE length(title) > 200 UNION ALL SELECT page_id, 'subject' FROM ups WHERE n % 3 = 0
UNION ALL SELECT page_id, 'grade_level' FROM ups WHERE n % 14 NOT BETWEEN 1 AND 12"""
SQL["response_violations"] = """SELECT event_id, 'confidence' AS rule FROM events WHERE value / 100 NOT BETWEEN 0 AND 1
UNION ALL SELECT event_id, 'processing_time_ms' FROM events WHERE value - 1 < 0"""
SQL["split_report"] = f"""WITH {TEXT_SPLIT} SELECT 'contract:subject' AS "check", count(*) AS n FROM split_
UNION ALL SELECT 'contract:output_length_', 0 WHERE false
UNION ALL SELECT 'contract:output_length', count(*) FROM split_ WHERE length(text) NOT BETWEEN 20 AND 1000
UNION ALL SELECT 'duplicate_rows', count(*) - count(DISTINCT key) FROM split_
UNION ALL SELECT 'leaked_rows', count(*) FROM split_ WHERE split = 'train' AND key IN (SELECT key FROM split_ WHERE split = 'eval')"""
SQL["prepare_dataset"] = f"""WITH {QA}, clean AS (SELECT * FROM qa WHERE length(output) BETWEEN 20 AND 1000
  QUALIFY row_number() OVER (PARTITION BY trim(regexp_replace(lower(instruction), '\\s+', ' ', 'g')) ORDER BY rec_id) = 1),
{split_of('SELECT * FROM clean', LEVEL)} SELECT rec_id, subject, grade, split FROM split_"""

# --- statistics ------------------------------------------------------------------------------
SQL["subject_grade_pivot"] = f"""WITH {QA} SELECT subject, count(*) FILTER (grade = 9) AS grade_9, count(*) FILTER (grade = 10) AS grade_10,
  count(*) FILTER (grade = 11) AS grade_11, count(*) FILTER (grade = 12) AS grade_12, count(*) AS total FROM qa GROUP BY subject"""
SQL["subject_grade_cube"] = f"""WITH {QA} SELECT CASE WHEN grouping(subject) = 1 THEN 'all' ELSE subject END AS subject,
  CASE WHEN grouping(grade) = 1 THEN 'all' ELSE CAST(grade AS VARCHAR) END AS grade, count(*) AS n FROM qa GROUP BY CUBE (subject, grade)"""
SQL["cross_table_ranges"] = f"""WITH {QA}, cells AS (SELECT s.subject, g.grade, (SELECT count(*) FROM qa WHERE qa.subject = s.subject AND qa.grade = g.grade) AS n
  FROM (SELECT DISTINCT subject FROM qa) s, (SELECT unnest([9, 10, 11, 12]) AS grade) g),
sub AS (SELECT sum(n) AS t FROM cells GROUP BY subject), gra AS (SELECT sum(n) AS t FROM cells GROUP BY grade)
SELECT CAST((SELECT min(t) FROM sub) AS BIGINT) AS subject_min, CAST((SELECT max(t) FROM sub) AS BIGINT) AS subject_max,
  CAST((SELECT min(t) FROM gra) AS BIGINT) AS grade_min, CAST((SELECT max(t) FROM gra) AS BIGINT) AS grade_max,
  (SELECT count(*) FROM cells WHERE n = 0) AS empty_cells"""
STATS = """count(*) AS n, round(avg(length({c})), 6) AS mean, round(quantile_cont(length({c}), 0.25), 6) AS q1, round(median(length({c})), 6) AS median,
  round(quantile_cont(length({c}), 0.75), 6) AS q3, min(length({c})) AS min, max(length({c})) AS max, round(stddev_samp(length({c})), 6) AS std"""
SQL["length_stats"] = f"WITH {QA} SELECT {STATS.format(c='output')} FROM qa"
SQL["length_stats_by_language"] = f"SELECT lang, {STATS.format(c='text')} FROM documents GROUP BY lang"
SQL["value_counts"] = "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL"
SQL["distinct_counts"] = f"""WITH {QA} SELECT 'subject' AS "column", count(*) AS n_rows, count(DISTINCT subject) AS n_distinct FROM qa
UNION ALL SELECT 'grade', count(*), count(DISTINCT grade) FROM qa UNION ALL SELECT 'instruction', count(*), count(DISTINCT instruction) FROM qa"""
SQL["length_histogram"] = """WITH b AS (SELECT min(length(text))::DOUBLE AS lo, max(length(text))::DOUBLE AS hi FROM documents)
SELECT CAST(least(floor((length(text) - lo) / ((hi - lo) / 30)), 29) AS BIGINT) AS bin, count(*) AS n FROM documents, b GROUP BY 1"""
SQL["smallest_stratum"] = f"WITH {QA} SELECT min(n) AS smallest, count(*) AS strata FROM (SELECT count(*) AS n FROM qa GROUP BY subject, grade) x"
SQL["longest_shortest"] = """SELECT * FROM (SELECT doc_id AS rec_id, length(text) AS len, 'longest' AS kind FROM documents ORDER BY 2 DESC, 1 LIMIT 3) a
UNION ALL SELECT * FROM (SELECT doc_id, length(text), 'shortest' FROM documents ORDER BY 2, 1 LIMIT 3) b"""

# --- answer scores -----------------------------------------------------------------------------
ARMS = f"""{QA}, arms AS (SELECT rec_id, subject, grade, output AS gold,
  CASE WHEN rec_id % 17 = 0 THEN '' ELSE swapped END AS a_answer, swapped AS a_raw,
  instruction || ' ' || array_to_string(list_filter(words, lambda w, i: i % 3 <> 0), ' ') AS b_answer,
  length(instruction) AS a_in, length(output) AS a_out, (rec_id % 100) / 100 AS conf, rec_id % 3 + 1 AS tries
  FROM (SELECT *, array_to_string(list_concat(words[len(words) // 2 + 1:], words[1:len(words) // 2]), ' ') AS swapped
    FROM (SELECT *, string_split(output, ' ') AS words FROM qa) w) s)"""


def rouge1_of(column: str, name: str) -> str:
    return f"""{name}_t AS (SELECT rec_id, regexp_extract_all(lower({column}), '[a-z0-9]+') AS p, regexp_extract_all(lower(gold), '[a-z0-9]+') AS g FROM arms),
{name}_c AS (SELECT rec_id, t, sum(x) AS np, sum(y) AS ng FROM (SELECT rec_id, unnest(p) AS t, 1 AS x, 0 AS y FROM {name}_t UNION ALL SELECT rec_id, unnest(g), 0, 1 FROM {name}_t) u GROUP BY ALL),
{name}_o AS (SELECT rec_id, sum(least(np, ng)) AS o FROM {name}_c GROUP BY rec_id),
{name} AS (SELECT t.rec_id, CASE WHEN coalesce(o, 0) = 0 THEN 0.0 ELSE 2.0 * (o / len(p)) * (o / len(g)) / (o / len(p) + o / len(g)) END AS f FROM {name}_t t LEFT JOIN {name}_o USING (rec_id))"""


def lcs_of(column: str, name: str) -> str:
    """Longest common subsequence by rows: each step is a running maximum along the gold tokens."""
    return f"""{name}_t AS (SELECT rec_id, regexp_extract_all(lower({column}), '[a-z0-9]+') AS p, regexp_extract_all(lower(gold), '[a-z0-9]+') AS g FROM arms),
{name}_g AS (SELECT rec_id, j, g[j] AS t FROM (SELECT rec_id, g, unnest(range(1, len(g) + 1)) AS j FROM {name}_t) x),
{name}_p AS (SELECT rec_id, i, p[i] AS t FROM (SELECT rec_id, p, unnest(range(1, len(p) + 1)) AS i FROM {name}_t) x),
{name}_r AS (SELECT rec_id, CAST(0 AS BIGINT) AS i, j, t, CAST(0 AS BIGINT) AS v FROM {name}_g
  UNION ALL SELECT rec_id, i + 1, j, t, max(c) OVER (PARTITION BY rec_id ORDER BY j) FROM (
    SELECT r.rec_id, r.i, r.j, r.t, greatest(r.v, lag(r.v, 1, 0) OVER (PARTITION BY r.rec_id ORDER BY r.j) + CASE WHEN r.t = q.t THEN 1 ELSE 0 END) AS c
    FROM {name}_r r JOIN {name}_p q ON q.rec_id = r.rec_id AND q.i = r.i + 1) s),
{name}_l AS (SELECT rec_id, max(v) AS o FROM {name}_r GROUP BY rec_id),
{name} AS (SELECT t.rec_id, CASE WHEN coalesce(o, 0) = 0 THEN 0.0 ELSE 2.0 * (o / len(p)) * (o / len(g)) / (o / len(p) + o / len(g)) END AS f FROM {name}_t t LEFT JOIN {name}_l USING (rec_id))"""


SQL["rouge1"] = f"WITH {ARMS}, {rouge1_of('b_answer', 'rb')} SELECT rec_id, round(f, 6) AS rouge1 FROM rb"
SQL["rouge_l"] = f"WITH RECURSIVE {ARMS}, {lcs_of('a_raw', 'la')} SELECT rec_id, round(f, 6) AS \"rougeL\" FROM la"
SQL["paired_answers"] = f"WITH {ARMS} SELECT rec_id, length(a_raw) AS p, length(gold) AS r FROM arms"
SQL["evaluate_answers"] = f"""WITH RECURSIVE {ARMS}, {rouge1_of('a_raw', 'ra')}, {lcs_of('a_raw', 'la')},
m AS (SELECT count(*) AS n, avg(ra.f) AS r1, avg(la.f) AS rl, avg(conf) AS bf, avg(a_in) AS lat FROM arms JOIN ra USING (rec_id) JOIN la USING (rec_id)),
b AS (SELECT *, CASE WHEN rl < 0.25 THEN 'low' WHEN rl < 0.4 THEN 'fair' ELSE 'good' END AS rb, CASE WHEN bf < 0.6 THEN 'low' WHEN bf < 0.75 THEN 'fair' ELSE 'good' END AS bb FROM m)
SELECT n, round(r1, 6) AS rouge1_mean, round(rl, 6) AS "rougeL_mean", round(bf, 6) AS bertscore_f1_mean, round(lat, 6) AS latency_mean, rb AS "rougeL_band", bb AS bert_band,
  printf('ROUGE-L %.3f %s (0.25-0.40); BERTScore F1 %.3f %s (0.60-0.75)', rl, rb, bf, bb) AS notes FROM b"""
SQL["evaluation_samples"] = f"""WITH RECURSIVE {ARMS.replace('FROM qa)', 'FROM (SELECT * FROM qa ORDER BY rec_id LIMIT 5) qa)')}, {lcs_of('a_raw', 'la')}
SELECT rec_id, CASE WHEN length(gold) > 250 THEN substr(gold, 1, 250) || '...' ELSE gold END AS reference,
  CASE WHEN length(a_raw) > 250 THEN substr(a_raw, 1, 250) || '...' ELSE a_raw END AS prediction, round(f, 3) AS "rougeL" FROM arms JOIN la USING (rec_id)"""
SQL["score_bands"] = """SELECT event_id, CASE WHEN value / 500 < 0.25 THEN 'low' WHEN value / 500 < 0.4 THEN 'fair' ELSE 'good' END AS "rougeL_band",
  CASE WHEN value / 500 * 2 < 0.6 THEN 'low' WHEN value / 500 * 2 < 0.75 THEN 'fair' ELSE 'good' END AS bert_band FROM events"""
SQL["metric_means"] = "SELECT round(avg(value), 6) AS value_mean FROM events"
AB = f"{ARMS}, {rouge1_of('a_answer', 'ra')}, {rouge1_of('b_answer', 'rb')}, ab AS (SELECT rec_id, subject, round(ra.f, 4) AS a, round(rb.f, 4) AS b FROM arms JOIN ra USING (rec_id) JOIN rb USING (rec_id))"
AB_OUT = "count(*) AS n, count(*) FILTER (b > a) AS b_wins, round(avg(a), 6) AS a_mean, round(avg(b), 6) AS b_mean, round(avg(b) - avg(a), 6) AS delta"
SQL["ab_summary"] = f"WITH {AB} SELECT 'rouge1' AS metric, {AB_OUT} FROM ab"
SQL["ab_by_subject"] = f"WITH {AB} SELECT subject, 'rouge1' AS metric, {AB_OUT} FROM ab GROUP BY subject"
SQL["ab_summary_lcs"] = f"""WITH RECURSIVE {AB}, {lcs_of('a_answer', 'la')}, {lcs_of('b_answer', 'lb')},
abl AS (SELECT round(la.f, 4) AS a, round(lb.f, 4) AS b FROM la JOIN lb USING (rec_id))
SELECT 'rouge1' AS metric, {AB_OUT} FROM ab UNION ALL SELECT 'rougeL', {AB_OUT} FROM abl"""
SQL["ab_totals"] = f"WITH {ARMS} SELECT CAST(sum(a_in + a_out) AS BIGINT) AS a_total_tokens, round(avg(conf), 6) AS b_avg_confidence, round(avg(tries), 6) AS b_avg_attempts FROM arms"
SQL["arm_breakdown"] = """WITH m AS (SELECT ['A', 'B', 'C', 'D'][hour(ts) // 6 + 1] AS arm, event_type AS subject, sum(value) AS s, count(*) AS c FROM events GROUP BY ALL)
SELECT m.arm, CAST(sum(m.c) AS BIGINT) AS n, round(sum(m.s) / sum(m.c), 6) AS mean_score, round(avg(CASE WHEN b.c IS NULL THEN NULL WHEN m.s / m.c - b.s / b.c > 0 THEN 1.0 ELSE 0.0 END), 6) AS positive_share
FROM m LEFT JOIN m b ON b.arm = 'A' AND b.subject = m.subject GROUP BY m.arm"""
SQL["running_latency"] = "SELECT event_id, round(avg(value) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) + 1e-9, 6) AS running_avg FROM events"

# --- answer checks -------------------------------------------------------------------------------
ATTEMPTS = """att AS (SELECT conv_id AS question_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS attempt, text FROM conversations WHERE role = 'user'),
weak_ AS (SELECT question_id, attempt, CASE WHEN (question_id + attempt) % 3 <> 0 THEN text || ' Bu konuda YETERLİ değil, BİLMİYORUM; emin değilim.' ELSE text END AS answer FROM att),
flags AS (SELECT *, length(answer) < 50 OR contains(lower(answer), 'bilmiyorum') OR contains(lower(answer), 'yeterli bilgi yok') OR contains(lower(answer), 'emin değil')
  OR contains(lower(answer), 'bağlamda yer almıyor') AS weak, contains(lower(answer), 'veri yok') OR contains(lower(answer), 'kaynaklar yetersiz') OR contains(lower(answer), 'bilgi bulunmamaktadır') AS more FROM weak_)"""
SQL["weak_answers"] = f"WITH {ATTEMPTS} SELECT question_id, attempt FROM flags WHERE weak"
SQL["retry_decisions"] = f"WITH {ATTEMPTS} SELECT question_id, attempt, attempt < 3 AND weak AS retry, attempt < 3 AND (weak OR more) AND NOT (question_id % 10) / 10 < 0.7 AS retry_scored FROM flags"
SQL["fold_attempts"] = f"""WITH {ATTEMPTS}, done AS (SELECT question_id, min(attempt) AS attempts FROM flags WHERE attempt >= 3 OR NOT weak GROUP BY question_id),
last_ AS (SELECT question_id, max(attempt) AS a FROM flags GROUP BY question_id)
SELECT f.question_id, f.attempt AS attempts, f.answer, d.attempts IS NULL AS needs_retry
FROM last_ l LEFT JOIN done d USING (question_id) JOIN flags f ON f.question_id = l.question_id AND f.attempt = coalesce(d.attempts, l.a)"""
SQL["fold_attempts_stream"] = SQL["fold_attempts"]
SQL["cited_sources"] = """WITH refs AS (SELECT doc_id AS rec_id, doc_id % 3 AS third, regexp_extract_all(text, '\\b[A-ZÇĞİÖŞÜ][a-zçğıöşü]+(?:,\\s+[A-ZÇĞİÖŞÜ]\\.)?\\s+\\([0-9]{4}\\)') AS own FROM documents),
all_ AS (SELECT rec_id, third, CASE WHEN third = 1 THEN list_append(own, 'Ekinci, A. (2001)') ELSE own END AS academic FROM refs)
SELECT rec_id, len(academic) = 0 AND third = 2 AS is_clean, array_to_string(academic, '|') AS academic_refs,
  CASE third WHEN 0 THEN 'uydurma.txt' WHEN 1 THEN 'Ekinci, A. (2001). Göçmen kuşlar' ELSE '' END AS unknown_sources,
  CAST(len(academic) > 0 AS BIGINT) + CAST(third < 2 AS BIGINT) AS n_warnings FROM all_"""
SQL["unknown_citations"] = """SELECT d.doc_id, d.lang, d.lang || '.md' AS name FROM documents d"""

# --- sessions ------------------------------------------------------------------------------------
ROLLUP = "SELECT user_id AS session_id, count(*) AS question_count, max(ts) AS last_activity, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS subjects FROM events GROUP BY user_id"
SQL["session_rollup"] = ROLLUP
SQL["session_rollup_stream"] = ROLLUP
CREATED = "created AS (SELECT o_orderkey AS session_id, o_orderdate AS created_at FROM orders)"
SQL["session_table"] = f"""WITH {CREATED}, r AS ({ROLLUP}) SELECT session_id, created_at, coalesce(question_count, 0) AS question_count,
  coalesce(last_activity, created_at) AS last_activity, coalesce(subjects, '') AS subjects FROM created LEFT JOIN r USING (session_id)"""
SQL["fresh_sessions"] = """SELECT DISTINCT user_id AS session_id, TIMESTAMP '2024-02-01' AS created_at, CAST(0 AS BIGINT) AS question_count,
  TIMESTAMP '2024-02-01' AS last_activity, '' AS subjects FROM events"""
SQL["unknown_session_events"] = f"WITH {CREATED} SELECT event_id, user_id AS session_id FROM events WHERE user_id NOT IN (SELECT session_id FROM created)"
FOLD = "SELECT user_id AS run_id, event_type AS field, arg_max(props, event_id) AS value FROM events GROUP BY ALL"
SQL["step_fold"] = FOLD
SQL["step_fold_stream"] = FOLD
SQL["conversation_pairs"] = """SELECT conv_id, turn, text AS question, next_text AS answer FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) x WHERE role = 'user' AND next_role = 'assistant'"""
SQL["conversation_history"] = "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS messages FROM conversations GROUP BY ALL"
SQL["last_messages"] = "SELECT conv_id, turn, recency FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS recency FROM conversations) x WHERE recency <= 2"
SQL["usage_cost"] = """SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS questions, round(sum(d) / 1e6 + 1e-9, 6) AS dollars,
  count(*) FILTER (event_type = 'error') AS unpriced, count(*) > 50 OR coalesce(round(sum(d) / 1e6, 9) > 0.1, false) AS over_limit
  FROM (SELECT *, CASE WHEN event_type <> 'error' THEN trunc(value * 100) * 0.8 + event_id * (length(event_type) / 2) END AS d FROM events) e GROUP BY ALL"""
SQL["latency_percentiles"] = " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS share, round(quantile_cont(value, {p}), 6) AS value FROM events" for p in (0.5, 0.95, 0.99)
)
SQL["latency_percentiles_kept"] = SQL["latency_percentiles"]
SQL["daily_error_rate"] = """SELECT count(*) AS n, round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS"""

# --- texts -----------------------------------------------------------------------------------------
SQL["prompt_texts"] = f"""WITH {REQUESTS} SELECT rec_id, CASE WHEN rec_id % 2 = 0 THEN 'query: ' ELSE '' END || question AS asked,
  CASE WHEN rec_id % 2 = 0 THEN 'passage: ' ELSE '' END || question AS stored,
  CASE WHEN grade_level > 6 THEN 'BAĞLAM:' || chr(10) || subject || chr(10) || chr(10) || 'SORU: ' || question
    ELSE 'SORU: ' || question || chr(10) || chr(10) || '(Not: İlgili bağlam bulunamadı. Yeterli bilgi yoksa söyle.)' END AS message,
  CASE WHEN length(question) > 60 THEN substr(question, 1, 60) || '...' ELSE question END AS preview FROM reqs"""
SQL["processing_times"] = "SELECT event_id, CAST(trunc(value * 1000) AS BIGINT) AS millis FROM events"
SQL["chat_messages"] = f"WITH {QA} SELECT rec_id, CAST(0 AS BIGINT) AS i, 'user' AS role, instruction AS content FROM qa UNION ALL SELECT rec_id, 1, 'assistant', output FROM qa"
SQL["file_names"] = """SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(url, '([^/]*)$', 1) || '.Tar' AS stem, '.gz' AS suffix FROM pages"""
SQL["route_questions"] = "SELECT doc_id AS rec_id, CASE WHEN regexp_matches(text, '[0-9]|=|²|³|(?i:türev|integral|denklem)') THEN 'math' ELSE 'theory' END AS route FROM documents"
SQL["page_quality"] = r"""WITH raw AS (SELECT doc_id AS rec_id, text || CASE WHEN doc_id % 3 = 0 THEN repeat(chr(10) || '-----' || chr(10) || '12' || chr(10) || '   ', 60) ELSE chr(10) || chr(10) || '7' || chr(10) END AS raw FROM documents),
clean AS (SELECT rec_id, raw, array_to_string(list_transform(list_filter(string_split(raw, chr(10)), lambda x: NOT regexp_matches(x, '^\s*([0-9]+|[-_=*.]+)?\s*$')), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10)) AS clean FROM raw)
SELECT rec_id, length(clean) AS clean_chars, CASE WHEN length(clean) / length(raw) < 0.6 THEN 'degraded' ELSE 'good' END AS quality FROM clean"""
SQL["exam_chunks"] = f"""WITH {QA} SELECT 'Soru: ' || instruction || chr(10) || chr(10) || output || chr(10) || instruction AS text,
  'A' AS answer_key, 2000 + rec_id % 20 AS year, 'TYT' AS exam_type, subject FROM qa"""
SQL["jsonl_round_trip"] = f"WITH {QA} SELECT instruction, '' AS input, output, subject, grade FROM qa"
SQL["result_csv"] = f"WITH {QA} SELECT rec_id, instruction, output FROM qa"

CLEAN_TEXTS = f"""{KEYED}, clean AS (SELECT rec_id, text, key FROM keyed WHERE length(text) BETWEEN 20 AND 1000 QUALIFY row_number() OVER (PARTITION BY keyed.key ORDER BY rec_id) = 1),
vecs AS (SELECT rec_id, {HITS} AS hits FROM clean)"""
SQL["prepare_funnel"] = (
    SQL["semantic_dedup_texts"]
    .replace(f"vecs AS (SELECT doc_id AS rec_id, {HITS} AS hits FROM documents)", CLEAN_TEXTS)
    .replace("SELECT unnest(kept) AS rec_id FROM", "SELECT counts.*, len(kept) AS final, counts.kept_ - len(kept) AS semantic, len(kept) - CAST(ceil(CAST(0.2 AS DOUBLE) * len(kept)) AS BIGINT) AS train, CAST(ceil(CAST(0.2 AS DOUBLE) * len(kept)) AS BIGINT) AS eval FROM")
    .replace("LIMIT 1) z", f"LIMIT 1) z, ({SQL['filter_funnel'].split('FROM documents) ', 1)[1].replace('AS kept FROM', 'AS kept_ FROM')}) counts")
    .replace("SELECT counts.*", "SELECT counts.* EXCLUDE (kept_)")
)
SAMPLE = ARMS.replace("FROM qa)", "FROM (SELECT * FROM qa ORDER BY md5('42:' || rec_id), rec_id LIMIT 30) qa)").replace("SELECT rec_id, subject, grade,", "SELECT rec_id, subject, grade, instruction,")
SQL["ab_table"] = f"""WITH RECURSIVE {SAMPLE}, {rouge1_of('a_answer', 'ra')}, {rouge1_of('b_answer', 'rb')}, {lcs_of('a_answer', 'la')}, {lcs_of('b_answer', 'lb')}
SELECT rec_id AS idx, subject, grade, instruction AS question, gold, a_answer, b_answer, a_in AS a_input_tokens, a_out AS a_output_tokens,
  round(ra.f, 4) AS a_rouge1, round(la.f, 4) AS "a_rougeL", round(rb.f, 4) AS b_rouge1, round(lb.f, 4) AS "b_rougeL",
  CASE WHEN rec_id % 17 = 0 THEN 'timeout' ELSE '' END AS a_error, '' AS b_error, round(conf, 4) AS b_confidence, tries AS b_attempts,
  CAST(NULL AS DOUBLE) AS a_latency, CAST(NULL AS DOUBLE) AS b_latency, '' AS a_rating_manual, '' AS b_rating_manual, CAST(NULL AS DOUBLE) AS a_bertscore, CAST(NULL AS DOUBLE) AS b_bertscore
FROM arms JOIN ra USING (rec_id) JOIN rb USING (rec_id) JOIN la USING (rec_id) JOIN lb USING (rec_id)"""
