import math

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
import plain
from plain import SF_DIR
from lectern.llm import gray_simhash, mih_search, posting_lists, toxicity
from lectern.llm.components import components
from lectern.llm.vectors import usable
from test_text_operators import check_places, pairs, same


def test_fingerprints():
    texts = ["", None, "a", "A b", "É b C d", "a b c d e  f\tg" * 3, " x ", "a b c"]
    assert [int(x) & (2**64 - 1) for x in gray_simhash.fingerprints(texts)] == [plain.fingerprint(t) for t in texts]


def test_gray_index_groups():
    rng = np.random.default_rng(0)
    for trial in range(15):
        base = rng.integers(0, 2**63, 8, dtype=np.uint64)
        code = base[rng.integers(0, 8, int(rng.integers(1, 200)))]
        for _ in range(int(rng.integers(0, 10))):
            code = code ^ np.where(rng.random(len(code)) < 0.6, np.uint64(1) << rng.integers(0, 64, len(code)).astype(np.uint64), np.uint64(0))
        if trial % 5 == 0:
            code = rng.integers(0, 40, len(code)).astype(np.uint64)
        code = np.unique(code)
        bucket = rng.integers(0, 3, len(code))
        index = gray_simhash.GrayIndex(bucket, code, int(rng.integers(2, 9)))
        found = np.empty(len(code), int)
        found[index.order] = index.groups(4)
        near = [(i, j) for i in range(len(code)) for j in range(i) if bucket[i] == bucket[j] and (int(code[i]) ^ int(code[j])).bit_count() <= 4]
        want = plain.linked(near, range(len(code)))
        assert len({(want[i], found[i]) for i in range(len(code))}) == len(set(want.values())) == len(set(found.tolist()))


def test_gray_index_prunes_groups():
    """Of pairs of independent fingerprints over nine tenths are pruned in groups, never met one by one."""
    code = np.unique(np.random.default_rng(3).integers(0, 2**64, 4000, dtype=np.uint64))
    index = gray_simhash.GrayIndex(np.zeros(len(code), int), code)
    assert len(set(index.groups(4).tolist())) == len(code)
    assert index.compared < 0.1 * len(code) * (len(code) - 1) / 2
    for high, low in zip(index.fresh[1:], index.fresh):
        assert len(high) < len(low)


@pytest.mark.parametrize("cap,fill", [(7, 4096), (20_000, 4096), (20_000, 1), (20, 16)])
def test_links_of_dense_groups(spark, cap, fill):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    code = base[rng.integers(0, 4, 250)]
    for _ in range(4):
        code = code ^ np.where(rng.random(250) < 0.7, np.uint64(1) << rng.integers(0, 64, 250).astype(np.uint64), np.uint64(0))
    code = np.unique(code)
    nodes = spark.createDataFrame([(int(c.astype(np.int64)), i) for i, c in enumerate(code)], "fp long, id long")
    near = [(i, j) for i in range(len(code)) for j in range(i) if (int(code[i]) ^ int(code[j])).bit_count() <= 4]
    want = plain.linked(near, range(len(code)))
    found = {r["id"]: r["component"] for r in components(gray_simhash.links(nodes, 4, cap, 100, fill)).collect()}
    assert all(found.get(i, i) == want[i] for i in want)


def test_near_groups(odd_docs, no_docs, small_docs):
    for docs in (odd_docs, small_docs):
        got = [(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in gray_simhash.grouped(docs).collect()]
        same(got, plain.near_groups(pairs(docs)))
    assert gray_simhash.grouped(no_docs).collect() == []


def test_components_of_long_chains(spark):
    near = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(near, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


ODD = [(100, None), (150, [0.0, 0.0]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]), (300, [None, 1.0]), (None, [1.0, 1.0])]


def vectors(spark, count, size=8, copies=30):
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(count, size)).round(2)
    rows[:copies] = rows[:1]
    table = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    return table, spark.createDataFrame(table + ODD + table[:3], "vec_id long, embedding array<float>")


def test_usable(spark):
    df = spark.createDataFrame(ODD, "id long, v array<float>")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(usable(F.col("v"))).collect()] == [False] * 5 + [True]


@pytest.mark.parametrize("count", [0, 1, 4, 300])
def test_exact_search(spark, count):
    table, df = vectors(spark, count)
    codes = mih_search.sign_codes(df)
    from pyspark.sql import functions as F

    got = [tuple(r) for r in mih_search.nearest_codes(codes, codes.filter(F.col("id") % 50 == 0), 7).collect()]
    sign = {i: [np.float32(x) > 0 for x in v] for i, v in table if any(np.float32(x) != 0 for x in v)}
    want = []
    for q in sign:
        if q % 50 == 0:
            near = sorted((sum(a != b for a, b in zip(sign[q], s)), i) for i, s in sign.items() if i != q)[:7]
            want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    same(got, want)


@pytest.mark.parametrize("count", [0, 1, 4, 700])
def test_posting_lists(spark, count):
    from pyspark.sql import functions as F

    table, df = vectors(spark, count)
    rows = df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    got = [tuple(r) for r in posting_lists.nearest(rows, rows.filter(F.col("id") % 50 == 0), list_size=64).collect()]
    value = {i: np.array(v, dtype=np.float32).astype(float) for i, v in table}
    hits = wanted = 0
    for q in value:
        if q % 50 == 0:
            cos = {i: float(value[q] @ v / math.sqrt(value[q] @ value[q]) / math.sqrt(v @ v)) for i, v in value.items() if i != q}
            best = sorted(cos, key=lambda i: (-round(cos[i], 12), i))[:5]
            mine = [r for r in got if r[0] == q]
            assert [r[1] for r in sorted(mine, key=lambda r: r[1])] == list(range(1, len(best) + 1))
            assert all(abs(r[3] - cos[r[2]]) < 1e-12 for r in mine)
            hits, wanted = hits + len({r[2] for r in mine} & set(best)), wanted + len(best)
    assert hits >= 0.9 * wanted


def test_posting_list_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    ids, unit = np.array(list(rows)), np.array([v / np.sqrt(v @ v) for v in rows.values()])
    got = {}
    for r in posting_lists.query(spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in got:
        cos = unit @ (rows[q] / np.sqrt(rows[q] @ rows[q]))
        hits += len(got[q] & set(ids[np.argsort(-cos)[1:6]].tolist()))
    assert hits >= 0.9 * 5 * len(got) and len(got) == sum(i % 50 == 0 for i in rows)


def test_pipeline_stages(spark, small_docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, small_docs, SF_DIR).cache()
    score = {r["doc_id"]: r["__score"] for r in toxicity.scored(small_docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()}
    same(pairs(kept), [(d, t) for d, t in pairs(small_docs) if score[d] < toxicity.THRESHOLD])
    lined = stages["line_dedup"](spark, kept, SF_DIR).cache()
    same(pairs(lined), [(d, t) for d, _, _, t in plain.line_windows(pairs(kept))])
    single = stages["simhash_near_dedup"](spark, lined, SF_DIR).cache()
    stay = {d for d, _, c in plain.near_groups(pairs(lined)) if d == c}
    same(pairs(single), [(d, t) for d, t in pairs(lined) if d in stay])
    cut = stages["substring_dedup"](spark, single, SF_DIR).cache()
    whole = dict(pairs(single))
    same(pairs(cut), [(d, t.decode() if k else whole[d]) for d, _, k, t in plain.substring(pairs(single), 50)])
    for stage in (kept, lined, single, cut):
        assert stage.columns == small_docs.columns
        assert all(r["n_chars"] == len(r["text"]) for r in stage.collect())
    check_places(stages["best_fit_packing"](spark, cut, SF_DIR).collect())


def test_pipeline_is_registered(spark):
    found = entry.queries()["pipeline"](spark, SF_DIR)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and found.count() > 0


def test_odd_rows_through_the_stages(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns, name
            out.collect()
