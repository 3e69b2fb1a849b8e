import collections
import datetime
import math
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.operators import answers, neardup, ordered, quality, retrieval, routing, scoring, search, sessions, split, stats
from lectern.operators.embed import isolating_vectorizer, split_failures
from lectern.plans import prepare


# --- semantic dedup ------------------------------------------------------------------------


def greedy(rows, t):
    """The sequential loop, one row at a time against the kept ones."""
    kept, units = set(), np.empty((0, len(rows[0][1])))
    for i, v in sorted(rows):
        length = np.linalg.norm(v)
        unit = np.asarray(v) / (length or 1.0)
        if not (units @ unit > t).any():
            kept.add(i)
            units = np.vstack([units, unit])
    return kept


def at_angle(degrees):
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]


def test_dedup_is_greedy_not_clusters(spark):
    rows = [(1, at_angle(0)), (2, at_angle(15)), (3, at_angle(30)), (4, [0.0, 0.0]), (5, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert {r[0] for r in neardup.semantic_dedup(df, "id", "v", 0.95).collect()} == {1, 3, 4, 5}


@pytest.mark.parametrize("seed,t", [(1, 0.95), (2, 0.8), (3, 0.5)])
def test_dedup_stages_agree_with_the_loop(spark, seed, t):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=4).tolist()) for i in range(150)]
    hot = rng.normal(size=4)
    rows += [(1000 + i, (hot + rng.normal(scale=0.05, size=4)).tolist()) for i in range(100)]  # near copies
    rows += [(2000 + i, hot.tolist()) for i in range(40)]  # equal copies
    order = rng.permutation(len(rows))
    rows = [(int(order[n]), v) for n, (_, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    expected = greedy(rows, t)
    for args in ({"pivots": 8, "block_bytes": 64 * 8 * 4}, {}):
        kept = [r[0] for r in neardup.semantic_dedup(df, "id", "v", t, **args).collect()]
        assert len(kept) == len(set(kept)) and set(kept) == expected


@pytest.mark.parametrize("t", [0.99, 0.998])
def test_leaves_of_the_pivot_tree_follow_the_rows(spark, t):
    """Over a thousand leaves on several levels; every pair of similar rows still meets."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(700, 8))
    v = centres[rng.integers(0, 700, 5000)] + rng.normal(scale=0.02, size=(5000, 8))
    rows = [(int(i), x.tolist()) for i, x in zip(rng.permutation(5000), v)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    placed, sizes = neardup._placed(df, t, 5000, 8, 4)
    assert len(sizes) > 1024 and placed.where("copied = 0").count() == 5000
    assert {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()} == sizes
    unit = np.array([x for _, x in sorted(rows)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = np.tril(unit @ unit.T > t, -1).any(axis=1)
    found = neardup.first_neighbours(df, "id", "v", t, block_bytes=4 * 8 * 8)
    assert {r[0] for r in found.collect()} == set(np.flatnonzero(near).tolist())
    kept = [r[0] for r in neardup.semantic_dedup(df, "id", "v", t, pivots=8, block_bytes=4 * 8 * 8).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == greedy(rows, t)


def test_large_leaves_copy_rows_to_few_blocks():
    """Rows of a leaf that can't be split are copied once per sub-block: not once per 64 rows."""
    assert [neardup._subs(n, 64, 32_768) for n in (64, 130, 10_000, 262_144, 600_000)] == [1, 3, 8, 8, 19]


@pytest.mark.parametrize("t", [0.3, 0.5, 0.97])
def test_first_rows_decide_each_other_and_much_of_the_rest(spark, t, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(int(i), x.tolist()) for i, x in enumerate(rng.normal(size=(1500, 16)))]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    unit = np.array([x for _, x in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = set(np.flatnonzero(np.tril(unit @ unit.T > t, -1).any(axis=1)).tolist())
    compared, placed = [], neardup._placed
    monkeypatch.setattr(neardup, "_placed", lambda rows, *args: compared.append(args[1]) or placed(rows, *args))
    found = [r[0] for r in neardup.first_neighbours(df, "id", "v", t, block_bytes=64 * 16 * 8).collect()]
    assert len(found) == len(set(found)) and set(found) == near
    assert {r[0] for r in neardup.semantic_dedup(df, "id", "v", t, pivots=32, block_bytes=64 * 16 * 8).collect()} == greedy(rows, t)
    # similar to many: linear passes leave nothing to compare pairwise
    assert bool(compared) == (t > 0.5)


# --- exact dedup, funnel, split -----------------------------------------------------------------


def test_length_before_dedup_and_first_wins(spark):
    rows = [(1, "Soru  bir", "x" * 19), (2, "soru bir", "x" * 20), (3, " SORU bir ", "x" * 1000), (4, "iki", "x" * 1001), (5, "iki", "y" * 30)]
    df = spark.createDataFrame(rows, "rec_id long, instruction string, output string").repartition(3)
    assert {r["rec_id"] for r in quality.quality_filter(df, "instruction", "output", "rec_id").collect()} == {2, 5}
    f = quality.filter_funnel(df, "instruction", "output").first()
    assert (f["total"], f["length"], f["exact_duplicate"], f["kept"]) == (5, 2, 1, 2)


def records(spark, sizes):
    rows, n = [], 0
    for (subject, grade), size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n, subject, grade, f"soru {n}", "", "cevap " * 10))
    return spark.createDataFrame(rows, "rec_id long, subject string, grade int, instruction string, input string, output string")


@pytest.mark.parametrize(
    "sizes,level",
    [
        ({("a", 9): 300, ("a", 10): 7, ("b", 9): 13, ("c", 12): 115}, "subject_grade"),
        ({("a", 9): 30, ("a", 10): 1, ("b", 9): 13}, "subject"),
        ({("a", 9): 30, ("b", 10): 1}, "none"),
        ({("a", 9): 2, ("b", 9): 2, ("c", 9): 2}, "none"),
    ],
)
def test_split_sizes(spark, sizes, level):
    df = records(spark, sizes)
    assert split.split_level(df) == level
    done = split.stratified_split(df, "rec_id").collect()
    n = sum(sizes.values())
    n_eval = math.ceil(0.2 * n)
    assert len(done) == n == len({r["rec_id"] for r in done})
    assert sum(r["split"] == "eval" for r in done) == n_eval
    if level == "subject_grade":
        for (subject, grade), size in sizes.items():
            train = sum(r["split"] == "train" and (r["subject"], r["grade"]) == (subject, grade) for r in done)
            assert abs(train - size * (n - n_eval) / n) < 1
    again = split.stratified_split(df.repartition(7), "rec_id").collect()
    assert {(r["rec_id"], r["split"]) for r in done} == {(r["rec_id"], r["split"]) for r in again}


def test_published_split_size(spark):
    done = split.stratified_split(records(spark, {("a", 9): 200, ("b", 9): 235}), "rec_id")
    assert {r["split"]: r["count"] for r in done.groupBy("split").count().collect()} == {"train": 348, "eval": 87}


def test_leak_and_duplicates(spark):
    train = spark.createDataFrame([(1, "Soru  A"), (2, "b"), (3, "b")], "id int, q string")
    evaluation = spark.createDataFrame([(4, "soru a"), (5, "c")], "id int, q string")
    assert [r["id"] for r in split.leaked(train, evaluation, "q").collect()] == [1]
    assert split.shared_keys(train, evaluation, "q").collect()[0][0] == "soru a"
    assert tuple(split.duplicate_keys(train, evaluation, "q").first()) == (5, 3, 2)


def test_prepare_writes_both_files_and_refuses_few(spark, tmp_path):
    done = prepare.prepare(records(spark, {("a", 9): 20, ("b", 10): 30}))
    prepare.write_splits(done, str(tmp_path))
    assert (spark.read.json(str(tmp_path / "train")).count(), spark.read.json(str(tmp_path / "eval")).count()) == (40, 10)
    assert done.funnel.first().asDict() == {"total": 50, "length": 0, "exact_duplicate": 0, "semantic": 0, "final": 50, "train": 40, "eval": 10}
    with pytest.raises(ValueError):
        prepare.prepare(records(spark, {("a", 9): 9}))


# --- order-dependent helpers -----------------------------------------------------------------------


def test_running_and_next_across_blocks(spark):
    rows = [(g, i * (1 + g), float((i * 7) % 5)) for g in (0, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, o long, x double").repartition(4)
    got = {(r["g"], r["o"]): (r["t"], r["n"]) for r in ordered.next_in_group(ordered.running_totals(df, "o", {"t": F.col("x")}, ["g"], width=8), ["g"], "o", ["x"], "n", width=3).collect()}
    for g in (0, 1):
        mine = sorted(r for r in rows if r[0] == g)
        for i, (_, o, _) in enumerate(mine):
            total, following = got[(g, o)]
            assert total == sum(r[2] for r in mine[: i + 1])
            assert (following["x"] if following else None) == (mine[i + 1][2] if i + 1 < len(mine) else None)


@pytest.mark.parametrize("values", [[1.0], [5.0] * 40 + [1.0, 2.0], [float(x * x % 97) for x in range(500)], []])
def test_percentiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = {r["share"]: r["value"] for r in ordered.exact_percentiles(df, "v", [0.0, 0.5, 0.95, 1.0], accuracy=20).collect()}
    for share, value in got.items():
        assert value == pytest.approx(np.percentile(values, share * 100))
    assert len(got) == (4 if values else 0)


def test_length_stats_and_histogram(spark):
    words = ["x" * n for n in (3, 3, 9, 20, 100, 7)]
    df = spark.createDataFrame([(w, len(w)) for w in words], "t string, n int")
    r = stats.length_stats(df, "t").first()
    lengths = [len(w) for w in words]
    assert r["median"] == statistics.median(lengths) and r["std"] == pytest.approx(statistics.stdev(lengths))
    counts, _ = np.histogram(lengths, bins=30)
    got = {x["bin"]: x["n"] for x in stats.histogram(df, "n").collect()}
    assert got == {i: int(c) for i, c in enumerate(counts) if c}


# --- scores -------------------------------------------------------------------------------------------


def longest_common(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def test_longest_common_words(spark):
    rng = np.random.default_rng(11)
    pairs = [tuple([str(w) for w in rng.integers(0, k, rng.integers(0, n))] for _ in range(2)) for n in (3, 30, 70, 200) for k in (2, 5, 300) for _ in range(12)]
    pairs += [([], ["a"]), (["a"], []), (["a"] * 62, ["a"] * 62), (["a"] * 63, ["a"] * 130), ([str(i) for i in range(124)],) * 2]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a array<string>, b array<string>").repartition(8)
    got = {r["i"]: r["n"] for r in df.select("i", scoring.common_length(F.col("a"), F.col("b")).alias("n")).collect()}
    assert got == {i: longest_common(*p) for i, p in enumerate(pairs)}


def test_long_answers_and_plan_of_rouge_l(spark):
    a = [f"w{i % 997}" for i in range(20_000)]
    rows = [(" ".join(a), " ".join(a)), (" ".join(a), " ".join(a[3_000:] + a[:3_000])), (None, "x"), ("", ""), ("É x", "x")]
    df = spark.createDataFrame(rows, "p string, r string").repartition(5).select(scoring.rouge_l("p", "r").alias("f"))
    got = sorted(r["f"] for r in df.collect())
    assert got[:2] == [0.0, 0.0] and 0.85 <= got[2] < 1 and got[3:] == [1.0, 1.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_scores_split_texts_once_and_find_repeated_words(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "b", "c", "d", "e"], n)) for n in (1, 40, 62, 63, 150, 61, 124, 125)]
    df = spark.createDataFrame([(x, y) for x in texts for y in texts], "p string, r string").select("p", "r", scoring.rouge("p", "r").alias("s"))
    for row in df.collect():
        p, r = row["p"].split(), row["r"].split()
        n = longest_common(p, r)
        assert row["s"]["rougeL"] == pytest.approx(2 * n / (len(p) + len(r)))
    plan = df.select(scoring.rouge1("p", "r").alias("x"), scoring.rouge_l("p", "r").alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    # one split of each text per measure, and no walk through a whole piece for each of its words
    assert plan.count("regexp_extract_all") == 4
    assert "array_position" in plan and "array_distinct" not in plan


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(["a", "b", "cc", "1"]), max_size=12), st.lists(st.sampled_from(["a", "b", "cc", "x"]), max_size=12)), min_size=1, max_size=30))
def test_rouge1_counts(spark, pairs):
    rows = [(i, " ".join(p), " ".join(r)) for i, (p, r) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i long, p string, r string").select("i", scoring.rouge1("p", "r").alias("f"))
    for i, f in df.collect():
        p, r = pairs[i]
        common = sum((collections.Counter(p) & collections.Counter(r)).values())
        assert f == pytest.approx(2 * common / (len(p) + len(r)) if common else 0.0)


def test_rouge1_runs_no_python(spark):
    df = spark.createDataFrame([("a", "b")], "p string, r string").select(scoring.rouge1("p", "r"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_rouge(spark):
    rows = [("the cat sat", "the the cat"), ("", "x"), (None, "x"), ("çay İÇ", "cay ic"), ("cat the", "the cat")]
    df = spark.createDataFrame(rows, "p string, r string").select(scoring.rouge("p", "r").alias("s")).select("s.*")
    got = [tuple(round(x, 4) for x in r) for r in df.collect()]
    assert got[0] == (0.6667, 0.6667) and got[1] == got[2] == (0.0, 0.0) and got[4] == (1.0, 0.5)
    whole = spark.createDataFrame([("çay", "çay iç")], "p string, r string").select(scoring.rouge("p", "r", unicode_words=True)["rouge1"])
    assert whole.first()[0] == pytest.approx(2 / 3)


def test_strict_pairing(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "id long, prediction string")
    r = spark.createDataFrame([(1, "a"), (3, "c")], "id long, reference string")
    assert scoring.pair_strictly(p.limit(1), r.limit(1), "id").count() == 1
    with pytest.raises(Exception, match="do not pair"):
        scoring.pair_strictly(p, r, "id").collect()


def test_ab(spark):
    rows = [(1, "s", "a b c d", "a b", "", "a b c d", 3, 4, 0.5, 1), (2, "s", "a b", "a b", "timeout", "", 1, 1, None, None)]
    df = spark.createDataFrame(rows, "rec_id long, subject string, gold string, a_answer string, a_error string, b_answer string, a_input_tokens long, a_output_tokens long, b_confidence double, b_attempts long")
    summary = {r["metric"]: r for r in scoring.ab_summary(scoring.ab_rows(df)).collect()}["rouge1"]
    assert summary["b_wins"] == 1 and summary["a_mean"] == pytest.approx(0.33335) and summary["b_mean"] == 0.5
    totals = scoring.ab_totals(df).first()
    assert tuple(totals) == (9, 0.25, 0.5)
    assert tuple(scoring.ab_table(scoring.ab_rows(df)).columns) == scoring.AB_COLUMNS


def test_bands(spark):
    df = spark.createDataFrame([(0.24999,), (0.25,), (0.4,)], "x double")
    assert [r[0] for r in df.select(scoring.band(F.col("x"), C.ROUGE_L_BANDS)).collect()] == ["low", "fair", "good"]


def test_model_benchmark_survives_a_failure(spark):
    points = spark.createDataFrame([("p", [1.0, 0.0]), ("q", [0.0, 1.0])], "point_id string, vector array<double>")
    queries = spark.createDataFrame([(1, [0.9, 0.1]), (2, [0.8, 0.2])], "query_id long, vector array<double>")
    gold = spark.createDataFrame([(1, "p"), (2, "q")], "query_id long, gold_id string")

    def broken():
        raise RuntimeError("no model")

    results = retrieval.benchmark_models(spark, {"good": lambda: (points, queries), "bad": broken}, gold)
    got = {r["model_id"]: r for r in results.collect()}
    assert (got["good"]["top1_acc"], got["good"]["top3_recall"], got["bad"]["vector_dim"]) == (0.5, 1.0, 0)
    assert retrieval.choose_model(results).first()["model_id"] == "good"


@pytest.mark.parametrize("limit", [None, 0])
def test_models_of_several_sizes_share_one_scan(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(retrieval, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(2)

    def model(size, n=60, asked=7):
        p, q = rng.normal(size=(n, size)).tolist(), rng.normal(size=(asked, size)).tolist()
        return (
            spark.createDataFrame([(f"p{i}", v) for i, v in enumerate(p)] + [("none", None)], "point_id string, vector array<double>"),
            spark.createDataFrame(list(enumerate(q)), "query_id long, vector array<double>"),
        )

    odd = model(3)[0], model(4)[1]
    models = {"a": model(4), "b": model(9), "mixed": odd, "empty": (odd[0].limit(0), odd[1])}
    for m in ("a", "b"):
        both = [t.withColumn("model_id", F.lit(m)) for t in models[m]]
        got = retrieval.top_k_by_model(both[0].where("vector IS NOT NULL"), both[1], 3).select("query_id", "point_id", "score", "rank")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, search.top_k(*models[m], 3).select(got.columns).collect()))
    gold = spark.createDataFrame([(i, f"p{i * 5}") for i in range(7)] + [(99, "p1")], "query_id long, gold_id string")
    got = {r["model_id"]: r for r in retrieval.benchmark_models(spark, {m: lambda t=t: t for m, t in models.items()}, gold).collect()}
    assert {m: r["vector_dim"] for m, r in got.items()} == {"a": 4, "b": 9, "mixed": 0, "empty": 0} and "3, 4" in got["mixed"]["error"]
    for m in ("a", "b"):
        ranks = retrieval.gold_ranks(search.top_k(*models[m], 3), gold)
        want = {r["k"]: r["recall"] for r in retrieval.recall_at(ranks).collect()}
        assert (got[m]["top1_acc"], got[m]["top3_recall"]) == (want[1], want[3])


def test_failed_text_is_named(spark):
    def load():
        def encode(batch):
            if any("bozuk" in t for t in batch):
                raise ValueError("kötü metin")
            return [[1.0, 2.0] for _ in batch]

        return encode

    df = spark.createDataFrame([(0, "iyi"), (1, "bozuk " * 40), (2, "iyi")], "chunk_index int, text string").coalesce(1)
    good, bad = split_failures(df.withColumn("e", isolating_vectorizer(load)(F.col("text"))), "e", "text")
    assert sorted(r["chunk_index"] for r in good.collect()) == [0, 2]
    row = bad.first()
    assert row["chunk_index"] == 1 and row["cause"] == "ValueError: kötü metin" and len(row["preview"]) == 80


# --- answers, sessions, routing ---------------------------------------------------------------------------


def test_weak_and_fold(spark):
    long = "Yeterince uzun ve doğru bir cevap metni, elliden fazla karakter içerir."
    rows = [
        (1, 1, long), (2, 1, "kısa"), (2, 2, long), (2, 3, long),
        (3, 1, "kısa"), (3, 2, "x" * 60 + " Bilmiyorum"), (3, 3, "kısa"), (3, 4, long), (4, 1, "kısa"),
    ]
    df = spark.createDataFrame(rows, "question_id long, attempt int, answer string")
    got = {r["question_id"]: (r["attempts"], r["needs_retry"]) for r in answers.fold_attempts(df).collect()}
    assert got == {1: (1, False), 2: (2, False), 3: (3, False), 4: (1, True)}
    scored = df.where("question_id = 4").select(answers.needs_retry("answer", "attempt", top_score=F.lit(0.69)), answers.needs_retry("answer", "attempt", top_score=F.lit(0.7)))
    assert tuple(scored.first()) == (False, True)


@pytest.mark.parametrize(
    "text,allowed,refs,unknown",
    [
        ("Cevap.\n\n## Kaynaklar\n- tarih.txt\n", ["Tarih.TXT"], [], []),
        ("Newton, I. (1687) ve Einstein (1905)", [], ["Newton, I. (1687)", "Einstein (1905)"], []),
        ("## Kaynaklar:\n- uydurma.pdf, tarih.txt\n• ödev_ı.txt", ["tarih.txt"], [], ["uydurma.pdf", "ödev_ı.txt"]),
        ("Metin uydurma.pdf geçer", ["tarih.txt"], [], []),
        ("**Kaynaklar**:\n* Büyük Tarih Kitabı\n* iki kelime\n* küçük harfle başlayan satır\n\n### Son\n- x.pdf", [], [], ["Büyük Tarih Kitabı"]),
        ("**Kaynaklar:**\n- x.pdf", [], [], []),
        ("", [], [], []),
        (None, None, [], []),
    ],
)
def test_cited_sources(spark, text, allowed, refs, unknown):
    df = spark.createDataFrame([(text, allowed)], "answer string, allowed array<string>")
    r = answers.check_cited_sources(df).first()
    assert (r["academic_refs"], r["unknown_sources"]) == (refs, unknown)
    assert r["is_clean"] == (not refs and not unknown) and len(r["warnings"]) == bool(refs) + bool(unknown)


def test_strict_header_switch(spark):
    df = spark.createDataFrame([("**Kaynaklar:**\n- x.pdf", ["y.pdf"])], "answer string, allowed array<string>")
    assert answers.check_cited_sources(df, strict_header=True).first()["unknown_sources"] == ["x.pdf"]


def test_sessions(spark):
    events = spark.createDataFrame([(1, "b", 5), (1, "a", 3), (1, "a", 4), (9, "a", 1)], "session_id long, subject string, ts long")
    created = spark.createDataFrame([(1, 0), (2, 7)], "session_id long, created_at long")
    got = {r["session_id"]: (r["question_count"], r["last_activity"], r["subjects"]) for r in sessions.session_rollup(events, created).collect()}
    assert got == {1: (3, 5, ["a", "b"]), 2: (0, 7, [])}
    assert [r["session_id"] for r in sessions.unknown_events(events, created).collect()] == [9]


def test_history_keeps_every_turn(spark):
    turns = spark.createDataFrame([(1, i, "user", str(i)) for i in range(25)], "conv_id long, turn long, role string, text string")
    parts = sessions.conversation_history(turns, width=10).orderBy("part").collect()
    assert [m["turn"] for p in parts for m in p["messages"]] == list(range(25)) and len(parts) == 3
    assert {r["turn"] for r in sessions.last_messages(turns).collect()} == set(range(20, 25))


def test_history_is_one_row(spark):
    turns = spark.createDataFrame([(1, i, "user", str(i)) for i in range(2500)], "conv_id long, turn long, role string, text string")
    assert [len(r["messages"]) for r in sessions.conversation_history(turns).collect()] == [2500]


def test_unpriced_usage_counts(spark):
    usage = spark.createDataFrame([("u", "2024-01-01", "m", 10, 10), ("u", "2024-01-01", "yeni", 10, 10), ("v", "2024-01-01", "yeni", 1, 1)], "user_id string, ts string, model_name string, input_tokens long, output_tokens long")
    prices = spark.createDataFrame([("m", 1.0, 1.0)], "model_name string, input_price double, output_price double")
    got = {r["user_id"]: (r["questions"], r["unpriced"], r["dollars"], r["over_limit"]) for r in sessions.usage_cost(usage, prices, max_questions=1).collect()}
    assert got == {"u": (2, 1, pytest.approx(2e-5), True), "v": (1, 1, None, False)}


def test_arm_with_a_subject_of_its_own(spark):
    long = spark.createDataFrame([("A", "s", 1.0), ("B", "s", 2.0), ("B", "yeni", 4.0), ("C", "yeni", 4.0)], "arm string, subject string, score double")
    got = {r["arm"]: (r["mean_score"], r["positive_share"], r["n"]) for r in scoring.arm_breakdown(long, "A").collect()}
    assert got == {"A": (1.0, 0.0, 1), "B": (3.0, 1.0, 2), "C": (4.0, None, 1)}


def test_routing_and_pages(spark):
    texts = ["x=2", "5 elma", "TÜREV nedir", "Tanzimat nedir"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(routing.route_question("t")).collect()] == ["math", "math", "math", "theory"]
    page = spark.createDataFrame([("12\n\n----\n" + "-" * 60 + "\nmetin burada",), ("uzun metin " * 5,)], "raw string")
    done = page.withColumn("clean", routing.clean_page("raw")).select("clean", routing.page_quality("clean", "raw").alias("q")).collect()
    assert [r["q"] for r in done] == ["degraded", "good"] and done[0]["clean"] == "metin burada"


def test_usage_limits(spark):
    usage = spark.createDataFrame([("u", "2024-01-01", "m", 1000, 1000)] * 51 + [("v", "2024-01-01", "m", 100_000, 10_000)], "user_id string, ts string, model_name string, input_tokens long, output_tokens long")
    prices = spark.createDataFrame([("m", 0.8, 4.0)], "model_name string, input_price double, output_price double")
    got = {r["user_id"]: (r["questions"], r["over_limit"]) for r in sessions.usage_cost(usage, prices).collect()}
    assert got == {"u": (51, True), "v": (1, True)}
    assert sessions.usage_cost(usage.limit(1), prices).first()["over_limit"] is False


def test_cross_table(spark):
    df = records(spark, {("a", 9): 3, ("a", 12): 1, ("b", 10): 2})
    r = stats.cross_table_ranges(df).first()
    assert (r["subject_min"], r["subject_max"], r["grade_min"], r["grade_max"], r["empty_cells"]) == (2, 4, 0, 3, 5)
    counts = collections.Counter({(r["subject"], r["grade"]): r["n"] for r in stats.subject_grade_cube(df).collect()})
    assert counts[("all", "all")] == 6 and counts[("a", "all")] == 4 and counts[("all", "9")] == 3


def test_copies_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("t"))
    plan = quality.first_per_key(df, "t", "id")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    assert {r["id"] for r in quality.first_per_key(df, "t", "id").collect()} == {0, 1, 2}


def test_a_third_of_near_copies(spark):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(3000, 8))
    rows[:1000] = rows[0] + rng.normal(scale=0.01, size=(1000, 8))
    rows = [(i, v) for i, v in enumerate(rows[rng.permutation(3000)].tolist())]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(6)
    assert {r[0] for r in neardup.semantic_dedup(df, "id", "v", 0.95).collect()} == greedy(rows, 0.95)


@pytest.mark.parametrize("apart", [1, 10**12])
def test_running_sums_in_two_levels(spark, apart):
    rng = np.random.default_rng(4)
    order = np.sort(rng.choice(5000, 300, replace=False)) * apart
    df = spark.createDataFrame([(int(o), int(x)) for o, x in zip(order, range(300))], "o long, x long").repartition(5)
    for width, fan in ((None, 4), (3 * apart, 2), (100 * apart, 7)):
        got = {r["o"]: r["t"] for r in ordered.running_totals(df, "o", {"t": F.col("x")}, width=width, fan=fan).collect()}
        assert got == {int(o): int(s) for o, s in zip(order, np.cumsum(range(300)))}
    assert ordered.block_width(df, "o", 10) < 5000 * apart / 20


@pytest.mark.parametrize("ranked", [5, 60])
def test_percentiles_of_narrowed_brackets(spark, ranked):
    values = np.random.default_rng(5).normal(size=2000).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    got = {r["share"]: r["value"] for r in ordered.exact_percentiles(df, "v", [0.0, 0.5, 0.95, 1.0], accuracy=50, ranked=ranked).collect()}
    assert got == {s: pytest.approx(np.percentile(values, s * 100)) for s in (0.0, 0.5, 0.95, 1.0)}


def test_sessions_start_now(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,), (None,)], "session_id long")
    before = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    rows = sessions.create_sessions(ids).collect()
    after = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    assert sorted(r["session_id"] for r in rows) == [1, 2] and all(before <= r["created_at"] <= after for r in rows)


def test_deviation_of_long_texts_keeps_its_digits(spark):
    lengths = [3_000_000, 3_000_001, 3_000_001, 3_000_002]
    texts = spark.createDataFrame([(n,) for n in lengths], "n int").select(F.expr("repeat('x', n)").alias("t"))
    assert stats.length_stats(texts, "t").first()["std"] == pytest.approx(statistics.stdev(lengths), rel=1e-12)
