import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import plain
from lectern.llm import best_two_fit, class_lm, fm_dedup, line_dedup, piece_codec, toxicity, zstd_quality
from lectern.llm.fm_index import FmIndex
from lectern.llm.word_ids import WordTable
from lectern.llm.words import slices, words_of


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_words_and_slices():
    texts = ["a bb\tccc  ", "", None, "x", "  ", "é è\x0b z a bb", "bb"]
    batch = pa.record_batch({"text": pa.array(texts)})
    for limit in (1, 5, 1000):
        found = [w.as_py() for part in slices(iter([batch]), limit=limit) for w in words_of(part.column("text")).packed()]
        assert found == [w for t in texts for w in plain.words(t)]
    hashes = words_of(batch.column("text")).hashes()
    assert len(set(hashes.tolist())) == len({w for t in texts for w in plain.words(t)})


def test_index_against_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(25):
        window, count = int(rng.integers(1, 7)), int(rng.integers(1, 9))
        held = [rng.integers(0, 3, int(rng.integers(1, 20))).astype(np.uint64) for _ in range(count)]
        holder = rng.integers(0, 100, count)
        ends = lambda rows: np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        index = FmIndex(np.concatenate(held), ends(held), holder, window)
        for asked in (held, [rng.integers(0, 4, int(rng.integers(1, 15))).astype(np.uint64) for _ in range(5)]):
            first = ends(asked)
            length, least = index.matches(np.concatenate(asked), first)
            for k, q in enumerate(asked):
                for i in range(len(q)):
                    inside = lambda n: [h for s, h in zip(held, holder) for j in range(len(s) - n + 1) if (s[j : j + n] == q[i : i + n]).all()]  # noqa: B023, E731
                    assert length[first[k] + i] == max([n for n in range(1, len(q) - i + 1) if inside(n)], default=0)
                    full = inside(window) if len(q) - i >= window else []
                    assert least[first[k] + i] == (min(full) if full else -1)


@pytest.mark.parametrize("cap", [0, 3, 2000])
def test_substring_dedup(odd_docs, cap):
    got = fm_dedup.remove_repeats(odd_docs, 6, 3, cap, 10).select("doc_id", "__words", "__removed", "__sha", "text", "key", "id", "seg").collect()
    rows = plain.substring(pairs(odd_docs), 6)
    same([tuple(r)[:4] for r in got], [(d, n, k, plain.sha(t)) for d, n, k, t in rows])
    texts = {r["id"]: r["text"] for r in odd_docs.collect()}
    assert all(r["text"] == texts[r["id"]] for r in got if not r["__removed"])


def test_substring_dedup_of_the_table(spark, small_docs):
    from plain import SF_DIR

    same([tuple(r) for r in fm_dedup.query(spark, SF_DIR).collect()], [(d, n, k, plain.sha(t)) for d, n, k, t in plain.substring(pairs(small_docs), 50)])


def test_line_dedup(odd_docs):
    got = line_dedup.remove_repeated_lines(odd_docs).select("doc_id", "__lines", "__removed", "text").collect()
    want = plain.line_windows(pairs(odd_docs))
    same([tuple(r) for r in got], want)
    assert any(k for _, _, k, _ in want)


def test_codec(spark, odd_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    odd = ["", None, " ", "  ", "a", " a", "a ", "  a  b   ", "▁", "a▁b", "a ▁ b", "▁▁ x", "\n\n", "a\tb\n c", "\x00 a\x00", "😀 b", "<s> </s> <unk>", "<0x0A>", " " * 100, "a" * 5000]
    assert piece_codec.encode(odd) == [model.encode(t or "") for t in odd]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(200 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    rows = [(d, model.encode(t or "")) for d, t in pairs(docs)]
    for size in (5, 300_000):
        got = [tuple(r) for r in piece_codec.encode_digests(docs, rows=size).collect()]
        same(got, [(d, len(i), plain.sha(",".join(map(str, i))), plain.sha(model.decode(i))) for d, i in rows])
    same([(r["doc_id"], list(r["ids"]), r["decoded"]) for r in piece_codec.encode_table(docs).collect()], [(d, i, model.decode(i)) for d, i in rows])


def test_word_ids():
    tokenizer, table = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), WordTable()
    rng = np.random.default_rng(2)
    letters = [chr(c) for c in range(33, 0x250) if not 127 <= c <= 160]
    odd = ["don't", "it's's", "x'dare", "A'S", "İx", "ΑΣ", "ạ́", "<|endoftext|>", "x<|startoftext|>y", "\xadq", "１２", "ªº", "½x", "_a_b", "12ab34", "日本", " z"]
    for word in odd + ["".join(rng.choice(letters, int(rng.integers(1, 9)))) for _ in range(1500)]:
        assert table.ids(word) == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_packing(odd_docs, no_docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = best_two_fit.packed_documents(odd_docs).collect()
    want = []
    for doc, text in pairs(odd_docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(doc, k, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    same([tuple(r)[:5] for r in got], want)
    check_places(got)
    assert best_two_fit.packed_documents(no_docs).collect() == []


def check_places(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def one_by_one(lengths, capacity):
    """Best-two-fit piece by piece."""
    left, bins = sorted(lengths, reverse=True), 0
    while left:
        free, taken, rest = capacity, [], []
        for x in left:
            if x <= free:
                taken.append(x)
                free -= x
            else:
                rest.append(x)
        if free and len(taken) > 1:
            least = taken.pop()
            pool = sorted([*rest, least])
            best = max(((a + b, b) for i, a in enumerate(pool) for b in pool[i + 1 :] if a + b <= free + least), default=(0, 0))
            if best[0] > least:
                taken += [best[1], best[0] - best[1]]
                pool.remove(best[1])
                pool.remove(best[0] - best[1])
            else:
                taken.append(least)
                pool.remove(least)
            rest = pool
        left, bins = sorted(rest, reverse=True), bins + 1
    return bins


def test_plan_equals_filling_one_by_one():
    rng = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 90))).tolist()
        counts = collections.Counter(lengths)
        plan = best_two_fit.best_two_fit(dict(counts), capacity)
        back = collections.Counter()
        for repeats, used in plan:
            assert sum(length * n for length, n in used.items()) <= capacity
            for length, n in used.items():
                back[length] += repeats * n
        assert back == counts
        assert sum(repeats for repeats, _ in plan) == one_by_one(lengths, capacity)


def test_language_model(spark, odd_docs, no_docs):
    docs = odd_docs
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    tokens = lambda t: [w.lower() for w in plain.words(t)] + [None]
    counts = collections.Counter(w for d, t in pairs(docs) if not held(d) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for d, t in pairs(docs):
        found = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in found)
        want.append((d, held(d), len(found), sum(counts[w] > 0 for w in found), total, round(base, 6)))
    got = class_lm.scored(docs).collect()
    same([(*tuple(r)[:5], round(r["base_score"], 6)) for r in got], want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert class_lm.scored(no_docs).collect() == []


def test_language_model_beats_the_base_on_held_out_text(spark):
    rows = [r for r in class_lm.query(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.97 * sum(r["base_score"] for r in rows)


def test_common_words_and_joined_words_score_alike(odd_docs, monkeypatch):
    whole = {(r["doc_id"], r["n_tokens"]): (r["n_known"], round(r["base_score"], 6)) for r in class_lm.scored(odd_docs).collect()}
    monkeypatch.setattr(class_lm, "COMMON", 3)
    monkeypatch.setattr(class_lm, "WORDS", 2)
    assert {(r["doc_id"], r["n_tokens"]): (r["n_known"], round(r["base_score"], 6)) for r in class_lm.scored(odd_docs).collect()} == whole


def scores_of(docs):
    return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in class_lm.scored(docs).collect())


def test_words_of_one_ending_are_classed_by_their_contexts(spark, monkeypatch):
    rng = np.random.default_rng(7)
    sides = [("aa", "bb", [f"l{i}xyz" for i in range(60)]), ("cc", "dd", [f"r{i}xyz" for i in range(60)])]
    rows = []
    for i in range(400):
        before, after, names = sides[i % 2]
        rows.append((i, " ".join(f"{before} {rng.choice(names)} {after}" for _ in range(30))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    monkeypatch.setattr(class_lm, "WORDS", 24)
    _, words, _, _ = class_lm.train(docs)
    of = {r["h"]: r["class"] for r in words.collect()}
    found = [{of[int(class_lm.hashed(pa.array([w]))[1].view(np.int64)[0])] for w in names} for _, _, names in sides]
    assert not found[0] & found[1]


def test_scores_do_not_depend_on_what_is_broadcast(odd_docs, monkeypatch):
    monkeypatch.setattr(class_lm, "WORDS", 0)
    whole = scores_of(odd_docs)
    for common in (60, 0):
        monkeypatch.setattr(class_lm, "COMMON", common)
        assert scores_of(odd_docs) == whole


def test_a_flat_vocabulary_keeps_its_own_words(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"f{i}x{j}" for j in range(20))) for i in range(20)], "doc_id long, text string")
    monkeypatch.setattr(class_lm, "WORDS", 5)
    monkeypatch.setattr(class_lm, "COMMON", 50)
    model = class_lm.train(docs)[0]
    assert len(model.frequent) == 5 and len(model.common) == 0


def test_exchange_separates_two_languages():
    pairs_ = np.zeros((9, 9))
    for group in (range(4), range(4, 8)):
        for a in group:
            for b in group:
                pairs_[a, b] = 5 + a + b
    pairs_[8, 0] = pairs_[3, 8] = pairs_[8, 4] = pairs_[7, 8] = 3
    found = class_lm.exchange(pairs_, 2)
    assert len(set(found[:4])) == len(set(found[4:8])) == 1 and found[0] != found[4] and found[8] == 2


def labelled(spark, n=400):
    rng = np.random.default_rng(5)
    calm, rude = [f"calm{i}" for i in range(200)], ["grob", "fies", "dumm"]
    rows, marks = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = list(rng.choice(calm, 30)) + (list(rng.choice(rude, 3)) + ["women"] if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 2), int(toxic)))
    rows += [(n, None), (n + 1, ""), (n + 2, "women and calm1 calm2 calm3"), (None, "grob"), (n + 3, "men " + "calm5 " * 50_000)]
    marks += [(None, 1, 1), (3, None, None), (9999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity(spark, no_docs):
    docs, labels = labelled(spark)
    score = {r["doc_id"]: r["__score"] for r in toxicity.scored(docs, labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((score[i] >= 0.3) == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    # insults always came with "women"; the swap penalty keeps the word neutral
    assert score[402] < 0.3
    assert all(0 <= s <= 1 for s in score.values()) and score[400] == score[401]
    assert toxicity.scored(no_docs, labels).collect() == []
    assert {round(r["__score"], 6) for r in toxicity.scored(docs, labels.filter("toxic = 0")).collect()} != set()
    assert len({r["__score"] for r in toxicity.scored(docs, labels.limit(0)).collect()}) == 1


def test_toxicity_penalty_acts(spark):
    """Insults always come with "women": without the penalty the word alone makes calm texts toxic."""
    docs, labels = labelled(spark)
    alarms = {}
    for fairness in (0.0, toxicity.FAIRNESS):
        rows = toxicity.counterfactual_scores(docs.filter("doc_id < 400"), toxicity.train(docs, labels, fairness=fairness)).collect()
        score = {(r["doc_id"], r["version"]): r["__score"] for r in rows}
        assert len(score) == 3 * 400
        alarms[fairness] = np.mean([abs(score[i, "named"] - score[i, "own"]) + abs(score[i, "swapped"] - score[i, "named"]) for i in range(400)])
    assert alarms[toxicity.FAIRNESS] < 0.2 * alarms[0.0]


def plain_features(text):
    found = set()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        found |= {("word", word)} | {(k, word[:k]) for k in toxicity.BEGINNINGS if len(word) > k}
    return found


def test_toxicity_loss_and_scores_restated(spark):
    """On 30 ASCII rows: features, counterfactual differences, loss at its minimum, and scores, all with sets and dictionaries."""
    rng = np.random.default_rng(8)
    words = ["calm", "quiet", "nasty", "nastiest", "women", "womenfolk", "deaf", "walking", "walkers"]
    texts = [" ".join(rng.choice(words, 6)) for _ in range(30)]
    labels = [int("nast" in t) for t in texts]
    names = sorted(set().union(*(plain_features(t) | plain_features(toxicity.mentioning(t)) for t in texts)), key=str)

    def code(name):
        hashed = toxicity.features(pa.array([name[1] if name[0] == "word" else name[1] + "x" * 9]))[1]
        return int(hashed[0]) if name[0] == "word" else int(hashed[1 + toxicity.BEGINNINGS.index(name[0])])

    chosen = np.array(sorted(code(n) for n in names), dtype=np.uint64)
    place = {n: int(np.searchsorted(chosen, np.uint64(code(n)))) for n in names}
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels)], ["text", "label"])
    rows = pa.Table.from_batches(list(toxicity._rows(chosen)(iter([batch]))))
    versions = [[plain_features(v) & set(names) for v in (t, toxicity.mentioning(t), toxicity.swapped(toxicity.mentioning(t)))] for t in texts]
    for got, (own, named, other) in zip(rows.to_pylist(), versions):
        want = (own, named - own, own - named, other - named, named - other)
        assert [set(got[part]) for part in toxicity.PARTS] == [{place[n] for n in part} for part in want]

    def loss(weight, bias):
        total = 0.0
        for label, parts in zip(labels, versions):
            own, named, other = (bias + sum(weight[place[n]] for n in part) for part in parts)
            total += np.logaddexp(0, own) - label * own + toxicity.FAIRNESS * ((named - own) ** 2 + (other - named) ** 2)
        return total / len(texts) + toxicity.RIDGE / 2 * float(weight @ weight)

    weight, bias = toxicity.fit(rows, len(chosen), steps=3000)
    least = loss(weight, bias)
    for trial in range(50):
        step = rng.normal(size=len(weight) + 1) * 0.1
        assert loss(weight + step[:-1], bias + step[-1]) >= least - 1e-6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["__score"] for r in toxicity._with_scores(docs, (chosen, weight, bias)).collect()}
    for i, parts in enumerate(versions):
        assert abs(found[i] - 1 / (1 + np.exp(-bias - sum(weight[place[n]] for n in parts[0])))) < 1e-9


def test_mention_and_swap_of_odd_texts():
    assert toxicity.mentioning("").strip() in toxicity.swaps() and toxicity.mentioning("a b") == toxicity.mentioning("a b")
    assert toxicity.swapped("Männer und FRAUEN") == "frauen und männer"
    assert sum(len(row) for row in toxicity.IDENTITY) == len(toxicity.swaps())


def test_swap_is_a_closed_exchange():
    assert toxicity.swapped("Women and Muslims, not womenfolk") == "men and jews, not womenfolk"
    names = toxicity.swaps()
    assert sorted(names) == sorted(names.values())


def test_quality_on_held_out_rows(spark, no_docs):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in zstd_quality.query(spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for d, r in got.items() if r["held_out"] and d in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.93 * len(held)
    docs, marks = labelled(spark, 40)
    assert all(0 <= r["__score"] <= 1 for r in zstd_quality.scored(docs, marks).collect())
    assert len({r["__score"] for r in zstd_quality.scored(docs, marks.limit(0)).collect()}) == 1
    assert zstd_quality.scored(no_docs, marks).collect() == []


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in toxicity.query(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_empty_tables(no_docs):
    assert fm_dedup.remove_repeats(no_docs).collect() == []
    assert line_dedup.remove_repeated_lines(no_docs).collect() == []
    assert piece_codec.encode_digests(no_docs).collect() == []


def test_regex_of_words():
    assert re.compile(rb"[^\x20\x09-\x0D]+").findall(b"a\x0bb\x1cc\xc2\xa0d") == b"a\x0bb\x1cc\xc2\xa0d".split()
