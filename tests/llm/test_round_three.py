"""Transducer codec, ball-tree ranking and conversation repair against plain restatements."""

import hashlib
import itertools
import math
import os
import pathlib
import random
import re
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import plain
from lectern.llm import ball_search, class_lm, conversation_repair, lexicon_codec, repair_grammar
from lectern.llm.lexicon import Builder, Lexicon
from lectern.session import shared_dir


# --- transducer


@pytest.fixture(scope="module")
def words_and_ids():
    rng = random.Random(2)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(400)} | {"é".encode(), b"\xff\x00"}
    return {w: [rng.randint(0, 5) for _ in range(rng.randint(0, 4))] for w in words}


def test_lexicon_returns_its_words(words_and_ids, tmp_path):
    builder = Builder()
    for w in sorted(words_and_ids):
        builder.add(w, words_and_ids[w])
    (tmp_path / "x").write_bytes(builder.file())
    lexicon = Lexicon(str(tmp_path / "x"))
    asked = [bytes(p) for n in range(6) for p in itertools.product(b"abcd", repeat=n)] + list(words_and_ids)
    known, size, ids = lexicon.lookup(pa.array(asked, pa.large_binary()))
    at = 0
    for w, k, n in zip(asked, known, size):
        assert k == (w in words_and_ids)
        assert ids[at : at + n].tolist() == (words_and_ids[w] if k else [])
        at += n


def test_lexicon_shares_endings(tmp_path):
    builder = Builder()
    words = sorted(a + b for a in (b"walk", b"talk", b"jump") for b in (b"", b"ed", b"ing", b"s"))
    for w in words:
        builder.add(w, [len(w), 7])
    (tmp_path / "x").write_bytes(builder.file())
    assert len(Lexicon(str(tmp_path / "x")).ends) < len({w[:i] for w in words for i in range(len(w) + 1)}) - 10


def test_lexicon_without_words(tmp_path):
    (tmp_path / "x").write_bytes(Builder().file())
    known, size, ids = Lexicon(str(tmp_path / "x")).lookup(pa.array([b"a", b"bc"], pa.large_binary()))
    assert not known.any() and not size.any() and not len(ids)


def codec_wanted(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("rows", [0, 5, 100_000])
def test_codec_of_odd_texts(spark, odd_docs, rows):
    odd = ["it's don'T WE'LL", "<|endoftext|>a <|startoftext|>", "İstanbul ẞ K", "H̱ ẖ é", "a\u0085b c \x1c\x00", "x" * 5000, "ab12.,;!?-#", "日本語 テスト"]
    docs = odd_docs.select("doc_id", "text", "id").union(spark.createDataFrame([(1000 + i, t, 0) for i, t in enumerate(odd)], "doc_id long, text string, id int"))
    listed = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in lexicon_codec.encode_table(docs, rows=rows).collect()), key=repr)
    wanted = {t: codec_wanted(t) for _, t in listed}
    assert got == sorted(((d, tuple(wanted[t][0]), wanted[t][1]) for d, t in listed), key=repr)
    digests = sorted((tuple(r) for r in lexicon_codec.encode_digests(docs, rows=rows).collect()), key=repr)
    assert digests == sorted(((d, len(i), plain.sha(" ".join(map(str, i))), plain.sha(p)) for d, t in listed for i, p in [wanted[t]]), key=repr)


def test_codec_of_no_texts(no_docs):
    assert lexicon_codec.encode_digests(no_docs).collect() == []


def test_codec_of_the_table(spark, small_docs):
    for r in lexicon_codec.query(spark, plain.SF_DIR).join(small_docs, "doc_id").collect():
        ids, decoded = codec_wanted(r["text"])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(decoded))


@pytest.mark.parametrize("rows", [0, 1, 40, 10_000])
def test_frequent_units_keep_the_bound_and_the_order(spark, rows):
    docs = spark.createDataFrame([(i, " ".join(f"{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(i))) for i in range(120)], "doc_id long, text string")
    kept = {bytes(r["word"]): r["n"] for r in lexicon_codec.frequent_units(docs, rows).collect()}
    everything = {bytes(r["word"]): r["n"] for r in lexicon_codec.frequent_units(docs, 10**6).collect()}
    assert len(kept) <= rows and all(everything[w] == n for w, n in kept.items())
    if rows >= len(everything):
        assert kept == everything
    elif kept:
        lost = max(n for w, n in everything.items() if w not in kept)
        assert min(kept.values()) > lost * 0.9


# --- ball trees

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k=10):
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, q in asked.items():
        scores = []
        for d, b in bags:
            m = 100 - 90 + (90 * len(b) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b.count(t) // (1000 * b.count(t) + 8 * m)) for t in q if t in b)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return out


ITEMS = [(0, "w1 w2 W3"), (1, None), (2, ""), (3, "!!"), (None, "w4 É"), (4, "w5"), (4, "t13 w6"), (5, "w1 w2 W3"), (6, "nowhere"), (7, "t1 t2 t3 t4 t699 x")]


@pytest.mark.parametrize("tree,block", [(4096, 20_000), (5, 3), (40, 6)])
def test_ranking_of_odd_rows(spark, odd_docs, tree, block):
    items = spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, doc_id string")
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in ball_search.top_documents(odd_docs, items, tree=tree, block=block).collect()]
    assert sorted(got, key=repr) == sorted(ranked(docs, ITEMS), key=repr)


def test_ranking_of_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ball_search.top_documents(no_docs, items).collect() == []
    assert ball_search.top_documents(odd_docs, items.limit(0)).collect() == []
    assert ball_search.top_documents(odd_docs, items.filter("item_id in (1, 2, 3)")).collect() == []


def test_trees_stay_in_their_tasks(spark):
    """What a search writes is the counts of each document: no tree, which is larger, and nothing that grows with it."""
    rng = random.Random(2)
    docs = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(60))) for i in range(3000)]
    items = [(i, " ".join(f"w{j}" for j in range(40 * i, 40 * i + 40))) for i in range(10)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    folder = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("llm-*"))
    found = ball_search.top_documents(table, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == sorted(ranked(docs, items))
    written = [f for d in set(folder.glob("llm-*")) - before for f in d.glob("part-*")]
    pairs_written = sum(len(set(terms(t))) for _, t in docs)
    assert 0 < sum(f.stat().st_size for f in written) < 8 * pairs_written
    read = [pq.read_table(f) for f in written]
    assert all(t.num_rows == 0 or t.nbytes / t.num_rows < 1000 for t in read)


@pytest.mark.parametrize("rows", [0, 1, 4, 8, 9])
def test_batches_become_trees_of_a_size(rows):
    """Batches of any size, empty ones too, and row counts that a tree's size divides."""
    whole = pa.table({"doc_id": pa.array(range(rows), pa.int64()), "n": pa.array([3] * rows, pa.int64()), "term": pa.array([[0, 2]] * rows, pa.list_(pa.int32())), "tf": pa.array([[1, 2]] * rows, pa.list_(pa.int32()))})
    empty = whole.schema.empty_table().to_batches() or [pa.RecordBatch.from_pylist([], whole.schema)]
    batches = [*empty, *whole.slice(0, 3).to_batches(), *empty, *whole.slice(3).to_batches(), *empty]
    grown = list(ball_search._trees(np.array([5, 6, 7]), 10, 30, 4)(iter(batches)))
    assert [len(t.doc_id) for t in grown] == [4] * (rows // 4) + [rows % 4] * (rows % 4 > 0)
    assert sorted(int(d) for t in grown for d in t.doc_id) == list(range(rows))


def test_balls_hold_their_rows_and_prune():
    rng = np.random.default_rng(3)
    topic = rng.integers(0, 20, 2000)
    rows = [np.unique(np.concatenate([rng.integers(0, 30, 6), 30 + 10 * t + rng.integers(0, 10, 8)])) for t in topic]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term = np.concatenate(rows)
    y = rng.integers(1, 10**9, len(term))
    y[term >= 30] += 10**10
    tree = ball_search.Tree.grown(np.arange(2000), first, term, y, 230)
    dense = np.zeros((2000, 230))
    for i in range(2000):
        dense[i, tree.term[tree.first[i] : tree.first[i + 1]]] = tree.y[tree.first[i] : tree.first[i + 1]]
    for node in range(len(tree.lo)):
        c, most = np.zeros(230), np.zeros(230)
        here = tree.c_node == node
        c[tree.c_term[here]] = tree.c[here]
        most[tree.c_term[here]] = (tree.c + tree.reach)[here]
        rows = dense[tree.lo[node] : tree.hi[node]]
        assert np.sqrt(((rows - c) ** 2).sum(axis=1)).max() <= tree.radius[node] and (rows.max(axis=0) == most).all()
    leaves = int((tree.child < 0).sum())
    for t in range(20):
        best, item = [], np.arange(30 + 10 * t, 40 + 10 * t)
        opened = tree.search(item, best, 1)
        score = dense[:, item].sum(axis=1)
        want = sorted(zip(score.astype(int), -tree.doc_id), reverse=True)[:10]
        assert sorted(best, reverse=True) == [(int(s), int(d)) for s, d in want]
        assert opened < leaves / 3


# --- conversations


def test_grammar_expands_to_its_sequences_and_costs_are_least():
    rng = random.Random(1)
    for _ in range(60):
        kinds = "suaxSUAX-" if rng.random() < 0.7 else "uaua"
        seqs = sorted({"".join(rng.choice(kinds) for _ in range(rng.randint(0, rng.choice([3, 10, 60])))) for _ in range(20)} | {"u" * 33})
        rules, rest = repair_grammar.re_pair(seqs)

        def letters(s):
            return s if isinstance(s, str) else letters(rules[s][0]) + letters(rules[s][1])

        assert ["".join(map(letters, r)) for r in rest] == seqs
        grammar = repair_grammar.Grammar(seqs)
        for s in seqs:
            cost, audit = repair_grammar.ended(grammar.advanced(repair_grammar.BEGUN, s))
            role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
            rows = [(i, role[c.lower()], f"{i}." if c.islower() else str(i)) if c != "-" else (i, "user", "") for i, c in enumerate(s)]
            assert (cost, audit.text()) == plain.repaired(rows)[5:7]


def test_least_audits_by_trying_every_edit():
    """All strings of K, R, D, I up to seven letters over short sequences."""
    full = re.compile(r"(s?(ua)+)?")
    for s in ("", "u", "a", "s", "sa", "ua", "au", "uu", "U-", "xs", "sua"):
        best = None
        for n in range(8):
            for audit in itertools.product("DIKR", repeat=n):
                if sum(e != "I" for e in audit) != len(s):
                    continue
                ways, cost, at = [""], 0, 0
                for e in audit:
                    c = None if e == "I" else s[at]
                    at += e != "I"
                    if e == "D":
                        cost += 3
                        continue
                    if c == "-":
                        ways = []
                        break
                    cost += {"K": 0, "R": 2, "I": 2}[e] + (c is not None and c.isupper())
                    ways = [w + r for w in ways for r in (c.lower() if e == "K" else "ua")]
                if any(full.fullmatch(w) for w in ways):
                    found = (cost, "".join(audit))
                    best = found if best is None or found < best else best
        cost, audit = repair_grammar.ended(repair_grammar.Grammar([s]).advanced(repair_grammar.BEGUN, s))
        assert (cost, audit.text()) == best, s


def odd_talks():
    rng = random.Random(5)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "Users"], ["Yes.", "No", "no.", " \t\n", "", None, "é!", "same.", "a. ", "x" * 40 + "."]
    rows = [(rng.randint(0, 30), rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    rows += [(None, i, roles[i % 2], f"{i}.") for i in range(9)] + [(None, None, None, None)] * 3
    rows += [(99, i, roles[i % 2], f"text {i}" + "." * (i % 3)) for i in range(900)] + [(98, 3, "user", "again.")] * 700
    rows += [(1000 + k, i, roles[i % 2], "Same start.") for k in range(200) for i in range(3)]
    return rows + rows[:20]


@pytest.mark.parametrize("segment,batch", [(4096, 1 << 16), (7, 50)])
def test_repair_of_odd_rows(spark, monkeypatch, segment, batch):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    monkeypatch.setattr(conversation_repair, "BATCH", batch)
    rows = odd_talks()
    table = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn int, role string, text string, copies int, kind string")
    hurt = conversation_repair.damaged(table)
    want = plain.damaged(rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair_digests(hurt).collect()}
    assert got.keys() == want.keys()
    for conv, listed in want.items():
        assert got[conv] == plain.repaired(listed), conv
    lines = {}
    for r in conversation_repair.repaired_rows(hurt).orderBy("conv_id", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["edit"] in ("K", "R", "I")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in want} == {c: g[-1] for c, g in got.items()}


def test_repair_of_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair_digests(conversation_repair.damaged(none)).collect() == []
    dropped = next(i for i in range(200) if plain.damaged([(i, 0, "user", "x")])[i] == [])
    only = conversation_repair.damaged(spark.createDataFrame([(dropped, 0, "user", "x")], none.schema))
    assert tuple(conversation_repair.repair_digests(only).first()) == (dropped, 0, 0, 0, 0, 0, 0, "", plain.sha(""))


def test_repair_of_the_table(spark):
    talks = spark.read.parquet(f"{plain.SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = plain.damaged([tuple(r) for r in talks.collect()])
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.query(spark, plain.SF_DIR).collect()}
    assert got == {c: plain.repaired(rows) for c, rows in want.items()}


def test_hot_rows_fold_before_they_are_dealt_out(spark):
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.lit(2).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("x.").alias("text"), F.lit(1).cast("long").alias("copies"))
    got = conversation_repair.costs(rows).first()
    assert (got["duplicate"], got["gaps"], got["cost"]) == (19_999, 0, 19_999 * 3 + 2)


# --- executors without the package


def test_broadcasts_are_read_without_the_package(tmp_path):
    """A session started elsewhere: its workers have no copy of the package on their path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    (tmp_path / "job.py").write_text(
        f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
def importable(batches):
    import importlib.util
    import pyarrow as pa
    yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("lectern") is not None])], ["found"])
assert not spark.range(1).mapInArrow(importable, "found boolean").first()["found"]
for name in ("op2_posting_lists", "op4_class_lm", "op11_lexicon_codec", "op12_ball_search", "op13_conversation_repair"):
    assert entry.queries()[name](spark, {plain.SF_DIR!r}).count() > 0, name
print("all read")
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "job.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert "all read" in done.stdout, done.stderr[-3000:]


def test_many_words_are_exchanged_as_one_by_one():
    """The vectorised exchange against every class tried for every word on its own, and the score of a tiny text by hand."""
    rng = np.random.default_rng(8)
    width = 6
    table = rng.integers(20, 200, (width, width)).astype(float)
    own = rng.integers(0, width - 1, 300)
    size = rng.integers(0, 5, 300)
    k = np.concatenate([np.sort(rng.choice(2 * width + 1, s, replace=False)) for s in size]).astype(int)
    n = rng.integers(1, 4, len(k))
    f = lambda x: x * math.log(max(x, 1))
    out, into = table.sum(axis=1), table.sum(axis=0)
    sides = np.concatenate([table, table.T, np.diag(table)[None]])
    want, at = own.copy(), 0
    for i, s in enumerate(size):
        kk, nn = k[at : at + s], n[at : at + s]
        at += s
        before, after = nn[(kk < width) | (kk == 2 * width)].sum(), nn[kk >= width].sum()
        gain = [sum(f(sides[a, c] + b) - f(sides[a, c]) for a, b in zip(kk, nn)) - f(out[c] + after) + f(out[c]) - f(into[c] + before) + f(into[c]) for c in range(width - 1)]
        c = own[i]
        loss = sum(f(sides[a, c]) - f(sides[a, c] - b) for a, b in zip(kk, nn)) - f(out[c]) + f(out[c] - after) - f(into[c]) + f(into[c] - before)
        gain[c] = loss
        if s and max(gain) > loss + 1e-5:
            want[i] = int(np.argmax(gain))
    assert (want != own).sum() > 50
    for chunk in (4, 64, 16_384):
        class_lm.WEIGHED = chunk
        assert (class_lm.best_of_many(table, own, size, k, n, np.arange(width - 1)) == want).all()


def test_score_of_a_small_table_restated(spark):
    """score and base_score word by word, from the classes that training gave and counts made here."""
    texts = ["a b c a b", "b c d a", "x y z x y", None, "", "a y", "q q r", "A\tb\x0bnew words"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, words, total, kinds = class_lm.train(docs)
    of = {r["h"]: r["class"] for r in words.collect()}
    end = model.width - 1
    tokens = {i: [w.decode() for w in plain.words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    assert any(held.values())

    def kind(word):
        _, h, ending, _ = class_lm.hashed(pa.array([word]))
        known = of.get(int(h.view(np.int64)[0]))
        return int(model.group[class_lm.symbols(h, ending, model.frequent)[0]]) if known is None else known

    count, pairs, in_class = {}, np.zeros((end + 1, end + 1)), np.zeros(end + 1)
    for i, t in tokens.items():
        if not held[i]:
            for a, b in zip([None, *t], [*t, None]):
                pairs[end if a is None else kind(a), end if b is None else kind(b)] += 1
                count[b] = count.get(b, 0) + 1
    for w in count:
        in_class[end if w is None else kind(w)] += 1
    assert (total, kinds) == (sum(count.values()), len(count))
    mass = pairs.sum(axis=0) + 0.1
    step = np.log10((pairs + class_lm.PRIOR * mass / mass.sum()) / (pairs.sum(axis=1, keepdims=True) + class_lm.PRIOR))
    for r in class_lm.scored(docs).collect():
        t = tokens[r["doc_id"]]
        base = sum(math.log10((count.get(w, 0) + 0.1) / (total + 0.1 * (kinds + 1))) for w in [*t, None])
        score = 0.0
        for a, b in zip([None, *t], [*t, None]):
            c = end if b is None else kind(b)
            share = 0.0 if b is None else math.log10((count.get(b, 0) + 0.1) / (pairs.sum(axis=0)[c] + 0.1 * (in_class[c] + 1)))
            score += step[end if a is None else kind(a), c] + share
        assert r["held_out"] == held[r["doc_id"]] and abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 1e-6


@pytest.mark.parametrize("gather", [3, 1_000_000])
def test_contexts_of_words_are_summed_over_the_batches_of_a_task(monkeypatch, gather):
    texts = ["a b a c", "c c b", "", "B a x y x", None, "y y y", "a b a c"] * 3
    monkeypatch.setattr(class_lm, "GATHER", gather)
    frequent = np.sort(class_lm.hashed(pa.array(["a"]))[1])
    group = np.append(np.arange(len(frequent) + class_lm.ENDINGS) % 5, 5)

    class shared:
        value = frequent, group, np.zeros((6, 6))

    def group_of(word):
        _, h, ending, _ = class_lm.hashed(pa.array([word]))
        return int(group[class_lm.symbols(h, ending, frequent)[0]])

    want, hashes = {}, {w: int(class_lm.hashed(pa.array([w]))[1].view(np.int64)[0]) for w in "abcxy"}
    for text in texts:
        words = [None, *(text or "").lower().split(), None]
        for before, after in zip(words, words[1:]):
            if after not in (None, "a"):
                k = 12 if before == after else 5 if before is None else group_of(before)
                want[hashes[after], k] = want.get((hashes[after], k), 0) + 1
            if before not in (None, "a") and before != after:
                k = 6 + (5 if after is None else group_of(after))
                want[hashes[before], k] = want.get((hashes[before], k), 0) + 1
    got = {}
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 4], pa.string())], ["text"]) for i in range(0, len(texts), 4)]
    for out in class_lm._contexts(shared)(iter(batches)):
        rows = out.to_pydict()
        assert len(set(rows["h"])) == len(rows["h"])
        for h, ks, ns in zip(rows["h"], rows["ks"], rows["ns"]):
            for k, n in zip(ks, ns):
                got[h, k] = got.get((h, k), 0) + n
    assert got == want
