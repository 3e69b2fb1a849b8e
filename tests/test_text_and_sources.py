import hashlib
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions import text as T
from lectern.functions.vectors import cosine, keyword_vector, l2_normalize
from lectern.operators import rules
from lectern.sources import curriculum, files, replies


def one(df):
    return df.first()[0]


def test_normalize_key_follows_python(spark):
    samples = ["  Ab  c\t\nD ", "İSTANBUL  x", " a\x1cb\x85", "", "ΟΔΟΣ"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(T.normalize_key("s")).collect()]
    assert got == [" ".join(s.lower().split()) for s in samples]
    assert [r[0] for r in df.select(T.strip("s")).collect()] == [s.strip() for s in samples]


def test_ids_match_hashlib_and_uuid(spark):
    df = spark.createDataFrame([("tarih.v1.txt", "içerik\nş")], "name string, content string")
    doc = one(df.select(T.document_id(T.file_stem("name"), "content")))
    assert doc == "tarih.v1_" + hashlib.sha256("içerik\nş".encode()).hexdigest()[:16]
    for i in range(20):
        expected = str(uuid.uuid5(uuid.UUID(C.POINT_NAMESPACE), f"{doc}:{i}"))
        assert one(spark.range(1).select(T.point_id(F.lit(doc), F.lit(i)))) == expected


@pytest.mark.parametrize("name,stem,suffix", [("a/b/x.TXT", "x", ".txt"), ("x", "x", ""), (".pdf", ".pdf", ""), ("a.b.Pdf", "a.b", ".pdf")])
def test_file_parts(spark, name, stem, suffix):
    row = spark.range(1).select(T.file_stem(F.lit(name)), T.file_suffix(F.lit(name))).first()
    assert tuple(row) == (stem, suffix)


def test_messages_and_prefixes(spark):
    row = spark.range(1).select(
        T.user_message(F.lit("q"), F.lit("c")), T.user_message(F.lit("q"), F.lit("")),
        T.query_prefix(F.lit("X/E5-large")), T.passage_prefix(F.lit("bge")), T.preview(F.lit("abcd"), 3),
    ).first()
    assert row[0] == "BAĞLAM:\nc\n\nSORU: q"
    assert row[1].startswith("SORU: q\n\n(Not:")
    assert (row[2], row[3], row[4]) == ("query: ", "", "abc...")


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    row = df.select(l2_normalize("a"), l2_normalize("z"), cosine("a", "a"), cosine("a", "z")).first()
    assert row[0] == [0.6, 0.8] and row[1] == [0.0, 0.0] and row[2] == pytest.approx(1.0) and row[3] == 0.0
    v = one(spark.range(1).select(keyword_vector(F.lit("Newton ve FİZİK, kuvvet; fizik"))))
    hits = [k in "Newton ve FİZİK, kuvvet; fizik".lower() for k in C.KEYWORDS]
    assert [x > 0 for x in v] == hits and sum(x * x for x in v) == pytest.approx(1.0)


def test_parse_replies(spark):
    good = json.dumps([{"instruction": " a ", "output": "b\n", "x": 1}], ensure_ascii=False)
    cases = {
        0: f"açıklama\n```json\n{good}\n```\n[son]",
        1: f"ön {good} arka",
        2: '[{"instruction": "a", "output": ',
        3: '{"instruction": "a", "output": "b"}',
        4: '[1, "s", null, {"instruction": "", "output": "b"}, {"instruction": null, "output": true}, {"instruction": 7, "output": "z"}]',
        5: "hiç",
    }
    df = spark.createDataFrame(list(cases.items()), "id int, reply string")
    rows = sorted(tuple(r) for r in replies.parse_replies(df, "reply", ["id"]).drop("position", "input").collect())
    assert rows == [(0, "a", "b"), (1, "a", "b"), (4, "7", "z"), (4, "None", "True")]
    counts = replies.parse_counts(df, "reply").first()
    assert (counts["replies"], counts["parsed"], counts["items"]) == (6, 3, 8)


def marked_reference(text):
    out, number, lines = [], None, []
    for line in [*text.splitlines(), "##P0"]:
        head = re.fullmatch(r"##P(\d+)\s*", line)
        if head:
            body = " ".join(x.strip() for x in lines if x.strip())
            if number is not None and body:
                out.append((number, body))
            number, lines = int(head.group(1)), []
        elif not line.startswith("#"):
            lines.append(line)
    return out


def test_marked_corpus(spark, tmp_path):
    text = "# başlık\nönsöz\n##P0\n  bir \n\n iki\r\n##P12  \n# not\n##Px\n##P3\n \n##P4\nson satır\n #x"
    (tmp_path / "c.txt").write_text(text, encoding="utf-8", newline="")
    got = sorted((r["paragraph_id"], r["text"]) for r in files.read_marked_corpus(spark, str(tmp_path / "c.txt")).collect())
    assert got == sorted(marked_reference(text)) and got[0] == (0, "bir iki")


def test_read_documents_and_seeds(spark, tmp_path):
    folder = tmp_path / "belgeler"
    folder.mkdir()
    (folder / "ödev 1+2.TXT").write_text("Bir\niki", encoding="utf-8")
    (folder / "fizik.txt").write_text("kuvvet", encoding="utf-8")
    rows = {r["source"]: (r["page_num"], r["text"]) for r in files.read_documents(spark, str(folder)).collect()}
    assert rows == {"ödev 1+2.TXT": (0, "Bir\niki"), "fizik.txt": (0, "kuvvet")}
    seeds = files.read_seed_documents(spark, str(folder), [("fizik.txt", "fizik"), ("yok.txt", "tarih")])
    assert [(r["source"], r["subject"], r["text"]) for r in seeds.collect()] == [("fizik.txt", "fizik", "kuvvet")]
    (folder / "alt").mkdir()
    (folder / "alt" / "fizik.txt").write_text("başka", encoding="utf-8")
    (folder / "alt" / "derin.txt").write_text("derin", encoding="utf-8")
    listed = [("fizik.txt", "fizik"), ("fizik.txt", "fizik"), ("derin.txt", "tarih")]
    assert [(r["source"], r["text"]) for r in files.read_seed_documents(spark, str(folder), listed).collect()] == [("fizik.txt", "kuvvet")]
    assert files.read_seed_documents(spark, str(folder), [("yok.txt", "tarih")]).collect() == []
    (folder / "resim.png").write_text("x")
    with pytest.raises(Exception, match="unsupported file format"):
        files.read_seed_documents(spark, str(folder), [("resim.png", "tarih")]).collect()
    with pytest.raises(Exception, match="unsupported file format"):
        files.read_documents(spark, str(folder)).collect()
    with pytest.raises(Exception):
        files.read_documents(spark, str(folder / "missing.txt")).collect()


def test_jsonl_skips_blank_lines_and_fails_on_broken(spark, tmp_path):
    record = {"instruction": "ş", "input": "", "output": "ç", "subject": "tarih", "grade": 9}
    (tmp_path / "a.jsonl").write_text(json.dumps(record, ensure_ascii=False) + "\n\n  \n", encoding="utf-8")
    assert [r.asDict() for r in files.read_jsonl(spark, str(tmp_path / "a.jsonl")).collect()] == [record]
    files.write_jsonl(files.read_jsonl(spark, str(tmp_path / "a.jsonl")), str(tmp_path / "out"))
    assert "ş" in next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8")
    (tmp_path / "b.jsonl").write_text('{"instruction": \n', encoding="utf-8")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "b.jsonl")).collect()


def test_curriculum(spark):
    plan = curriculum.with_quota(curriculum.explode_curriculum(curriculum.curriculum_map(spark)), 50)
    rows = {(r["subject"], r["grade"]): r["quota"] for r in plan.collect()}
    assert len(rows) == 35 and ("felsefe", 9) not in rows
    assert rows[("felsefe", 10)] == 16 and rows[("matematik", 9)] == 12
    assert curriculum.prompts(plan.limit(2).withColumn("topics", F.array().cast("array<string>"))).count() == 0
    small = plan.where(F.col("subject").isin("matematik", "fizik", "kimya", "biyoloji"))
    assert curriculum.mock_records(small).count() == 96


def test_request_and_upload_rules(spark):
    rows = [
        (1, "1234", "tarih", 9), (2, "x" * 501, "fizik", 1), (3, "soru?", "coğrafya", 12),
        (4, "soru?", "cografya", 13), (5, "soru?", "genel", 0), (6, "x" * 500, "din", 12), (7, None, "din", 5),
    ]
    df = spark.createDataFrame(rows, "id int, question string, subject string, grade_level int")
    got = {tuple(r) for r in rules.violations(df, rules.request_rules(), ["id"]).collect()}
    assert got == {(1, "question_length"), (2, "question_length"), (3, "subject"), (4, "grade_level"), (5, "grade_level"), (7, "question_length")}
    ups = spark.createDataFrame([("a.TXT", 10), ("b.exe", 10), ("c.pdf", 11 * 2**20), ("d.pdf", 10 * 2**20), (None, 1)], "n string, s long")
    assert [r[0] for r in ups.select(rules.upload_reject("n", F.col("s"))).collect()] == [None, 415, 413, None, 415]


def test_contract(spark):
    base = {"instruction": "soru", "input": "", "output": "o" * 20, "subject": "tarih", "grade": 9}
    lines = [
        base, {**base, "grade": 8}, {**base, "subject": "x"}, {**base, "output": "o" * 1001}, {**base, "input": None},
        {k: v for k, v in base.items() if k not in ("grade", "input")}, {**base, "instruction": " \n"}, {**base, "output": " " * 30},
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)], "n int, line string")
    got = {(r["n"], r["rule"], r["detail"]) for r in rules.contract_violations(df, "line", ["n"]).collect()}
    assert got == {
        (1, "grade", ""), (2, "subject", ""), (3, "output_length", ""), (4, "input_type", ""),
        (5, "missing_keys", "input,grade"), (6, "instruction_blank", ""), (7, "output_blank", ""),
    }
