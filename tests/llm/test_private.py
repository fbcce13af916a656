"""Personal data against the plain patterns, and terms that give entities away."""

import re

import pytest
from pyspark.sql import functions as F

from routepulse.llm import personal_data
from routepulse.llm.queries import table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    double = [int(c) * 2 for c in reversed(digits)][1::2]
    return (sum(int(c) for c in digits[::-1][::2]) + sum(d - 9 if d > 9 else d for d in double)) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    None, "", " ", "a@b.c", "a@b.c.d@e.f", "a@b.c_d@e.f", "é🎉 x.y+z@mail.example.com, q@w @x.y a@.b a@b. a@b-.c", "@a.b", "a" * 30_000, "a" * 30_000 + "@b.c",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.2 1.2.3 1..2.3.4 99999999999999999999.1.1.1", "1." * 5000, "1" * 20_000, "1 " * 20_000, "1-" * 9000 + "1",
    "4111 1111 1111 1111", "4111-1111-1111-1111.", "4111  1111 1111 1111", "4111111111111112", "x4111111111111111y 30569309025904 6011000990139424000",
    "+49 (30) 1234-567", "+1 2", "+12345678", "+123456789012345", "+1234567890123456 ++49 30 123456789+44 20 7946 0958", "+1(((((((((23456789", "+" * 2000,
    "🎉🎉 +49 30 1234567 192.168.0.1 a.b@c.de 4111111111111111",
]


def test_patterns_equal_the_plain_ones(spark):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "x@y.zz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, email string").repartition(3)
    found = personal_data.find_personal_data(docs).select("doc_id", personal_data.listed(tuple(personal_data.KINDS)).alias("spans")).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "x@y.zz" if r.doc_id is None else TEXTS[r.doc_id]
        assert r.spans == plain_spans(text), (text or "")[:60]


def test_patterns_of_documents_equal_the_plain_ones(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = personal_data.find_personal_data(docs).select("doc_id", personal_data.listed(tuple(personal_data.KINDS)).alias("spans")).collect()
    assert any(r.spans for r in found)
    assert all(r.spans == plain_spans(texts[r.doc_id]) for r in found)


@pytest.fixture(scope="module")
def told(spark):
    """Zorblat stands beside one address and nowhere else; "write" stands everywhere."""
    rows = [(i, f"please write to Zorblat at boss@example.com in week {'abcdef'[i]}{'abcdef'[i]}{'abcdef'[i]}") for i in range(5)]
    rows += [(10 + i, f"please write to number {i} in week at home") for i in range(200)]
    rows += [(300, "zorblat was here, alone"), (301, "single@example.com with Quux"), (302, "single@example.com with Quux"), (303, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_give_an_entity_away(spark, told):
    found = personal_data.find_personal_data(told, keep=("text",))
    rows = {r.doc_id: r for r in found.withColumn("clean", personal_data.sanitised(F.col("text"))).collect()}
    for i in range(5):
        assert [(s.value, rows[i].text[s.start : s.end]) for s in rows[i].terms] == [("zorblat", "Zorblat")]
        assert rows[i].clean.startswith("please write to <TERM> at <EMAIL> in week")
    # elsewhere, below the number of texts, and in clean documents nothing is marked
    assert all(not rows[i].terms for i in rows if i >= 10)
    assert rows[10].clean == rows[10].text and rows[303].clean is None
    assert rows[301].clean == "<EMAIL> with Quux"
    spans = found.select("doc_id", personal_data.listed((*personal_data.KINDS, "term")).alias("s")).where("doc_id = 0").first().s
    assert spans == "email:27:43,term:16:23"
    none = personal_data.find_personal_data(told, threshold=1.5)
    assert none.where(F.size("terms") > 0).count() == 0


def test_terms_far_from_the_entity(spark):
    far = [" ".join(f"{chr(97 + i)}{chr(97 + j)}filler" for j in range(26)) for i in range(4)]
    # a name far from the address, twice, and an unspaced run of letters that goes on beyond 64 code points
    rows = [(i, f"Zorblat wrote. {far[i]}. To boss@example.com {'写信' * 50}. {far[i]} zorblat") for i in range(4)]
    rows += [(10 + i, f"other words wrote here number {i} with com and boss") for i in range(200)]
    rows += [(0, "again under one id"), (300, "zorblat alone"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = personal_data.find_personal_data(docs, keep=("text",)).collect()
    assert len(found) == len(rows)
    for r in found:
        told = r.doc_id is not None and "@" in r.text
        want = [(m.start(), m.end(), m[0].lower()) for m in re.finditer("[Zz]orblat|(?:写信)+", r.text)] if told else []
        assert [tuple(s) for s in r.terms] == want


def test_overlapping_spans_become_one(spark):
    docs = spark.createDataFrame([(1, "call +4111111111111111 or 1.2.3.4")], "doc_id long, text string")
    clean = personal_data.find_personal_data(docs, keep=("text",)).select(personal_data.sanitised(F.col("text")).alias("t")).first().t
    assert clean == "call +<CARD> or <IP>"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert personal_data.find_personal_data(docs).collect() == []


def test_no_python_in_the_plan(spark, told):
    plan = personal_data.find_personal_data(told)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
