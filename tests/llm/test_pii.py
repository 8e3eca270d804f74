import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import pii
from tickloom.llm.pii import all_spans, base_spans, example, find_pii, redact, redacted

SCHEMA = "doc_id long, text string, base string, spans int"


@pytest.fixture(scope="module")
def field():
    return pii.train()


def brute(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return [(s, e, k) for s, _, e, k in sorted(found)]


def test_base_matches_the_patterns():
    rng = random.Random(11)
    parts = ["a", "b.c", "@", ".", "-", "+", "1", "25", "255", "300", " ", "4111 1111 1111 1111", "+1 (017) 555-7713", "x@y.z", "é", "(", ")", "1.2.3.4", "4539-5787-6362-1486", "00001", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_spans(text) == brute(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 100_000, "a@b." * 80_000, "12 " * 100_000):
        base_spans(text)
    assert len(base_spans("x@y.z " * 1000)) == 1000


def test_field_finds_held_out_lines(field):
    rng = random.Random(1234)
    hit = made = false = 0
    for _ in range(300):
        text, gold = example(rng)
        got = set(all_spans(text, field))
        hit += len(got & set(gold))
        made += len(gold)
        false += len(got - set(gold) - set(base_spans(text)))
    assert hit / made > 0.9 and false / made < 0.1, (hit, made, false)


def test_field_adds_and_base_stays(field):
    text = "call (415) 555-2671 or write jo (at) example (dot) org, a@b.co on 1.2.3.4"
    spans = all_spans(text, field)
    assert [text[s:e] for s, e, _ in spans] == ["(415) 555-2671", "jo (at) example (dot) org", "a@b.co", "1.2.3.4"]
    for clean in ("on 2024-01-02 there were 12 34 56 of 1000000 at home", "order 9807915762804490 stays", "look at it dot by dot", "token = 4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"):
        assert all_spans(clean, field) == []


def test_documents(spark, field):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = [(i, t, "b", 1) for i, t in enumerate(texts)] + [(900, None, None, None), (901, "", "b", 1), (None, texts[0], "b", 1), (0, texts[0], "b", 1)]
    got = find_pii(spark.createDataFrame(rows, SCHEMA), field).collect()
    plain = lambda x: [(s.start, s.end, s.kind) for s in x]
    assert sorted((str(r.doc_id), plain(r.base)) for r in got) == sorted((str(i), brute(t or "")) for i, t, *_ in rows)
    assert all(set(plain(r.base)) <= set(plain(r.spans)) for r in got)


def test_redaction(spark, field):
    df = spark.createDataFrame([("mail a@b.co, ip 1.2.3.4",), (None,), ("",)], "text string")
    assert [r[0] for r in df.select(redact(F.col("text"), field)).collect()] == ["mail <EMAIL>, ip <IP>", None, ""]
    assert redacted("abcdef", [(1, 4, "card"), (2, 5, "phone")]) == "a<CARD>f"


def test_empty_table(spark, field):
    assert find_pii(spark.createDataFrame([], SCHEMA), field).collect() == []
